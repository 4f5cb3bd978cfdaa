"""The layers, put together from operators."""
