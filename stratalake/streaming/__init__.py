"""Incremental forms of the layers on Structured Streaming."""
