"""Feeds, landing files, published tables and their layout."""
