"""Streaming entry: gate files as they arrive."""
