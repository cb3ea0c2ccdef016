"""Structured Streaming: file streams, windows, stream joins, change merging, layered tables."""
