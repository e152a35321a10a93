"""Structured Streaming maintenance and search."""
