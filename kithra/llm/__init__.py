"""Operators of a training-data pipeline: deduplication, scans, mixing, scoring and token files."""
