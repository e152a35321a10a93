"""Readers and writers; every one returns or takes a DataFrame."""
