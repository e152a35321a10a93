"""Registered queries, grouped by family, and the index configuration string."""
