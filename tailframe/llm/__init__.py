"""Operators for large training-data pipelines: tokenising, archives, search, extraction, dedup, mixing, filters."""
