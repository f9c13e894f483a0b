"""Operators on training text: deduplication, search, scans, tokens, packing."""
