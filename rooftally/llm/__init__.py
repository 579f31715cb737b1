"""Operators for preparing training text: deduplication, filtering, archives, token files and packing."""
