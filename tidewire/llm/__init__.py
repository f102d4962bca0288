"""Operators for preparing training text: filters, near-duplicates, mixing, sharding, extraction, search and counts."""
