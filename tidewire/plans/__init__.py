"""Composed plans: the full enrichment of a message table and its staged form."""
