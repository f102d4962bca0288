"""Operators: each is a ``DataFrame -> DataFrame`` function usable with ``df.transform``."""
