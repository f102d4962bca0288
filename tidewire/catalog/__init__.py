"""Runnable queries over the driver tables, each with its SQL twin where one exists."""

from tidewire.catalog.registry import oracle, runnable

__all__ = ["oracle", "runnable"]
