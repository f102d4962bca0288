"""Query registration and the shared SQL views."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, replace
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    covers: tuple[str, ...]
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}
VIEWS: dict[str, str] = {}
MODULES = (
    "messages", "text_scores", "style", "links", "entities", "languages", "quotes", "stance",
    "rollups", "topics", "reduction", "evaluation", "reports", "pages", "stores", "streams",
)


def view(name: str, sql: str) -> None:
    """Declare a SQL view that twins may mention by name."""
    if name in VIEWS:
        raise ValueError(f"view {name} is declared twice")
    VIEWS[name] = sql


def _needed(sql: str, found: list[str]) -> list[str]:
    for name in VIEWS:
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(VIEWS[name], found)
            if name not in found:
                found.append(name)
    return found


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the views it uses, dependencies first."""
    names = _needed(sql, [])
    if not names:
        return sql
    ctes = ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)
    head = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql)
    recursive = "RECURSIVE " if head and head.group(1) else ""
    body = ", " + sql[head.end():] if head else " " + sql
    return f"WITH {recursive}{ctes}{body}"


def query(covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        ENTRIES[fn.__name__] = Entry(fn.__name__, tuple(covers.split()), fn, sql)
        return fn

    return register


def also(name: str, of: str) -> None:
    """Register a query under a second, earlier name."""
    ENTRIES[name] = replace(ENTRIES[of], name=name)


def _load() -> None:
    for module in MODULES:
        import_module(f"tidewire.catalog.{module}")


def runnable() -> dict[str, Query]:
    _load()
    return {name: e.run for name, e in ENTRIES.items()}


def oracle() -> dict[str, str]:
    _load()
    return {name: with_views(e.sql.strip()) for name, e in ENTRIES.items() if e.sql}
