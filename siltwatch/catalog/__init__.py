"""Named queries over the test tables, each with its SQL twin where one exists."""

from __future__ import annotations

from importlib import import_module

from siltwatch.catalog.registry import QUERIES, SQL, Query

MODULES = ("ingest", "inspection", "detection", "streams", "monitoring", "training")


def _load() -> None:
    for name in MODULES:
        import_module(f"siltwatch.catalog.{name}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
