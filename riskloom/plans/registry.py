"""Registration of queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``key``, with the SQL that yields the same rows."""

    def register(fn):
        if key in QUERIES:
            raise ValueError(f"query {key!r} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register
