"""The queries by name, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from checks.sql_views import with_views

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register ``fn(spark, sf_dir)``; ``sql`` may use the views named in ``views``."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is taken")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = with_views(views, sql)
        return fn
    return add
