"""Registry of the queries of this subpackage."""

from __future__ import annotations

from lathework.plans.registry import shipping

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = shipping(fn)
        if sql is not None:
            SQL[name] = sql
        return fn

    return add
