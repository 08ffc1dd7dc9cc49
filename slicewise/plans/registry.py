"""All queries of the library by name, and their SQL."""

from __future__ import annotations

from slicewise.plans import path_queries, quality_queries, volume_queries

MODULES = (quality_queries, path_queries, volume_queries)


def queries() -> dict:
    return {name: f for m in MODULES for name, (f, _) in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
