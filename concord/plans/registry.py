"""All queries on the views, with their SQL."""

from __future__ import annotations

from . import catalogue_queries, io_queries, measurement_queries, quality_queries, tension_queries

_MODULES = (tension_queries, measurement_queries, quality_queries, catalogue_queries, io_queries)


def queries() -> dict:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
