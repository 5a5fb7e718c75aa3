"""Registry of analytical queries and their DuckDB oracle SQL.

Each registered callable takes ``(spark, sf_dir)`` and returns a DataFrame over
the whole base tables. The oracle SQL (when given) computes the same result on
the same parquet files in DuckDB; column names are aliased identically.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
