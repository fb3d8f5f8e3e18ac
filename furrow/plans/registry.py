"""Registry of named queries bound to the given tables.

Each registered callable takes ``(spark, sf_dir)`` and returns a
DataFrame. ``sql`` is the equivalent DuckDB SQL over the same tables used
as the correctness oracle; it is omitted only for operators that SQL
cannot express (those are checked against brute force in ``tests/``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco
