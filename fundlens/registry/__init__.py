"""Registry of named queries: key -> Spark callable and DuckDB oracle SQL.

Every callable takes (spark, sf_dir) and returns a DataFrame computed from
the driver's tables; ``oracle`` holds the equivalent DuckDB SQL (omitted only
for operators that SQL cannot express).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..oracle import sql_for

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = sql_for(oracle)
        return fn

    return deco


def load_all() -> None:
    from . import core, fx, quality, serving, star  # noqa: F401
