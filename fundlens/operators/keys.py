"""Surrogate ids that survive a refresh.

A key dictionary holds (natural key, id). Known keys keep their id, also when
they are absent from a build; new keys continue after the largest id in the
order given. The first build numbers all keys in that order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .distribution import attach_scalars, global_row_number


def assign_ids(rows: DataFrame, key: str, order: Sequence[Column], known: DataFrame | None = None, name: str = "id") -> DataFrame:
    """``rows`` (one for each value of ``key``) with their ids. ``order`` must
    be total; ``known`` has the columns (key, name)."""
    if known is None:
        return global_row_number(rows, order, name)
    old = known.select(F.col(key).alias("_k"), F.col(name).alias("_id"))
    both = rows.join(old, F.col(key).eqNullSafe(F.col("_k")), "left").drop("_k")
    kept = both.where(F.col("_id").isNotNull()).withColumnRenamed("_id", name)
    new = global_row_number(both.where(F.col("_id").isNull()).drop("_id"), order, "_n")
    top = known.agg(F.coalesce(F.max(name), F.lit(0)).cast("long").alias("_top"))
    new = attach_scalars(new, top).withColumn(name, F.col("_n") + F.col("_top")).drop("_n", "_top")
    return kept.unionByName(new)


def extended(known: DataFrame | None, rows: DataFrame, key: str, name: str = "id") -> DataFrame:
    """The dictionary after a build: every key that ever had an id."""
    now = rows.select(key, name)
    if known is None:
        return now
    gone = known.select(key, name).join(now.select(F.col(key).alias("_k")), F.col(key).eqNullSafe(F.col("_k")), "left_anti")
    return now.unionByName(gone)
