"""Distribution helpers: scalar attach, global and per-group ranking.

* ``attach_scalars`` joins one-row aggregates onto a frame through a
  broadcast of exactly one row (no cartesian product with data).
* ``global_row_number`` numbers rows 1..n in a total order without a
  single-partition window: range-partition + sort, write the rows with their
  partition and the position in it (from ``monotonically_increasing_id``), count
  rows per partition (one row per partition), prefix-sum the counts and add.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

_LOWER_BITS = 33  # record index bits of monotonically_increasing_id


def attach_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate ``scalars`` to every row."""
    left = df.withColumn("_one", F.lit(1))
    right = scalars.withColumn("_one", F.lit(1))
    return left.join(F.broadcast(right), "_one", "left").drop("_one")


def combine_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """Merge one-row frames with disjoint columns into one row (union + max),
    avoiding joins of scalar aggregates."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    cols = out.columns
    return out.agg(*[F.max(c).alias(c) for c in cols])


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "rank_no") -> DataFrame:
    """1-based position of each row under ``order`` (which must be total)."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    pos = ranged.select(
        "*",
        F.spark_partition_id().alias("_pid"),
        (F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), _LOWER_BITS)).alias(
            "_pos"
        ),
    )
    pos = written(pos, "ranked")
    counts = pos.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
    )
    # one row per partition: a proven, small broadcast
    ranked = pos.join(F.broadcast(offsets), "_pid")
    return ranked.withColumn(name, (F.col("_off") + F.col("_pos") + 1).cast("long")).drop("_pid", "_pos", "_off")


def group_row_number(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "rank_no") -> DataFrame:
    """1-based position of each row in its group under ``order`` (which must be
    total), for groups of any size: rows are range-partitioned by (group,
    order) and written below the checkpoint folder, so a hot group spans many
    partitions; the rows of a group in earlier partitions are added from one
    count per (partition, group)."""
    keys = [F.col(g).asc() for g in group]
    ck = written(df.repartitionByRange(*keys, *order).withColumn("_pid", F.spark_partition_id()), "ranked")
    counts = ck.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # groups that lie in one partition need no offset
    offsets = counts.withColumn("_off", F.sum("_n").over(earlier)).where(F.col("_off").isNotNull())
    offsets = offsets.select(F.col("_pid").alias("_p2"), *[F.col(g).alias(f"_g_{g}") for g in group], "_off")
    pos = ck.withColumn("_pos", F.row_number().over(Window.partitionBy("_pid", *group).orderBy(*order)))
    on = F.col("_pid") == F.col("_p2")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    out = pos.join(offsets, on, "left").withColumn(name, (F.coalesce("_off", F.lit(0)) + F.col("_pos")).cast("long"))
    return out.select(*df.columns, name)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Distributed top-n (per-partition top-n, then merge)."""
    return df.orderBy(*order).limit(n)
