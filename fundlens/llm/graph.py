"""Connected components of a distributed link table.

Alternating large-star / small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014). A round is two aggregates with
map-side combine and two joins, so a hub with a third of all links is first
reduced by partial minima and its join is split by AQE. No link or label ever
reaches the driver; it only sees one count and one checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (
        both.join(low, "u").where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    )


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u long, v long) links -> (node, component): component is the smallest
    node reachable. Self-links and nulls are ignored; nodes without a link do
    not appear."""
    ensure_checkpoint_dir(links.sparkSession)
    e = (
        links.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct().checkpoint()
    )
    seen = _print(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        e = _small_star(_large_star(e)).checkpoint()
        now = _print(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    # settled: every node points at its root, the roots at nothing
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _print(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(3)))).first()
    return tuple(r)
