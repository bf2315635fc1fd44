"""Helpers shared by the training-data operators: tables in the shared folder,
row numbers, the held-out fold and group-at-a-time processing of a partition.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

ROW = "__row"  # number of a row in its input


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts
    the lineage, and survives the loss of any executor."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """Add ROW, a unique number per row taken from the row's place in the
    input files. ``df`` must be a scan of written files (as all inputs of the
    queries and pipeline stages are), so that a task that runs again, or the
    same scan in another branch of a plan, gives the same numbers."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def held_out(doc_id: Column | str) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0; null ids are held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def grouped_batches(
    df: DataFrame,
    keys: Sequence[str],
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """Apply ``fn`` to each whole group of ``keys`` without one Python call
    per Arrow group: rows are dealt by key and sorted, and a partition is read
    as a stream of batches cut at group borders. Groups must be bounded."""
    key_list = list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for b in batches:
            if rest is not None and len(rest):
                b = pd.concat([rest, b], ignore_index=True)
            cuts = _borders(b, key_list)
            last = cuts[-1]
            outs = [fn(b.iloc[i:j]) for i, j in zip(cuts[:-1], cuts[1:])]
            rest = b.iloc[last:].reset_index(drop=True)
            outs = [o for o in outs if len(o)]
            if outs:
                yield pd.concat(outs, ignore_index=True)
        if rest is not None and len(rest):
            out = fn(rest)
            if len(out):
                yield out

    return df.repartition(*key_list).sortWithinPartitions(*key_list).mapInPandas(run, schema)


def _borders(b: pd.DataFrame, keys: list[str]) -> list[int]:
    """Start positions of the groups of sorted rows (the last one is open)."""
    if not len(b):
        return [0]
    new = np.zeros(len(b), dtype=bool)
    new[0] = True
    for k in keys:
        v = b[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new).tolist()


def block_pairs(df: DataFrame, n_blocks: Column, spread_by: Column) -> DataFrame:
    """Split large groups into blocks and send every row to the pairs of
    blocks it belongs to: adds ``bi <= bj`` and ``side`` (0: row of block bi,
    1: row of block bj; block pairs with itself have side 0 only)."""
    own = F.pmod(F.xxhash64(spread_by, F.lit(17)), F.col("__nb"))
    return (
        df.withColumn("__nb", n_blocks.cast("long"))
        .withColumn("__own", own)
        .withColumn("__other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__nb") - 1)))
        .withColumn("bi", F.least("__own", "__other").cast("int"))
        .withColumn("bj", F.greatest("__own", "__other").cast("int"))
        .withColumn("side", (F.col("__own") > F.col("__other")).cast("int"))
        .drop("__nb", "__own", "__other")
    )


def union_find_stars(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n items over the given links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new
