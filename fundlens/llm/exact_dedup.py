"""Exact dedup by deterministic block naming, DataFrame functions only.

The bytes of a text are cut into fixed-size blocks. The different blocks are
sorted, and the place of a block in that order is its integer name. Then
adjacent names are paired, the different pairs are sorted and named in the same
way, and so on until every document has a single name. Two documents with the
same number of blocks and the same last name are equal byte for byte. The order
is by a 64-bit hash and then by the whole block, so that ranges of it are even
and most comparisons take one number; equality is decided by the block alone.
A name depends on the set of texts only, not on files, partitions or attempts.

Scale. A range of hashes is one window partition and the number of ranges grows
with the rows; one row per range gives the offsets. Text moves once, on the
first level; each later level halves the rows and moves integers. Keys that
occur more often than a bound (at most ``HOT_KEYS`` of them, by counting) are
reduced to one row before the shuffle, and their rows stay where they are and
read the names from a broadcast of at most HOT_KEYS blocks. Levels are written
to the shared folder, which bounds the lineage.

Output: one row per row of ``docs``: doc_id, keep_id, group_size, kept,
text_sha256 (hex of the text in UTF-8, for users; it is not used for grouping).

Defined cases. A null text counts as empty; all empty texts are equal. Of equal
texts the row with the largest doc_id stays (null ids only if no other; of
repeated rows with that id, exactly one). An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import ROW, numbered, written

HOT_KEYS = 20_000  # keys that may be broadcast: 40 MB of 2 KB blocks
MIN_HOT = 1024  # keys up to this count are never hot
RANGE_ROWS = 65_536  # rows of a range of hashes, on average


def _named(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Replace ``keys`` of about ``n`` rows (ROW, blocks, pos, keys) by
    ``name``, the place of the keys among the different ones, from 0."""
    rows = rows.withColumn("h", F.xxhash64(*keys))
    bound = max(MIN_HOT, n // HOT_KEYS)  # at most n / bound hashes exceed it
    hot = written(rows.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > bound).select("h"), "hot")
    cold = rows.join(F.broadcast(hot), "h", "left_anti")
    often = rows.join(F.broadcast(hot), "h", "left_semi")
    pool = cold.unionByName(often.select("h", *keys).distinct(), allowMissingColumns=True)
    bits = max(10, (n // RANGE_ROWS).bit_length())
    ranked = pool.withColumn("part", F.shiftrightunsigned("h", 64 - bits)).withColumn(
        "place", F.dense_rank().over(Window.partitionBy("part").orderBy("h", *keys)).cast("long")
    )
    only_hot = [F.when(F.col(ROW).isNull(), F.col(k)).alias(k) for k in keys]
    ranked = written(ranked.select(ROW, "blocks", "pos", "part", "place", *only_hot), "places")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranked.groupBy("part").agg(F.max("place").alias("top")).select(  # one row for each range
        "part", F.coalesce(F.sum("top").over(before), F.lit(0)).alias("offset")
    )
    named = ranked.join(F.broadcast(offsets), "part").withColumn("name", F.col("offset") + F.col("place") - 1)
    hot_names = named.where(F.col(ROW).isNull()).select(*keys, "name")
    out = [ROW, "blocks", "pos", "name"]
    return named.where(F.col(ROW).isNotNull()).select(*out).unionByName(
        often.join(F.broadcast(hot_names), keys).select(*out)
    )


def identities(docs: DataFrame, block_bytes: int = 2048) -> DataFrame:
    """(ROW, blocks, name): equal exactly for equal texts. ``docs`` is
    numbered by ROW and has the columns text and ROW."""
    size = F.lit(block_bytes)
    raw = docs.select(ROW, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw"))
    raw = raw.withColumn("blocks", F.greatest(F.ceil(F.octet_length("raw") / size), F.lit(1)).cast("int"))
    cut = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.substring(F.col("raw"), i * size + 1, size)
    )
    n, longest = raw.agg(F.sum("blocks"), F.max("blocks")).first()
    n, longest = n or 0, longest or 1
    level = written(_named(raw.select(ROW, "blocks", F.posexplode(cut).alias("pos", "block")), ["block"], n), "names")
    done = level.where("blocks = 1").select(ROW, "blocks", "name")
    rest = level.where("blocks > 1")
    while longest > 1:
        pairs = (
            rest.groupBy(ROW, "blocks", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("right"),
            )
            .withColumn("right", F.coalesce("right", F.lit(-1)))  # names are not negative
        )
        rest = written(_named(written(pairs, "pairs"), ["left", "right"], n), "names")
        longest = (longest + 1) // 2
    return done.unionByName(rest.select(ROW, "blocks", "name"))


def grouped(docs: DataFrame, block_bytes: int = 2048) -> DataFrame:
    """ROW, doc_id, keep_id, group_size, kept of rows numbered by ROW."""
    ids = identities(docs, block_bytes).join(docs.select(ROW, F.col("doc_id").cast("long").alias("doc_id")), ROW)
    ids = written(ids, "identities")
    best = ids.groupBy("blocks", "name").agg(
        F.max(F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", ROW)).alias("best"), F.count(F.lit(1)).alias("group_size")
    )
    return ids.join(best, ["blocks", "name"]).select(
        ROW, "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col(ROW) == F.col(f"best.{ROW}")).alias("kept")
    )


def exact_duplicates(docs: DataFrame, block_bytes: int = 2048) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of a scan."""
    base = numbered(docs.select("doc_id", "text"))
    sha = base.select(ROW, F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("text_sha256"))
    return grouped(base, block_bytes).join(sha, ROW).drop(ROW)
