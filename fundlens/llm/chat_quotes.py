"""Chat formatting by quotation linking, DataFrame functions only.

A line of a message that starts with n marks ``>`` (spaces between them
allowed) quotes at level n; other lines are the message's own. Lines of one
level that follow each other are a quoted passage. Every passage and every own
line or run of own lines (a paragraph up to an empty line, and the whole body)
is normalised (lower case, runs of white space as one space) and hashed; a
passage is linked to the earliest earlier message of the same conversation
that has the same passage as its own text. If a passage as a whole is no
known text, its lines are linked one by one.

The parent of a message is the latest origin among its outermost linked
passages. A message's thread is the root reached over parents (pointer
doubling, written to the shared folder every round). The reply order of a
conversation puts threads in the order of their roots and a thread's messages
in turn order, so each reply comes after its parent and beside its thread. A
message that quotes nothing known starts a thread of its own, so a
conversation without quotes keeps its turn order.

Output: one row per message: conv_id, turn, role, parent_turn, thread_turn,
position (1-based in its conversation), n_quotes, n_linked, formatted
(``<|role|>\\n`` + own text without quotes + ``<|end|>``).

Scale. Hashes meet per conversation after an aggregate with map-side combine.
Positions come from range partitions with per-partition counts, so no task has
to hold a conversation, however long.

Defined cases. Null text: empty message. Null role: ``unknown``. Null or
repeated (conv_id, turn): rows are kept; they are ordered by row number and a
link goes to a smaller turn only (null turns link nowhere). Null conv_ids form
one conversation that is never linked. Empty quoted lines link with nothing. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import ROW, numbered, written

MARKS = r"^\s*((?:>\s*)+)"


def _norm(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def _runs(msgs: DataFrame) -> DataFrame:
    """Whole passages of a message as arrays, computed inside the row: structs
    (level, run, text) where run numbers the stretches of equal level."""
    level = lambda s: F.length(F.regexp_replace(F.regexp_extract(s, MARKS, 1), r"\s", ""))
    lines = F.split(F.coalesce("text", F.lit("")), "\r?\n")
    step = lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["level"] == level(x)),
        F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(level(x).alias("level"), F.concat(F.element_at(acc, -1)["body"], F.lit("\n"), F.regexp_replace(x, MARKS, "")).alias("body"))),
        ),
    ).otherwise(F.concat(acc, F.array(F.struct(level(x).alias("level"), F.regexp_replace(x, MARKS, "").alias("body")))))
    empty = F.array().cast("array<struct<level:int,body:string>>")
    return msgs.withColumn("runs", F.aggregate(lines, empty, step))


def link(messages: DataFrame) -> DataFrame:
    """One row per message (numbered by ROW) with its links and own text."""
    msgs = numbered(
        messages.select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
            F.col("text").cast("string").alias("text"),
        )
    )
    quoting = msgs.where(F.col("text").rlike(r"(?:^|\n)\s*>"))
    # quoted passages, and their lines for the second try
    runs = _runs(quoting).select(ROW, "conv_id", "turn", F.posexplode("runs").alias("run", "r")).where("r.level > 0")
    passages = runs.select(ROW, "conv_id", "turn", "run", F.col("r.level").alias("level"), F.lit(0).alias("n"), _norm(F.col("r.body")).alias("key"))
    lines = runs.select(ROW, "conv_id", "turn", "run", F.col("r.level").alias("level"), F.posexplode(F.split("r.body", "\n")).alias("n", "b"))
    lines = lines.select(ROW, "conv_id", "turn", "run", "level", (F.col("n") + 1).alias("n"), _norm(F.col("b")).alias("key"))
    quotes = passages.unionByName(lines).where("key <> ''").withColumn("hash", F.xxhash64("key")).withColumn("digest", F.sha2("key", 256))
    quotes = written(quotes.select(ROW, "conv_id", "turn", "run", "level", "n", "hash", "digest"), "quotes")
    wanted = quotes.where("conv_id is not null").select("conv_id", "hash").distinct()
    # own text of every message that shares a conversation with a quote
    own = F.concat_ws("\n", F.filter(F.split(F.coalesce("text", F.lit("")), "\r?\n"), lambda s: ~s.rlike(MARKS)))
    told = msgs.join(wanted.select("conv_id").distinct(), "conv_id", "left_semi").select("conv_id", "turn", own.alias("own"))
    units = told.select("conv_id", "turn", F.explode(F.array_distinct(F.concat(F.array("own"), F.split("own", r"\n\s*\n"), F.split("own", "\n")))).alias("u"))
    units = units.select("conv_id", "turn", _norm(F.col("u")).alias("key")).where("key <> ''")
    origins = (
        units.withColumn("hash", F.xxhash64("key"))
        .join(wanted, ["conv_id", "hash"], "left_semi")
        .groupBy("conv_id", "hash", F.sha2("key", 256).alias("digest")).agg(F.min("turn").alias("origin"))
    )
    met = quotes.join(origins, ["conv_id", "hash", "digest"]).where(F.col("origin") < F.col("turn"))
    # lines count only where the whole passage is not known
    whole = met.where("n = 0").select(ROW, "run").distinct()
    linked = met.where("n = 0").unionByName(met.where("n > 0").join(whole, [ROW, "run"], "left_anti"))
    per_run = linked.groupBy(ROW, "run", "level").agg(F.max("origin").alias("origin"))
    parents = per_run.groupBy(ROW).agg(
        F.min(F.struct("level", (-F.col("origin")).alias("o"))).alias("m"), F.count(F.lit(1)).alias("n_linked")
    ).select(ROW, (-F.col("m.o")).alias("parent_turn"), "n_linked")
    n_quotes = quotes.where("n = 0").groupBy(ROW).agg(F.count(F.lit(1)).alias("n_quotes"))
    return (
        msgs.withColumn("own", own)
        .join(n_quotes, ROW, "left").join(parents, ROW, "left")
        .withColumn("n_quotes", F.coalesce("n_quotes", F.lit(0).cast("long")))
        .withColumn("n_linked", F.coalesce("n_linked", F.lit(0).cast("long")))
    )


def _threads(linked: DataFrame) -> DataFrame:
    """(ROW, thread_turn): root turn over parents, by pointer doubling."""
    up = linked.where("parent_turn is not null").groupBy("conv_id", "turn").agg(F.max("parent_turn").alias("up"))
    up = written(up, "parents")
    while True:
        a, b = up.alias("a"), up.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("far")).alias("b")
        nxt = written(a.join(b, ["conv_id", "up"], "left").select("conv_id", "turn", F.coalesce("far", "up").alias("up"), F.col("far").isNotNull().alias("moved")), "parents")
        up = nxt.select("conv_id", "turn", "up")
        if nxt.where("moved").isEmpty():
            return up.withColumnRenamed("up", "thread_turn")


def conversations(messages: DataFrame) -> DataFrame:
    """Reply-ordered messages without quotes; see the module's docstring."""
    linked = written(link(messages), "linked")
    roots = _threads(linked)
    rows = linked.join(roots, ["conv_id", "turn"], "left").withColumn("thread_turn", F.coalesce("thread_turn", "turn"))
    order = ["conv_id", "thread_turn", "turn", ROW]
    spread = written(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id()), "ordered"
    )
    inside = Window.partitionBy("pid", "conv_id").orderBy("thread_turn", "turn", ROW)
    counts = spread.groupBy("pid", "conv_id").agg(F.count(F.lit(1)).alias("n"))
    # a conversation has one row here for each range partition that it spans
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("before", F.coalesce(before, F.lit(0))).select(F.col("pid").alias("p2"), F.col("conv_id").alias("c2"), "before")
    placed = spread.withColumn("k", F.row_number().over(inside)).join(
        counts, (F.col("pid") == F.col("p2")) & F.col("conv_id").eqNullSafe(F.col("c2"))
    )
    return placed.select(
        "conv_id", "turn", "role", "parent_turn", "thread_turn", (F.col("before") + F.col("k")).cast("long").alias("position"),
        "n_quotes", "n_linked",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.trim("own"), F.lit("<|end|>")).alias("formatted"),
    )
