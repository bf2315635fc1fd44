"""Filter interaction audit by count-weighted decision diagrams.

Five filters look at each whole text; a document's failure mask has one bit for
each filter. The documents of a part (a value of ``source``) are counted by
mask, and the counts make a decision diagram: a level for each filter, a node's
low child for documents that pass it and its high child for those that fail,
and (documents, good, toxic) counts as terminals. Equal nodes are shared, and
the weight of a node is the sum of the terminals below it. All orders of the
filters are visited by adjacent level swaps (Steinhaus-Johnson-Trotter), each
of which rewrites one level. In an order, the path of low edges from the root
gives its steps: the weight of the low child is kept, that of the high child
is removed.

The filters fail (words: maximal runs without space, tab, line feed, vertical
tab, form feed and carriage return; case-sensitive):
A: under 50 words; B: 100 x distinct words < 65 x words; C: 100 x A-Z characters
> 5 x code points; D: any of ``#$%&*|``; E: the text equals that of a smaller
doc_id anywhere in the table.

Scale. Texts are read once, in JVM expressions, and leave the scan as a
SHA-256 digest and four bits. E joins each (digest, doc_id) with the smallest
doc_id of its digest, which an aggregate with map-side combine finds, so
neither side has a hot key even if a third of all texts are equal. Counting by
(part, mask) combines before the shuffle: at most 32 rows for each part and
task. A part is one row of at most 32 counts from there on; the diagrams run in
tasks, part by part.

Output: one row per part, filter_order and step, zeros included, with filter,
kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley (the
removals of the step's filter summed over all orders).

Defined cases. A null text is empty: it fails A alone, and E if it is not the
first such text. A null source is the part of the empty string. Rows that
repeat a doc_id are counted each; equal doc_ids are not smaller than each
other. A null doc_id passes E and does not count as smaller. Of repeated labels
the largest counts; null labels are neither good nor toxic. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import written

FILTERS = "ABCDE"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
Counts = tuple[int, int, int]  # documents, good, toxic


class Diagram:
    """A reduced, ordered decision diagram with counts as terminals."""

    def __init__(self, order: str, counts: dict[int, Counts]):
        """``counts`` by failure mask; bit i is the i-th filter of ``order``."""
        self.order = list(order)
        self.nodes: dict[tuple, int] = {}  # what a node is -> its number
        self.what: list[tuple] = []
        self.weight: list[Counts] = []
        self.root = self._build(0, 0, counts)

    def _node(self, *what) -> int:
        """("", counts) or (filter, low, high), shared if it exists."""
        at = self.nodes.get(what)
        if at is None:
            at = self.nodes[what] = len(self.what)
            self.what.append(what)
            self.weight.append(what[1] if what[0] == "" else tuple(a + b for a, b in zip(self.weight[what[1]], self.weight[what[2]])))
        return at

    def _build(self, level: int, mask: int, counts: dict[int, Counts]) -> int:
        if level == len(self.order):
            return self._node("", counts.get(mask, (0, 0, 0)))
        low = self._build(level + 1, mask, counts)
        return self._node(self.order[level], low, self._build(level + 1, mask | 1 << level, counts))

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the level below it."""
        upper, lower = self.order[level : level + 2]
        self.order[level : level + 2] = lower, upper
        done: dict[int, int] = {}

        def moved(node: int, depth: int) -> int:
            if node in done:
                return done[node]
            _, low, high = self.what[node]
            if depth < level:
                out = self._node(self.order[depth], moved(low, depth + 1), moved(high, depth + 1))
            else:
                (_, a, b), (_, c, d) = self.what[low], self.what[high]
                out = self._node(lower, self._node(upper, a, c), self._node(upper, b, d))
            done[node] = out
            return out

        self.root = moved(self.root, 0)

    def path(self) -> list[tuple[str, Counts, Counts]]:
        """(filter, kept, removed) of the steps of this order."""
        out, node = [], self.root
        for f in self.order:
            _, low, high = self.what[node]
            out.append((f, self.weight[low], self.weight[high]))
            node = low
        return out


def adjacent_swaps(n: int) -> list[int]:
    """Levels whose swaps, one after the other, visit all orders of n items."""
    if n < 2:
        return []
    inner, out = adjacent_swaps(n - 1), []
    for i in range(len(inner) + 1):
        down = i % 2 == 0
        out += range(n - 2, -1, -1) if down else range(n - 1)
        if i < len(inner):  # the last item now stands at the front or the end
            out.append(inner[i] + 1 if down else inner[i])
    return out


def audit(counts: dict[int, Counts], filters: str = FILTERS) -> list[tuple]:
    """(filter_order, step, filter, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley) for every order and step."""
    d = Diagram(filters, counts)
    paths = {"".join(d.order): d.path()}
    for level in adjacent_swaps(len(filters)):
        d.swap(level)
        paths["".join(d.order)] = d.path()
    fails, alone, total = {}, {}, dict.fromkeys(filters, 0)
    for path in paths.values():
        for f, _, removed in path:
            total[f] += removed[0]
        fails[path[0][0]] = path[0][2][0]  # as the first filter it removes all that fail it
        alone[path[-1][0]] = path[-1][2][0]  # as the last one, those that fail nothing else
    return [
        (order, step, f, kept[0], removed[0], fails[f] - removed[0], alone[f], removed[1], removed[2], total[f])
        for order, path in paths.items()
        for step, (f, kept, removed) in enumerate(path, 1)
    ]


ROWS = (
    "part string, filter_order string, step int, filter string, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def failures(text: Column) -> dict[str, Column]:
    """The conditions of the filters that look at one text alone."""
    words = F.regexp_extract_all(text, F.lit(r"[^ \t\n\x0B\f\r]+"), F.lit(0))
    n = F.size(words)
    capitals = F.octet_length(text) - F.octet_length(F.translate(text, CAPITALS, ""))
    return {
        "A": n < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * n,
        "C": 100 * capitals > 5 * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and failure mask."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bits = sum((c.cast("int") * (1 << FILTERS.index(f)) for f, c in failures(F.col("t")).items()), F.lit(0))
    rows = (
        docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"))
        .select("part", "doc_id", F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("digest"), bits.alias("mask"))
        .groupBy("part", "doc_id", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    )
    rows = written(rows, "failures")
    named = rows.where("doc_id is not null")  # rows without an id would all meet in one task of a join
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    copies = F.when(F.col("first"), 0).otherwise(1 << FILTERS.index("E"))
    whole = named.join(first, ["digest", "doc_id"], "left").join(known, "doc_id", "left").select(
        "part", (F.col("mask") + copies).alias("mask"), "n", "good", "toxic"
    )
    whole = whole.unionByName(rows.where("doc_id is null").select("part", "mask", "n"), allowMissingColumns=True)
    among = [F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")]
    return whole.groupBy("part", "mask").agg(F.sum("n").alias("n"), *among)


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of every part of ``docs``."""
    by_part = masks(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in ROWS.split(", ")]
        for b in batches:
            for part, counts in zip(b["part"], b["counts"]):
                got = audit({c["mask"]: (c["n"], c["good"], c["toxic"]) for c in counts})
                yield pd.DataFrame([(part, *row) for row in got], columns=names)

    return by_part.mapInPandas(run, ROWS)
