"""Benchmark decontamination by one Aho-Corasick automaton.

Text is normalised in bytes: A-Z become a-z, every run of other ASCII
characters than digits and letters becomes one space, and everything beyond
ASCII is kept, so a word is a maximal run of ``[0-9a-z]`` and non-ASCII. The
windows of an item are its runs of ``window`` words (an item with fewer words is
one window). Each window, with a space on both sides, is a word of the
automaton; one pass over a normalised text with a space on both sides finds all
occurrences at word borders. Hit words are the union of the occurrences, and
runs of hit words map back to code points of the original text.

Scale. The text is read once where it lies: nothing is shuffled, so a hot
source, or many copies of a leaked passage, cost what other rows cost. The
items are broadcast. Their size is summed first: beyond ``block_bytes`` they
are dealt into blocks by hash, each with its own automaton of bounded size and
its own pass, and the hits of a document are merged by an aggregate. An
occurrence becomes one entry of an array while its document is scanned, never a
row. An item is never split, so the largest item bounds a block from below.

Output of ``scan``: the columns doc_id, n_words, n_hit, spans (array of start,
end in code points, end exclusive: maximal runs of hit words), items (sorted
ids as text) for each row.

Defined cases. A null or empty text has no words. Items that are null, empty
or without words have no window. Rows of ``benchmark`` with the same id are one
item; a null id hits words but names no item. Repeated rows and null doc_ids of
documents keep their rows. An empty benchmark hits nothing. Extra columns are
ignored. The texts are UTF-8.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import ROW, numbered, written

# bytes of words stay (A-Z in lower case), all others become spaces
_NORMAL = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))

Run = tuple[int, int, int, int]  # first word, word after the last; start, end in code points


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_NORMAL).split() if text else []


class Windows:
    """The automaton of the windows of (item id, text) pairs."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        owners: dict[str, tuple[int, set[str]]] = {}
        for item, text in items:
            ws = words(text)
            n = min(window, len(ws))
            for i in range(len(ws) - n + 1 if n else 0):
                _, ids = owners.setdefault(_padded(ws[i : i + n]), (n, set()))
                if item is not None:
                    ids.add(item)
        self.auto = ahocorasick.Automaton()
        for key, value in owners.items():
            self.auto.add_word(key, value)
        if owners:
            self.auto.make_automaton()
        self.any = bool(owners)

    def scan(self, text: str | None) -> tuple[int, list[Run], set[str]]:
        """Number of words, maximal runs of hit words, ids of the items."""
        ws = words(text)
        if not ws or not self.any:
            return len(ws), [], set()
        line = _padded(ws)
        ends, lengths, ids = [], [], set()
        for end, (n, items) in self.auto.iter(line):
            ends.append(end)
            lengths.append(n)
            ids |= items
        if not ends:
            return len(ws), [], ids
        spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
        after = np.searchsorted(spaces, np.array(ends))  # a window ends with the space before this word
        hits = merged((a, b, 0, 0) for a, b in zip((after - np.array(lengths)).tolist(), after.tolist()))
        return len(ws), placed(text, hits), ids


def _padded(ws: list[bytes]) -> str:
    """One character for each byte, so that the automaton has 256 letters."""
    return b" ".join([b"", *ws, b""]).decode("latin-1")


def merged(runs: Iterable[Run]) -> list[Run]:
    """Runs that overlap or touch become one."""
    out: list[list[int]] = []
    for first, last, start, end in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1][1], out[-1][3] = max(out[-1][1], last), max(out[-1][3], end)
        else:
            out.append([first, last, start, end])
    return [tuple(r) for r in out]


def placed(text: str, runs: list[Run]) -> list[Run]:
    """Runs of words with their places in code points of ``text``."""
    raw = text.encode()
    inside = np.frombuffer(raw.translate(_NORMAL), np.uint8) != 32
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # code points that begin before each byte
    points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [(a, b, int(points[starts[a]]), int(points[ends[b - 1]])) for a, b, _, _ in runs]


_READY: dict[str, Windows] = {}  # the automaton of this Python worker


def _automaton(key: str, items: Broadcast, window: int) -> Windows:
    if key not in _READY:
        _READY.clear()
        _READY[key] = Windows(items.value, window)
    return _READY[key]


_RUN = pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "end")])
_RUNS = "runs array<struct<first:long,last:long,start:long,end:long>>"


def _scanned(docs: DataFrame, items: Broadcast, window: int) -> DataFrame:
    """The id columns of ``docs``, n_words, runs and items of one block."""
    key = uuid.uuid4().hex
    kept = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = _automaton(key, items, window)
        for b in batches:
            for s in range(0, len(b), 500):
                p = b.slice(s, 500)
                found = [auto.scan(value.as_py()) for value in p["text"]]
                cols = [
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([[dict(zip(("first", "last", "start", "end"), r)) for r in runs] for _, runs, _ in found], pa.list_(_RUN)),
                    pa.array([sorted(ids) for _, _, ids in found], pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays([*(p[c] for c in kept), *cols], names=[*kept, "n_words", "runs", "items"])

    return docs.mapInArrow(run, ", ".join(f"{c} long" for c in kept) + f", n_words long, {_RUNS}, items array<string>")


def _joined(parts: DataFrame) -> DataFrame:
    """One row for each document from its rows of all blocks."""
    rows = parts.groupBy(ROW).agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("runs")).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ("first", "last", "start", "end")
        for b in batches:
            b["runs"] = [[dict(zip(names, m)) for m in merged(tuple(r[n] for n in names) for r in runs)] for runs in b["runs"]]
            yield b

    return rows.drop(ROW).mapInPandas(run, f"doc_id long, n_words long, {_RUNS}, items array<string>")


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 256_000) -> DataFrame:
    """doc_id, n_words, n_hit, spans, items of every row of ``docs`` (a scan
    of written files)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # a block holds about block_bytes of item texts, known from the sum above
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    if blocks == 1:
        found = _scanned(base, spark.sparkContext.broadcast([tuple(r) for r in items.collect()]), window)
    else:
        base = numbered(base)
        parts = []
        for i in range(blocks):
            part = spark.sparkContext.broadcast([tuple(r) for r in items.where(block == i).collect()])
            parts.append(written(_scanned(base, part, window), "hits"))
        found = _joined(functools.reduce(DataFrame.unionByName, parts))
    return found.select(
        "doc_id", "n_words",
        F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"]).alias("n_hit"),
        F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"))).alias("spans"),
        "items",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Digest of ``scan``: the number and a hash of the items instead of spans."""
    return scan(docs, benchmark, **options).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
