"""Packing by concatenate and cut.

Pass 1 encodes every document once and writes its ids with the number of ids
before it in its partition; each document ends with ``end_id``. Pass 2 sums the
totals of the partitions (one row per partition) into global offsets, adds
them, and cuts the single stream of ids into windows of ``length``. A document
that crosses a window border leaves one boundary record (piece) per window.
Nothing is shuffled, and only the partition totals are broadcast (one row of
16 bytes for each input partition). Padding is confined to the last window.

The order of documents is their place in the input files, which a task that
runs again repeats exactly.

Defined cases. A null or empty text is its end id alone. Null doc_ids and
repeated rows are packed like any other. Long texts are encoded in parts. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import written
from .tokens import encoder, tokenizer_path

PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def encoded(docs: DataFrame, tokenizer: str, kind: str, end_id: int) -> DataFrame:
    """(part, before, doc_id, n, width, ids): ids as little-endian integers of
    ``width`` bytes; ``before`` counts the ids earlier in the same partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, kind)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        width = enc.dtype.itemsize
        part, before = TaskContext.get().partitionId(), 0
        for b in batches:
            for s in range(0, len(b), 1000):
                p = b.slice(s, 1000)
                ids = [x + end for x in enc.encode(p["text"].to_pylist())]
                n = np.array([len(x) // width for x in ids], dtype=np.int64)
                starts = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(p), part, dtype=np.int32)), pa.array(starts), p["doc_id"].cast(pa.int64()),
                        pa.array(n), pa.array(np.full(len(p), width, dtype=np.int32)), pa.array(ids, pa.binary()),
                    ],
                    names=["part", "before", "doc_id", "n", "width", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "part int, before long, doc_id long, n long, width int, ids binary"
    )


def pack(
    docs: DataFrame,
    length: int = 2048,
    tokenizer: str | None = None,
    kind: str = "byte",
    end_id: int = 1,
) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, ids (little-endian unsigned 32-bit)."""
    ids = written(encoded(docs, tokenizer or tokenizer_path("byte_bpe_50k.json"), kind, end_id), "ids")
    totals = ids.groupBy("part").agg(F.sum("n").alias("total"))
    # one row for each partition of pass 1
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
    )
    placed = ids.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("at"), "n", "width", "ids"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            held = 0
            for doc_id, at, n, width, raw in zip(*(b[c].to_pylist() for c in ("doc_id", "at", "n", "width", "ids"))):
                wide = raw if width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()
                start = 0
                while start < n:
                    seq, off = divmod(at + start, length)
                    m = min(length - off, n - start)
                    piece = wide[4 * start : 4 * (start + m)]
                    rows.append((doc_id, start, m, zlib.crc32(piece), n, seq, off, piece))
                    start += m
                    held += 4 * m
                    if held >= 8 << 20:
                        yield _pieces(rows)
                        rows, held = [], 0
            if rows:
                yield _pieces(rows)

    return placed.mapInArrow(cut, PIECE)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(cols[7], pa.binary())],
        names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
    )


def pieces(docs: DataFrame, **options) -> DataFrame:
    """Digest of ``pack``: the pieces without their ids."""
    return pack(docs, **options).drop("ids")
