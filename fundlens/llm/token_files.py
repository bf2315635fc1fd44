"""Token-id files: independent zstandard frames with a trailing seek table.

File layout (all integers little-endian):

    frame 0 | frame 1 | ... | seek table
    frame       one zstandard frame per document: its ids, ``width`` bytes each
    seek table  a zstandard skippable frame (magic 0x184D2A5E, u32 size) with
                entries of 33 bytes (doc_id i64, has_id u8, frame offset u64,
                frame bytes u32, ids u64, crc32 of the frame's ids u32), then the
                footer: entries u64, width u8, crc32 of the entries u32,
                magic 0x54534B31

Because frames are independent and the table is at the end, a reader seeks to
the footer, loads the table and decompresses only the documents asked for; any
zstandard tool still reads the file, since the table is skippable.

Writing: documents are range-partitioned and sorted by doc_id; each partition
encodes and streams one file (``shard-<n>``) into the shared folder. A task
writes under a name of its own attempt and moves it into place, so a task that
runs twice leaves one whole file; a task that is killed may leave a hidden file of
its attempt, which nothing reads. Reading back: a task for each file (up to
``max_tasks``, then neighbouring files share one), one frame in memory at a
time; file totals (one row per file) give the number of ids before each file.
Executors reach the files through pyarrow: local and shared mounts, s3 (s3a is
read as s3), gs and, where libhdfs is installed, hdfs.

Defined cases. A null or empty text is its end id alone. Null doc_ids come
first. Repeated rows are kept, each with its own frame. Empty partitions leave
a file without entries. An empty table gives an empty result. Extra columns
are ignored. A damaged frame or table raises ``ValueError``.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import shared_path, written
from .tokens import encoder, tokenizer_path

SKIPPABLE = 0x184D2A5E
FOOT_MAGIC = 0x54534B31
ENTRY = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("at", "<u8"), ("size", "<u4"), ("n", "<u8"), ("crc", "<u4")])
FOOT = struct.Struct("<QBII")


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path[len("file:") :]
    if path.startswith("s3a://"):
        path = "s3://" + path[len("s3a://") :]
    return pafs.FileSystem.from_uri(path)


def write_file(out, docs: Iterable[tuple[int | None, bytes]], width: int, level: int = 3) -> list[tuple]:
    """Write (doc_id, ids) in the given order to the binary stream ``out``."""
    comp = zstandard.ZstdCompressor(level=level)
    entries, at = [], 0
    for doc_id, ids in docs:
        frame = comp.compress(ids)
        out.write(frame)
        entries.append((doc_id or 0, doc_id is not None, at, len(frame), len(ids) // width, zlib.crc32(ids)))
        at += len(frame)
    table = np.array(entries, dtype=ENTRY).tobytes()
    out.write(struct.pack("<II", SKIPPABLE, len(table) + FOOT.size))
    out.write(table)
    out.write(FOOT.pack(len(entries), width, zlib.crc32(table), FOOT_MAGIC))
    return entries


def read_table(f, size: int) -> tuple[np.ndarray, int]:
    """Seek table and id width of an open file of ``size`` bytes."""
    if size < FOOT.size:
        raise ValueError("not a token file")
    f.seek(size - FOOT.size)
    count, width, crc, magic = FOOT.unpack(f.read(FOOT.size))
    if magic != FOOT_MAGIC or count * ENTRY.itemsize + FOOT.size > size:
        raise ValueError("not a token file")
    f.seek(size - FOOT.size - count * ENTRY.itemsize)
    raw = f.read(count * ENTRY.itemsize)
    if zlib.crc32(raw) != crc:
        raise ValueError("damaged seek table")
    return np.frombuffer(raw, dtype=ENTRY), width


def read_frames(f, table: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Ids of the documents of the given table rows, only their frames read."""
    dec = zstandard.ZstdDecompressor()
    for e in table:
        f.seek(int(e["at"]))
        ids = dec.decompress(f.read(int(e["size"])))
        if len(ids) != int(e["n"]) * width or zlib.crc32(ids) != int(e["crc"]):
            raise ValueError(f"damaged frame at {int(e['at'])}")
        yield np.frombuffer(ids, dtype=f"<u{width}")


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    kind: str = "word",
    end_id: int = 1,
) -> DataFrame:
    """Write all documents below ``path``; one row per file: shard, file, docs, ids."""
    tokenizer = tokenizer or tokenizer_path("word_bpe_49k.json")
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        enc = encoder(tokenizer, kind)
        end = np.array([end_id], dtype=enc.dtype).tobytes()

        def pairs() -> Iterator[tuple[int | None, bytes]]:
            for b in batches:
                for s in range(0, len(b), 1000):
                    p = b.slice(s, 1000)
                    ids = enc.encode(p["text"].to_pylist())
                    yield from ((d, x + end) for d, x in zip(p["doc_id"].to_pylist(), ids))

        store, base = _fs(path)
        store.create_dir(base, recursive=True)
        name = f"shard-{ctx.partitionId():06d}"
        mine = f"{base}/.{name}.{ctx.taskAttemptId()}"
        with store.open_output_stream(mine) as out:
            entries = write_file(out, pairs(), enc.dtype.itemsize)
        store.move(mine, f"{base}/{name}")
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([ctx.partitionId()], pa.int32()), "file": [f"{path}/{name}"], "docs": [len(entries)], "ids": [sum(e[4] for e in entries)]}
        )

    return written(ordered.mapInArrow(run, "shard int, file string, docs long, ids long"), "token-files")


def read_ids(files: DataFrame, with_ids: bool = False, max_tasks: int = 20_000) -> DataFrame:
    """Documents of the files that ``write_ids`` returned: doc_id, start,
    n_tokens, ids_crc32 and, if asked for, ids (unsigned 32-bit)."""
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    # one row per file, so the window is as small as the list of files
    plan = files.select("shard", "file", F.coalesce(before, F.lit(0)).alias("before"))
    # a number that is given is not lowered at run time, small as the list is
    plan = plan.repartitionByRange(max(1, min(files.count(), max_tasks)), "shard").select("file", "before")

    def documents(file: str, start: int) -> Iterator[tuple]:
        store, p = _fs(file)
        with store.open_input_file(p) as f:
            table, width = read_table(f, f.size())
            for e, ids in zip(table, read_frames(f, table, width)):
                raw = ids.astype("<u4").tobytes()
                yield int(e["doc_id"]) if e["has_id"] else None, start, len(ids), zlib.crc32(raw), raw if with_ids else b""
                start += len(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, start in zip(b["file"].to_pylist(), b["before"].to_pylist()):
                rows: list[tuple] = []
                held = 0
                for row in documents(file, start):
                    rows.append(row)
                    held += 100 + len(row[4])
                    if held >= 4 << 20:
                        yield _batch(rows, with_ids)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, with_ids)

    return plan.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    cols = list(zip(*rows))
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    arrays = [pa.array(c, pa.int64()) for c in cols[:4]]
    if with_ids:
        names, arrays = [*names, "ids"], [*arrays, pa.array(cols[4], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write the documents to new files in the shared folder and read them back."""
    path = shared_path(docs.sparkSession, "tokens")
    return read_ids(write_ids(docs, path, **options))
