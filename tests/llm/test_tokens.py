"""Token operators against the libraries, and file round trips."""

import hashlib
import io
import os
import tempfile
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fundlens.llm import packing, sentencepiece_codec, token_files
from fundlens.llm._shared import written
from fundlens.llm.tokens import ChunkEncoder, tokenizer_path

BYTE, WORD, PIECE = (tokenizer_path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
TEXTS = [
    None, "", " ", "a", "Hello there, world!", "a  b   c", " lead", "trail  ", "x\n \ny", "x \n\n\t y", "é ́x", "It's 's  're\x1c a \x1d",
    "<|endoftext|> a<|startoftext|>", "Σίσυφος ΣΑΣ İ", "日本語 テキスト　全角", "👩‍👩‍👧 ok", "a" * 3000, "w " * 5000, " x   y", "same", "same",
]


@pytest.fixture(scope="module")
def libs():
    b, w = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
    b.encode_special_tokens = w.encode_special_tokens = True
    return {"byte": b, "word": w, "piece": sentencepiece.SentencePieceProcessor(model_file=PIECE)}


ENCODERS = {"byte": ChunkEncoder(BYTE, "byte", limit=50, part_chars=64), "word": ChunkEncoder(WORD, "word", limit=50, part_chars=64)}
PIECES = sentencepiece_codec.PieceEncoder(PIECE)
ODD = st.text(st.one_of(st.sampled_from(" \n\t\r 　\x1c'ab.,é́İσΣ1"), st.characters(exclude_categories=("Cs",))), max_size=120)


def as_ids(enc, raw):
    return np.frombuffer(raw, enc.dtype).tolist()


@settings(max_examples=150, deadline=None)
@given(ODD)
def test_chunks_equal_the_library(libs, text):
    for kind, enc in ENCODERS.items():
        want = libs[kind].encode(text, add_special_tokens=False).ids
        assert as_ids(enc, next(enc.encode([text]))) == want


@settings(max_examples=150, deadline=None)
@given(st.one_of(ODD, st.text(st.sampled_from("aeinrst lo▁ .\n"), max_size=200)))
def test_pieces_equal_the_library(libs, text):
    ids = libs["piece"].encode(text)
    assert PIECES.encode(text) == ids


def test_backtracking_steps_back(libs):
    # runs of one letter make the longest match a wrong start again and again
    for t in ("a" * 501, "aab" * 300, "abcabc" * 200, "er" * 333, "thethethe" * 50):
        assert PIECES.encode(t) == libs["piece"].encode(t)


def saved(spark, texts, extra=False):
    rows = [(i, t, 1) for i, t in enumerate(texts)]
    return written(spark.createDataFrame(rows, "doc_id long, text string, n long"), "texts")


def test_packing_puts_every_id_in_one_place(spark, libs):
    docs = saved(spark, TEXTS).repartition(3)
    docs = written(docs, "texts")
    rows = packing.pack(docs, length=64).collect()
    want = {i: [*libs["byte"].encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(TEXTS)}
    total = sum(map(len, want.values()))
    stream = np.full(total, -1)
    for r in rows:
        ids = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        raw = np.array(ids, "<u4").tobytes()
        assert r["ids"] == raw and r["ids_crc32"] == zlib.crc32(raw) and r["doc_tokens"] == len(want[r["doc_id"]])
        at = r["sequence_id"] * 64 + r["offset"]
        assert r["offset"] + r["length"] <= 64 and (stream[at : at + r["length"]] == -1).all()
        stream[at : at + r["length"]] = ids
    assert (stream >= 0).all()
    assert sorted((r["doc_id"], r["start"], r["length"]) for r in rows) == sorted(
        (d, s, n) for d, s, n in {(r["doc_id"], r["start"], r["length"]) for r in rows}
    )


def test_packing_edges(spark):
    rows = [(None, "a b"), (1, None), (1, None)]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string"), "texts")
    got = packing.pieces(docs).collect()
    assert sum(r["length"] for r in got) == 2 + 1 + 1 + 1 and {r["sequence_id"] for r in got} == {0}
    assert packing.pieces(docs.limit(0)).count() == 0


def test_token_files_round_trip(spark, libs):
    docs = written(saved(spark, TEXTS).repartition(4), "texts")
    rows = sorted(token_files.round_trip(docs).collect(), key=lambda r: r["doc_id"])
    before = 0
    for i, (t, r) in enumerate(zip(TEXTS, rows)):
        ids = [*libs["word"].encode(t or "", add_special_tokens=False).ids, 1]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (i, before, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        before += len(ids)
    empty = docs.where("doc_id < 0")
    assert token_files.round_trip(empty).count() == 0


def test_token_files_are_read_by_one_task_each(spark):
    docs = saved(spark, [f"some text {i}" for i in range(400)], extra=True)
    path = tempfile.mkdtemp()
    files = token_files.write_ids(docs.repartition(4), path)
    names = [r["file"] for r in files.collect()]
    assert sorted(os.path.basename(n) for n in names) == sorted(f for f in os.listdir(path) if not f.startswith("."))
    got = token_files.read_ids(files, with_ids=True)
    used = got.select("*", F.spark_partition_id().alias("p"))
    assert got.rdd.getNumPartitions() == len(names) and used.count() == 400
    full = {r["file"] for r in files.where("docs > 0").collect()}
    assert used.select("p").distinct().count() == len(full)


def test_token_files_clashing_columns(spark, libs):
    rows = [(1, "a b", 7, "x", 3, 1), (None, None, None, None, None, None)]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string, start long, file string, shard int, ids long"), "texts")
    got = {r["doc_id"]: r for r in token_files.round_trip(docs).collect()}
    assert got[None]["n_tokens"] == 1 and got[1]["start"] == 1 and got[1]["n_tokens"] == 3


def test_token_files_null_and_repeated_ids(spark):
    rows = [(None, "x"), (3, "b"), (3, "a"), (3, "a")]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string"), "texts")
    got = sorted(token_files.round_trip(docs).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 3, 3, 3]
    assert [r["start"] for r in got] == [0, 2, 4, 6]


def test_file_format_reads_only_asked_frames_and_finds_damage():
    docs = [(1, np.arange(500, dtype="<u2").tobytes()), (None, b""), (9, np.arange(7, dtype="<u2").tobytes())]
    out = io.BytesIO()
    token_files.write_file(out, docs, 2)
    raw = out.getvalue()
    table, width = token_files.read_table(io.BytesIO(raw), len(raw))
    assert width == 2 and table["n"].tolist() == [500, 0, 7] and table["has_id"].tolist() == [1, 0, 1]
    broken = bytearray(raw)
    broken[5] ^= 255  # first frame
    (last,) = token_files.read_frames(io.BytesIO(bytes(broken)), table[2:], width)
    assert last.tolist() == list(range(7))
    with pytest.raises(Exception):
        list(token_files.read_frames(io.BytesIO(bytes(broken)), table[:1], width))
    broken = bytearray(raw)
    broken[-40] ^= 1  # seek table
    with pytest.raises(ValueError):
        token_files.read_table(io.BytesIO(bytes(broken)), len(raw))
    with pytest.raises(ValueError):
        token_files.read_table(io.BytesIO(b"x" * 40), 40)
    path = os.path.join(tempfile.mkdtemp(), "f")
    with open(path, "wb") as f:
        f.write(raw)
    with open(path, "rb") as f:
        assert len(list(token_files.read_frames(f, table, width))) == 3


def test_sentencepiece_query(spark, libs):
    docs = saved(spark, TEXTS)
    lib = libs["piece"]
    got = {r["doc_id"]: r for r in sentencepiece_codec.encode_decode(docs, with_ids=True).collect()}
    for i, t in enumerate(TEXTS):
        ids = lib.encode(t or "")
        text = lib.decode(ids) if ids else ""
        r = got[i]
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == text
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert sentencepiece_codec.encode_decode(docs.limit(0)).count() == 0


def test_known_chunks_stay_bounded():
    from fundlens.llm.tokens import ChunkEncoder, tokenizer_path

    enc = ChunkEncoder(tokenizer_path("byte_bpe_50k.json"), "byte")
    # idle workers keep their chunks: some 200 bytes each, two tables, one worker per core
    assert enc.limit <= 200_000
    texts = [f"qx{i} zv{i * 7}, k{i}" for i in range(500)]
    want = list(enc.encode(texts))
    small = ChunkEncoder(tokenizer_path("byte_bpe_50k.json"), "byte", limit=100)
    assert list(small.encode(texts)) == want
    assert max(map(len, small.known.values())) <= 100


def test_word_encoder_keeps_more_chunks_than_a_few_texts_hold():
    from fundlens.llm.tokens import ChunkEncoder, tokenizer_path

    enc = ChunkEncoder(tokenizer_path("word_bpe_49k.json"), "word")
    texts = [" ".join(f"w{i + k}x" for k in range(100)) for i in range(0, 250_000, 100)]
    first = list(enc.encode(texts))
    assert len(enc.known[""]) == 250_000  # 200,000 were kept before; the rest was encoded anew for each part
    assert enc.limit == 1_000_000 and not enc.known[" "]
    assert list(enc.encode(texts[-3:])) == first[-3:]
