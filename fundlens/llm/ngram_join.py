"""N-gram Jaccard self-join: MinHash banding, then full n-gram sets.

Words are the \\w+ runs of the lower-cased text; the n-grams of a document are
its runs of ``n`` words (a shorter document that has a word is one n-gram).
Links are pairs with Jaccard similarity >= ``threshold`` on n-gram sets.

``bands_for`` picks the number of bands so that a pair exactly at the
threshold shares a band with probability >= ``target_recall``: with 7 rows and
0.8 it is 33 bands for 0.9995 (0.85: 0.99999). Band keys are the shuffle keys.

Scale. One pass turns a text into a 16-byte digest of its words and its band
keys; texts with equal words collapse to one representative with a count, so
copies are never paired. Band buckets join documents into candidate groups
(stars around the smallest member, then connected components), so each text is
moved once, not once for each band. A candidate group above ``block`` documents
or ``block_bytes`` is split into blocks; every pair of blocks is a group of its
own, so no pair is lost and no task holds more than two blocks. Pairs are
verified on exact n-gram sets and come back as per-document link counts and
one star per linked set, never as pairs.

Defined cases. Null, empty or wordless texts link with nothing, not even with
each other. Repeated rows and copies are linked (similarity 1). ``class_id``
is the smallest doc_id of the class (null ids only if no other). An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import ROW, block_pairs, grouped_batches, numbered, union_find_stars, written
from .graph import components

WORDS = re.compile(r"\w+")


def bands_for(threshold: float, rows: int, target_recall: float) -> int:
    return max(1, math.ceil(math.log(1 - target_recall) / math.log(1 - threshold**rows)))


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


class _WordHash(dict):
    """word -> 64-bit hash; emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def ngram_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of each run of n words (of all words if there are fewer)."""
    n = min(n, len(word_hashes))
    m = len(word_hashes) - n + 1
    h = np.zeros(m, dtype=np.uint64)
    for i in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + word_hashes[i : i + m]
    return _mix(h)


def band_keys(grams: np.ndarray, mult: np.ndarray, add: np.ndarray, rows: int) -> np.ndarray:
    """Band keys of one document: hash of ``rows`` minima for each band."""
    low = np.full(len(mult), np.iinfo(np.uint64).max, dtype=np.uint64)
    for s in range(0, len(grams), 256):  # stays in cache
        np.minimum(low, (grams[s : s + 256, None] * mult + add).min(axis=0), out=low)
    low = _mix(low).reshape(-1, rows)
    key = np.zeros(len(low), dtype=np.uint64)
    for r in range(rows):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + low[:, r])
    return key.view(np.int64)


def signatures(docs: DataFrame, n: int, bands: int, rows: int, seed: int) -> DataFrame:
    """(ROW, doc_id, digest binary, bytes, keys array<long>); digest and keys
    are null for a text without words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng(seed)
        mult = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        add = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
        known = _WordHash()
        for b in batches:
            digests, keys, sizes = [], [], []
            for text in b["text"]:
                words = words_of(text)
                sizes.append(len(text) if text else 0)
                if not words:
                    digests.append(None)
                    keys.append(None)
                    continue
                h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
                digests.append(xxhash.xxh3_128_digest(" ".join(words)))
                keys.append(band_keys(ngram_hashes(h, n), mult, add, rows))
            yield pd.DataFrame(
                {ROW: b[ROW], "doc_id": b["doc_id"].astype("Int64"), "digest": digests, "bytes": sizes, "keys": keys}
            )

    return docs.select(ROW, F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        run, f"{ROW} long, doc_id long, digest binary, bytes long, keys array<long>"
    )


def ngram_links(
    docs: DataFrame,
    n: int = 5,
    threshold: float = 0.8,
    rows: int = 7,
    target_recall: float = 0.9995,
    block: int = 512,
    block_bytes: int = 16 << 20,
    seed: int = 11,
) -> DataFrame:
    """One row per row of ``docs`` (numbered by ROW): ROW, doc_id, n_links,
    class_id, kept (the first row of its class in ROW order of the smallest
    doc_id)."""
    bands = bands_for(threshold, rows, target_recall)
    sig = written(signatures(docs, n, bands, rows, seed), "signatures")
    worded = sig.where("digest is not null")
    reps = written(
        worded.groupBy("digest").agg(
            F.min(ROW).alias("rep"), F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"),
            F.max("bytes").alias("bytes"), F.min("keys").alias("keys"),
        ),
        "representatives",
    )
    # candidate groups: a bucket of two is one link, a larger one a star
    keyed = reps.select("rep", F.posexplode("keys").alias("band", "key"))
    buckets = keyed.groupBy("band", "key").agg(
        F.min("rep").alias("v"), F.max("rep").alias("u"), F.count(F.lit(1)).alias("size")
    ).where("size > 1")
    buckets = written(buckets, "buckets")
    stars = keyed.join(buckets.where("size > 2").select("band", "key", "v"), ["band", "key"]).select(
        F.col("rep").alias("u"), "v"
    )
    cand = components(buckets.where("size = 2").select("u", "v").unionByName(stars))
    sized = cand.withColumnRenamed("node", "rep").join(reps.select("rep", "n", "bytes"), "rep")
    group = sized.groupBy("component").agg(F.count(F.lit(1)).alias("members"), F.sum("bytes").alias("total"))
    members = sized.select("rep", "n", "component").join(group, "component").withColumn(
        "nb", F.greatest(F.ceil(F.col("members") / block), F.ceil(F.col("total") / block_bytes))
    )
    texts = docs.select(F.col(ROW).alias("rep"), "text").join(members, "rep")
    units = block_pairs(texts, F.col("nb"), F.col("rep")).select("component", "bi", "bj", "side", "rep", "n", "text", "nb")

    def check(g: pd.DataFrame) -> pd.DataFrame:
        return _check_group(g, n, threshold)

    found = written(
        grouped_batches(units, ["component", "bi", "bj"], check, "rep long, links long, to long, whole boolean"), "links"
    )
    # a group of one block is settled by its own task; the rest needs all blocks
    spread = components(found.where("not whole").select(F.col("rep").alias("u"), F.col("to").alias("v")))
    settled = found.where("whole").select(F.col("rep").alias("node"), F.col("to").alias("component"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    info = (
        reps.select("digest", "rep", "n", "low")
        .join(links, "rep", "left")
        .join(settled.unionByName(spread).withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "digest", "rep", "low", F.coalesce("component", "rep").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        )
    )
    firsts = worded.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", ROW)).alias("first")
    )
    info = written(info.join(firsts, "digest"), "classes")
    names = info.groupBy("component").agg(F.min("first").alias("head"))
    info = info.join(names, "component").select("digest", "n_links", "head")
    out = worded.select(ROW, "doc_id", "digest").join(info, "digest").select(
        ROW, "doc_id", "n_links", F.col("head.doc_id").alias("class_id"), (F.col(ROW) == F.col(f"head.{ROW}")).alias("kept")
    )
    rest = sig.where("digest is null").select(
        ROW, "doc_id", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id"), F.lit(True).alias("kept")
    )
    return out.unionByName(rest)


def jaccard_join(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_links, class_id, kept for every row of ``docs`` (a scan)."""
    return ngram_links(numbered(docs.select("doc_id", "text")), **options).drop(ROW)


def _gram_ids(texts: list[str], n: int) -> list[np.ndarray]:
    """Exact n-gram sets as sorted integer ids, numbered within the group."""
    ids: dict = {}
    out = []
    for t in texts:
        w = words_of(t)
        grams = set(zip(*(w[i:] for i in range(n)))) if len(w) >= n else {tuple(w)}
        out.append(np.fromiter((ids.setdefault(g, len(ids)) for g in grams), dtype=np.int64, count=len(grams)))
    return out


def _check_group(g: pd.DataFrame, n: int, threshold: float) -> pd.DataFrame:
    whole = bool(g["nb"].iloc[0] == 1)
    same = g["bi"].iloc[0] == g["bj"].iloc[0]
    side = g["side"].to_numpy()
    a = np.flatnonzero(side == 0)
    b = a if same else np.flatnonzero(side == 1)
    none = pd.DataFrame({"rep": [], "links": [], "to": []}, dtype="int64").assign(whole=pd.Series(dtype=bool))
    if not len(a) or not len(b) or (same and len(a) < 2):
        return none
    sets = _gram_ids(g["text"].tolist(), n)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    # only n-grams of two documents or more can be shared
    often = np.bincount(flat) > 1
    keep = often[flat]
    flat, owner = (np.cumsum(often) - 1)[flat[keep]], owner[keep]
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    shared = np.zeros((len(a), len(b)), dtype=np.float32)
    at_a = np.full(len(sets), -1)
    at_a[a] = np.arange(len(a))
    at_b = np.full(len(sets), -1)
    at_b[b] = np.arange(len(b))
    width = 8192 if len(sets) > 64 else 1 << 20
    for s in range(0, int(flat[-1]) + 1 if len(flat) else 0, width):
        lo, hi = np.searchsorted(flat, [s, s + width])
        cols = min(width, int(flat[-1]) + 1 - s)
        f, o = flat[lo:hi] - s, owner[lo:hi]
        ma = np.zeros((len(a), cols), dtype=np.float32)
        p = at_a[o] >= 0
        ma[at_a[o[p]], f[p]] = 1
        if same:
            mb = ma
        else:
            mb = np.zeros((len(b), cols), dtype=np.float32)
            p = at_b[o] >= 0
            mb[at_b[o[p]], f[p]] = 1
        shared += ma @ mb.T
    both = shared.astype(np.float64)
    hit = both >= threshold * (size[a][:, None] + size[b][None, :] - both) - 1e-9
    if same:
        hit &= np.tri(len(a), k=-1, dtype=bool)
    i, j = np.nonzero(hit)
    if not len(i):
        return none
    i, j = a[i], b[j]
    rep, weight = g["rep"].to_numpy(), g["n"].to_numpy()
    links = np.bincount(i, weights=weight[j], minlength=len(g)) + np.bincount(j, weights=weight[i], minlength=len(g))
    order = np.argsort(rep, kind="stable")
    place = np.empty(len(g), dtype=np.int64)
    place[order] = np.arange(len(g))
    low = rep[order][union_find_stars(len(g), place[i], place[j])[place]]
    at = np.flatnonzero(links)
    return pd.DataFrame({"rep": rep[at], "links": links[at].astype("int64"), "to": low[at], "whole": whole})
