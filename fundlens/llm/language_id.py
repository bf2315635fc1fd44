"""Language identification with language-bitmask n-gram filters.

Training: letter n-grams (lengths ``sizes``, word borders included) of labelled
documents are counted per language, once per document. An n-gram belongs to a
language when it is in at least ``min_share`` of its documents and at least
``ratio`` times as frequent as in the language where it is most frequent. A
Bloom filter per language holds its n-grams; the filters are bit-sliced: entry
p of one table holds bit l of every language l, so ``hashes`` look-ups and one
AND give all languages that contain an n-gram.

Prediction: per-language popcounts c over the n occurrences of a document,
corrected for false positives: (c - n f) / (1 - f), f = fill^hashes. The
language with the largest corrected count wins (ties: first by name); the
score is that count over n.

Bounds. Training uses about ``sample_rows`` distinct texts per language, chosen
by a hash of the text (all, if there are fewer), each counted once in the share
(an n-gram must be in two rows at least, copies included); the n-grams kept are at most
``max_grams`` per language, so the table that goes to the tasks has a fixed
size. Prediction reads whole texts; several languages above 64 use more tables.

Defined cases. Null text, or a text without a letter: ``und``, score 0. A text
with letters but no known n-gram: the most frequent training language, score 0.
No training rows: ``und`` everywhere. Null languages are not learned. Null or
repeated doc_ids and extra columns do not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import held_out

_ALPHA: np.ndarray | None = None


def _alpha() -> np.ndarray:
    global _ALPHA
    if _ALPHA is None:
        _ALPHA = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _ALPHA


def gram_hashes(texts: list[str], sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document index) of every n-gram of the texts, and per text
    whether it has a letter. Non-letters are one border mark per run."""
    lows = [t.lower() for t in texts]
    raw = "\0" + "\0".join(lows) + "\0"
    cp = np.frombuffer(raw.encode("utf-32-le", "replace"), dtype="<u4")
    lens = np.fromiter(map(len, lows), dtype=np.int64, count=len(lows)) + 1
    doc = np.repeat(np.arange(len(lows), dtype=np.int32), lens)
    doc = np.concatenate([doc[:1], doc])[: len(cp)]
    letter = _alpha()[cp]
    has = np.bincount(doc[letter], minlength=len(lows)) > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # a border after each word
    keep[0] = True
    cp, letter, doc = np.where(letter, cp, 0)[keep].astype(np.uint64), letter[keep], doc[keep]
    hashes, owners = [], []
    for n in sizes:
        m = len(cp) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, dtype=np.uint64)
        inner = np.ones(m, dtype=bool)
        for i in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + cp[i : i + m]
            if 0 < i < n - 1:
                inner &= letter[i : i + m]
        # a word's last letter decides the owner of n-grams that start at a border
        h = h[inner]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        hashes.append(h)
        owners.append(doc[1 : 1 + m][inner])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), has
    return np.concatenate(hashes), np.concatenate(owners), has


@dataclass
class BitFilters:
    """Bit-sliced Bloom filters of up to 64 languages for each table."""

    langs: list[str]
    sizes: tuple[int, ...]
    hashes: int
    bits: int
    tables: list[np.ndarray]
    false_rate: np.ndarray
    common: str | None

    @staticmethod
    def build(grams: dict[str, np.ndarray], sizes, common, hashes: int = 3) -> BitFilters:
        langs = sorted(grams)
        most = max([len(g) for g in grams.values()] + [1])
        bits = max(12, int(np.ceil(np.log2(most * hashes * 4))))
        tables, rates = [], []
        for s in range(0, len(langs), 64):
            part = langs[s : s + 64]
            dtype = np.uint8 if len(part) <= 8 else np.uint64
            t = np.zeros(1 << bits, dtype=dtype)
            for j, lang in enumerate(part):
                for p in BitFilters._places(grams[lang], bits, hashes):
                    t[p] |= dtype(1 << j)
                rates.append(float(((t >> dtype(j)) & dtype(1)).mean()) ** hashes)
            tables.append(t)
        return BitFilters(langs, tuple(sizes), hashes, bits, tables, np.array(rates), common)

    @staticmethod
    def _places(h: np.ndarray, bits: int, hashes: int) -> Iterator[np.ndarray]:
        low = h & np.uint64(0xFFFFFFFF)
        step = (h >> np.uint64(32)) | np.uint64(1)
        mask = np.uint64((1 << bits) - 1)
        for _ in range(hashes):
            yield ((low ^ (low >> np.uint64(bits))) & mask).astype(np.int64)
            low = (low + step) & np.uint64(0xFFFFFFFF)

    def corrected(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Corrected counts (texts x languages), n-grams and letters of texts."""
        h, owner, has = gram_hashes(texts, self.sizes)
        total = np.bincount(owner, minlength=len(texts))
        counts = np.zeros((len(texts), len(self.langs)))
        places = list(self._places(h, self.bits, self.hashes))
        for s, t in enumerate(self.tables):
            m = t[places[0]]
            for p in places[1:]:
                m = m & t[p]
            for j in range(min(64, len(self.langs) - 64 * s)):
                hit = (m >> t.dtype.type(j)) & t.dtype.type(1)
                counts[:, 64 * s + j] = np.bincount(owner, weights=hit, minlength=len(texts))
        fixed = (counts - total[:, None] * self.false_rate) / np.maximum(1 - self.false_rate, 1e-9)
        return np.clip(fixed, 0, None), total, has

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        lang, score = ["und"] * len(texts), np.zeros(len(texts))
        at = [i for i, t in enumerate(texts) if t]
        if not self.langs or not at:
            return lang, score
        s = 0
        while s < len(at):  # about a million characters at a time
            e, size = s, 0
            while e < len(at) and (e == s or size + len(texts[at[e]]) <= 1_000_000):
                size += len(texts[at[e]])
                e += 1
            c, total, has = self.corrected([texts[i] for i in at[s:e]])
            best = c.argmax(axis=1)
            for k, i in enumerate(at[s:e]):
                if has[k]:
                    top = c[k, best[k]]
                    lang[i] = self.langs[best[k]] if top > 0 else self.common
                    score[i] = min(1.0, top / max(1, total[k]))
            s = e
        return lang, score


def learn(
    docs: DataFrame,
    sizes: tuple[int, ...] = (3, 4),
    sample_rows: int = 2000,
    max_grams: int = 50_000,
    min_share: float = 0.004,
    ratio: float = 0.1,
) -> BitFilters:
    """Filters from the documents that are not held out and have a language."""
    rows = docs.where(~held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    # copies count once; a text is told by two hashes, so that no text is shuffled
    texts = rows.groupBy("lang", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(5), "text").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    # two counts per language: bounded by the number of languages
    of_lang = texts.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")).collect()
    seen = {r["lang"]: r["n"] for r in of_lang}
    if not seen:
        return BitFilters([], sizes, 3, 12, [], np.zeros(0), None)
    million = 1_000_000
    limits = F.create_map(*[F.lit(x) for r in of_lang for x in (r["lang"], max(1, min(million, million * sample_rows // r["texts"])))])
    part = rows.where(F.pmod(F.xxhash64("text", F.lit(5)), F.lit(million)) < F.element_at(limits, F.col("lang")))
    part = part.groupBy("lang", "text").agg(F.count(F.lit(1)).alias("copies"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, g in b.groupby("lang"):
                texts, copies = g["text"].tolist(), g["copies"].to_numpy()
                for s in range(0, len(texts), 200):
                    h, owner, _ = gram_hashes(texts[s : s + 200], sizes)
                    once = np.unique(np.stack([owner.astype(np.uint64), h], axis=1), axis=0)
                    v, at, n = np.unique(once[:, 1], return_inverse=True, return_counts=True)
                    held = np.bincount(at, weights=copies[s : s + 200][once[:, 0].astype(np.int64)], minlength=len(v))
                    yield pd.DataFrame({"lang": lang, "gram": v.view(np.int64), "n": n, "held": held.astype(np.int64), "docs": 0})
                yield pd.DataFrame({"lang": [lang], "gram": [0], "n": [0], "held": [0], "docs": [len(texts)]})

    counts = part.mapInPandas(count, "lang string, gram long, n long, held long, docs long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"), F.sum("held").alias("held"), F.sum("docs").alias("docs")
    )
    from ._shared import written

    counts = written(counts, "gram-counts")
    sampled = {r["lang"]: r["d"] for r in counts.groupBy("lang").agg(F.sum("docs").alias("d")).collect()}
    sampled = {k: v for k, v in sampled.items() if v}
    if not sampled:
        return BitFilters([], sizes, 3, 12, [], np.zeros(0), None)
    docs_of = F.create_map(*[F.lit(x) for la, n in sampled.items() for x in (la, float(n))])
    share = counts.where("n > 0").withColumn("share", F.col("n") / F.element_at(docs_of, F.col("lang")))
    # n-grams rare everywhere go first, so few rows meet
    common = share.where((F.col("share") >= min_share) & (F.col("held") >= 2))
    peak = common.groupBy("gram").agg(F.max("share").alias("peak"))
    chosen = common.join(peak, "gram").where(F.col("share") >= ratio * F.col("peak"))
    grams: dict[str, np.ndarray] = {}
    for lang in sorted(sampled):
        # at most max_grams rows for each language
        top = chosen.where(F.col("lang") == lang).orderBy(F.desc("share"), "gram").limit(max_grams).select("gram").toPandas()
        grams[lang] = top["gram"].to_numpy(dtype=np.int64).view(np.uint64)
    most = Counter(seen).most_common()
    return BitFilters.build(grams, sizes, min(la for la, n in most if n == most[0][1] and la in grams) if most[0][0] in grams else sorted(grams)[0])


def prediction(model: BitFilters, text: str = "text") -> Column:
    """struct(lang_pred, score) of a text column."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(t: pd.Series) -> pd.DataFrame:
        lang, score = model.predict(t.tolist())
        return pd.DataFrame({"lang_pred": lang, "score": score})

    return predict(F.col(text))


def identify(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    model = learn(docs.select("doc_id", "text", "lang"), **options)
    return docs.select("doc_id", held_out("doc_id").alias("held_out"), prediction(model).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score"
    )


def known_language(docs: DataFrame, min_score: float = 0.2, **options) -> DataFrame:
    """Rows of ``docs`` whose text has letters and, for at least ``min_score``
    of its n-grams, one known language; all columns are kept."""
    model = learn(docs.select("doc_id", "text", "lang"), **options)
    return (
        docs.withColumn("__p", prediction(model))
        .where((F.col("__p.lang_pred") != "und") & (F.col("__p.score") >= min_score))
        .drop("__p")
    )
