"""License scans: a trained paragraph classifier, DataFrame functions only.

A paragraph (line) is scored by a multinomial logistic regression on sparse
word n-grams (single words and pairs); its classes are the licence families
plus ``unknown``. Features are n-grams that contain a cue word, i.e. a word of
the licence notices below that is not a function word, so a paragraph without a
cue word has no feature: it is unknown by its bias alone and is skipped without
a loss. A prediction is confirmed when enough of the word pairs of a notice of
the predicted family occur in the paragraph.

A notice may be wrapped over lines. So runs of neighbouring lines with words
are scored joined as well, up to ``REACH`` words between the first and the last
line and ``REACH`` words of each of these two. A run is a match if it is
confirmed by a notice to which both its first and its last line add word pairs.
Of confirmed matches (lines and runs) that share a line, the largest overlap is
kept, then the fewest lines, the probability and the place; it counts as one
paragraph. Lines of a confirmed run, and lines that go on with its last sentence
(as far as ``REACH`` words from the first line), count only if confirmed by
themselves and not part of a better match.

Training happens once, on the driver, on a bounded sample: the notices, seeded
variants of them (words dropped or surrounded by other words), fixed unrelated
sentences that use cue words, and at most ``negatives`` paragraphs of the corpus
that hold a cue word but hardly any notice text. Temperature scaling on held-out
variants calibrates the probabilities; a best family below ``min_probability``
is reported as unknown.

Main path: split, explode (lines, and runs that hold notice word pairs), a broadcast join with the weights (one row per
feature, a few hundred), and aggregates; no Python on the executors.

Output: one row per document: doc_id, license (family with the best
paragraph, ``unknown`` if a cue paragraph fits no family, ``none`` without cue
words), probability, confirmed, n_paragraphs (that name a family), families
(sorted). ``paragraphs`` returns the scored lines themselves, ``joined`` the
confirmed runs.

Defined cases. Null and empty texts: ``none``, probability 0. Ties between
paragraphs: the earliest one; between families: first in FAMILIES. Null or
repeated doc_ids are separate rows. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import math
import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import ROW, numbered

# Short notices in the wording that each licence's publisher gives.
NOTICES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0": [
        "Released under CC0 1.0, dedicated to the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "Proprietary": [
        "All rights reserved.",
        "Copyright, all rights reserved. No part may be reproduced without written permission.",
    ],
}
FAMILIES = tuple(NOTICES)
UNRELATED = [
    "He lost his driving license last year.", "The software was released in spring.", "A new version of the song was released.",
    "The general public may attend the meeting.", "The library is open to the public.", "The apache helicopter landed.",
    "This program starts at eight.", "She has a license to teach.", "The source of the river is unknown.",
    "Use of the form is free of charge.", "It is a free work of art.", "The foundation published its report.",
    "The conditions of the road are bad.", "The clause of the contract was changed.", "International law and human rights.",
    "They reserved a table for four.", "The author gave permission to copy the file.", "The terms were fair and the person agreed.",
]
STOP = set(
    "a an and any are as at be been by can do for from has have his her if in is it its last may no not of on or part "
    "she the them they this to up was were where which with without you your he all that following under but".split()
)
WORD_SQL = r"[\p{L}\p{N}]+"
END_SQL = r"""[.!?:][\s*/#"')\]-]*$"""  # a line that ends a sentence


def words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


REACH = 2 * max(len(words(n)) for ns in NOTICES.values() for n in ns)  # the longest notice, with as many other words


def cue_words() -> list[str]:
    return sorted({w for ns in NOTICES.values() for n in ns for w in words(n) if w not in STOP and not w.isdigit() and len(w) > 1})


def features(ws: list[str], cues: set[str]) -> set[str]:
    pairs = {f"{a} {b}" for a, b in zip(ws, ws[1:]) if a in cues or b in cues}
    return {w for w in ws if w in cues} | pairs


class LicenseModel:
    """Sparse weights: feature -> one weight per class (last class: unknown)."""

    def __init__(self, names: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.names, self.weights, self.bias, self.temperature = names, weights, bias, temperature
        self.cues = set(cue_words())

    def probabilities(self, ws: list[str]) -> np.ndarray:
        at = {f: i for i, f in enumerate(self.names)}
        z = self.bias + sum((self.weights[at[f]] for f in features(ws, self.cues) if f in at), np.zeros(len(self.bias)))
        e = np.exp((z - z.max()) / self.temperature)
        return e / e.sum()


def _variants(rng: random.Random, n: int, filler: list[str]) -> tuple[list[list[str]], list[int]]:
    xs, ys = [], []
    for y, family in enumerate(FAMILIES):
        for notice in NOTICES[family]:
            xs.append(words(notice))
            ys.append(y)
            for _ in range(n):
                w = [v for v in words(notice) if rng.random() > 0.06]
                left = [rng.choice(filler) for _ in range(rng.randint(0, 8))]
                right = [rng.choice(filler) for _ in range(rng.randint(0, 8))]
                xs.append(left + w + right)
                ys.append(y)
    for s in UNRELATED:
        for _ in range(max(1, n // 3)):
            w = words(s)
            cut = rng.randint(0, max(0, len(w) - 3))
            xs.append([rng.choice(filler) for _ in range(rng.randint(0, 5))] + w[cut:] + [rng.choice(filler)])
            ys.append(len(FAMILIES))
    cues = cue_words()
    for _ in range(15 * n):  # cue words in no licence wording
        xs.append([rng.choice(filler) for _ in range(4)] + [rng.choice(cues)] + [rng.choice(filler) for _ in range(4)])
        ys.append(len(FAMILIES))
    return xs, ys


def train(negatives: list[str], variants: int = 12, strength: float = 0.02, steps: int = 300, seed: int = 3) -> LicenseModel:
    """Fit on the notices and the given unrelated paragraphs."""
    rng = random.Random(seed)
    filler = sorted(STOP) + [w for t in negatives[:50] for w in words(t)[:20]] + ["lorem", "ipsum", "dolor", "amet"]
    xs, ys = _variants(rng, variants, filler)
    xs += [words(t) for t in negatives]
    ys += [len(FAMILIES)] * len(negatives)
    hx, hy = _variants(rng, 4, filler)
    cues = set(cue_words())
    names = sorted({f for n in (x for ns in NOTICES.values() for x in ns) for f in features(words(n), cues)})
    at = {f: i for i, f in enumerate(names)}
    k = len(FAMILIES) + 1

    def matrix(rows):
        x = np.zeros((len(rows), len(names) + 1))
        x[:, -1] = 1
        for i, r in enumerate(rows):
            x[i, [at[f] for f in features(r, cues) if f in at]] = 1
        return x

    x, y = matrix(xs), np.eye(k)[ys]
    share = 1 / (y.sum(axis=0)[ys] * k)  # every class counts the same
    w = np.zeros((len(names) + 1, k))
    w[-1, -1] = 1.0
    m = np.zeros_like(w)
    v = np.zeros_like(w)
    for t in range(1, steps + 1):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = x.T @ ((p - y) * share[:, None])
        g[:-1] += strength * w[:-1] / len(names)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    w[np.abs(w) < 1e-3] = 0
    hz, hy = matrix(hx) @ w, np.array(hy)

    def loss(temp):
        z = hz / temp
        z = z - z.max(axis=1, keepdims=True)
        return -(z[np.arange(len(hy)), hy] - np.log(np.exp(z).sum(axis=1))).mean()

    temperature = float(min(np.linspace(0.5, 4, 36), key=loss))
    return LicenseModel(names, np.round(w[:-1], 6), np.round(w[-1], 6), temperature)


def _trie(ws: list[str]) -> str:
    """One pattern for the words, branching once for each letter."""
    out = []
    for c in sorted({w[0] for w in ws if w}):
        rest = _trie([w[1:] for w in ws if w[:1] == c])
        out.append(c + rest)
    body = out[0] if len(out) == 1 else "(?:" + "|".join(out) + ")" if out else ""
    return f"(?:{body})?" if body and "" in ws else body


def _cue_pattern() -> str:
    return r"(?<![\p{L}\p{N}])" + _trie(cue_words()) + r"(?![\p{L}\p{N}])"


def cue_paragraphs(docs: DataFrame) -> DataFrame:
    """(ROW, paragraph number, paragraph) of the paragraphs with a cue word."""
    cue = _cue_pattern()
    return (
        docs.select(ROW, F.lower("text").alias("low"))
        .where(F.col("low").rlike(cue))
        .select(ROW, F.posexplode(F.split("low", "\n")).alias("paragraph", "body"))
        .where(F.col("body").rlike(cue))
    )


def _word_array(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(f"({WORD_SQL})"))


def _pairs(w: Column) -> Column:
    return F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.size(w)), lambda a, b: F.concat_ws(" ", a, b))


def paragraphs(docs: DataFrame, model: LicenseModel, min_probability: float = 0.5, min_overlap: float = 0.6) -> DataFrame:
    """(ROW, paragraph, family, probability, overlap, confirmed) of every
    paragraph with a cue word. ``docs`` is numbered by ROW."""
    templates = docs.sparkSession.createDataFrame(_templates(), "family string, pairs array<string>")
    found = cue_paragraphs(docs).select(ROW, "paragraph", _word_array(F.col("body")).alias("words"))
    found = found.withColumn("pairs", F.array_distinct(_pairs(F.col("words"))))
    scored = _scored(found, [ROW, "paragraph"], [], model, min_probability)
    # template comparison: best share of a notice's word pairs found in the paragraph
    named = scored.where("family <> 'unknown'").join(found.select(ROW, "paragraph", "pairs"), [ROW, "paragraph"])
    overlap = (
        named.join(F.broadcast(templates.withColumnRenamed("pairs", "notice")), "family")
        .groupBy(ROW, "paragraph")
        .agg(F.max(F.size(F.array_intersect("pairs", "notice")) / F.size("notice")).alias("overlap"))
    )
    return (
        scored.join(overlap, [ROW, "paragraph"], "left")
        .withColumn("overlap", F.coalesce("overlap", F.lit(0.0)))
        .withColumn("confirmed", F.col("overlap") >= min_overlap)
    )


def _templates() -> list[tuple[str, list[str]]]:
    """(family, word pairs) of each notice."""
    return [(family, sorted({" ".join(p) for p in zip(words(n), words(n)[1:])})) for family in FAMILIES for n in NOTICES[family]]


def _scored(found: DataFrame, keys: list[str], carried: list[str], model: LicenseModel, min_probability: float) -> DataFrame:
    """(keys, carried, family, probability) of rows with words and pairs."""
    k = len(FAMILIES) + 1
    # one row for each feature of the model
    weights = found.sparkSession.createDataFrame(
        [(f, [float(v) for v in row]) for f, row in zip(model.names, model.weights)], "feature string, w array<double>"
    )
    grams = found.select(
        *keys, *carried, F.explode(F.concat(F.array_distinct("words"), "pairs")).alias("feature")
    ).join(F.broadcast(weights), "feature")
    logits = grams.groupBy(*keys).agg(
        *[(F.sum(F.col("w")[i]) + F.lit(float(model.bias[i]))).alias(f"z{i}") for i in range(k)],
        *[F.first(c).alias(c) for c in carried],  # the same in every row of a key
    )
    top = F.greatest(*[F.col(f"z{i}") for i in range(k)])
    odds = [F.exp((F.col(f"z{i}") - F.col("top")) / F.lit(model.temperature)) for i in range(k)]
    total = odds[0]
    for o in odds[1:]:
        total = total + o
    best = F.when(F.col(f"z{k - 1}") >= F.col("top"), F.lit("unknown"))
    for i, family in enumerate(FAMILIES):
        best = best.when(F.col(f"z{i}") >= F.col("top"), F.lit(family))
    scored = logits.withColumn("top", top).select(*keys, *carried, best.alias("family"), (F.lit(1.0) / total).alias("probability"))
    return scored.withColumn("family", F.when(F.col("probability") >= min_probability, F.col("family")).otherwise("unknown"))


def _runs(docs: DataFrame) -> DataFrame:
    """(ROW, first line number, lines that runs from there can take) for every
    line with words; a line is a struct of its words, whether it has a cue and
    whether it ends a sentence."""
    cue = _cue_pattern()
    lines = (
        docs.select(ROW, F.lower("text").alias("low"))
        .where(F.col("low").contains("\n") & F.col("low").rlike(cue))
        .select(ROW, F.transform(F.split("low", "\n"), lambda s: F.struct(_word_array(s).alias("w"), s.rlike(cue).alias("cue"), s.rlike(END_SQL).alias("end"))).alias("lines"))
    )

    def step(acc: Column, x: Column) -> Column:
        n = acc["n"] + F.size(x["w"])
        more = F.struct((acc["k"] + 1).alias("k"), n.alias("n"), (n < REACH).alias("open"))
        return F.when(acc["open"] & (F.size(x["w"]) > 0), more).otherwise(F.struct(acc["k"].alias("k"), acc["n"].alias("n"), F.lit(False).alias("open")))

    def near(i: Column) -> Column:
        none = F.struct(F.lit(0).alias("k"), F.lit(0).alias("n"), F.lit(True).alias("open"))
        return F.slice("lines", i + 1, F.aggregate(F.slice("lines", i + 2, F.lit(REACH + 1)), none, step)["k"] + 1)

    starts = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.size(F.get("lines", i)["w"]) > 0)
    found = F.filter(
        F.transform(starts, lambda i: F.struct(i.alias("paragraph"), near(i).alias("near"))),
        lambda r: (F.size(r["near"]) > 1) & F.exists(r["near"], lambda x: x["cue"]),
    )
    return lines.select(ROW, F.explode(found).alias("r")).select(ROW, "r.paragraph", "r.near")


def joined(docs: DataFrame, model: LicenseModel, min_probability: float = 0.5, min_overlap: float = 0.6) -> DataFrame:
    """(ROW, paragraph, last, until, family, probability, overlap, confirmed) of
    the confirmed runs of two or more lines: numbers of the first and last line
    and of the line where the last sentence ends."""
    notices = _templates()
    least = min(math.ceil(min_overlap * len(pairs)) for _, pairs in notices)
    known = F.array(*[F.lit(p) for p in sorted({p for _, pairs in notices for p in pairs})])
    runs = _runs(docs).select(ROW, "paragraph", "near", F.explode(F.sequence(F.lit(2), F.size("near"))).alias("n"))
    runs = runs.where(F.exists(F.slice("near", 1, F.col("n")), lambda x: x["cue"]))
    w = F.col("near")[0]["w"]
    first = F.slice(w, F.greatest(F.size(w) - REACH + 1, F.lit(1)), F.lit(REACH))
    middle = F.flatten(F.transform(F.slice("near", 2, F.col("n") - 2), lambda x: x["w"]))
    last = F.slice(F.get("near", F.col("n") - 1)["w"], 1, REACH)
    rest = F.slice("near", F.col("n"), F.size("near") - F.col("n") + 1)
    end = F.array_position(F.transform(rest, lambda x: x["end"]), F.lit(True)).cast("int")
    end = F.col("paragraph") + F.col("n") - 1 + F.when(end > 0, end - 1).otherwise(F.size("near") - F.col("n"))
    runs = runs.select(
        ROW, "paragraph", (F.col("paragraph") + F.col("n") - 1).alias("last"), end.alias("until"), F.concat(first, middle, last).alias("words"),
        F.concat(first, middle).alias("head"), F.concat(middle, last).alias("tail"),
    )
    pairs = lambda c: F.array_distinct(_pairs(F.col(c)))
    runs = runs.where(F.size(F.array_intersect(pairs("words"), known)) >= least)
    runs = runs.select(ROW, "paragraph", "last", "until", "words", pairs("words").alias("pairs"), pairs("head").alias("head"), pairs("tail").alias("tail"))
    templates = F.array(*[F.struct(F.lit(f).alias("family"), F.array(*[F.lit(p) for p in ps]).alias("notice")) for f, ps in notices])

    def overlap(t: Column) -> Column:
        shared = lambda c: F.size(F.array_intersect(F.col(c), t["notice"]))
        gains = (shared("pairs") > shared("head")) & (shared("pairs") > shared("tail"))
        return F.struct(t["family"].alias("family"), F.when(gains, shared("pairs") / F.size(t["notice"])).otherwise(0.0).alias("overlap"))

    # generated rows, so the overlaps are computed once
    runs = runs.select(ROW, "paragraph", "last", "until", "words", "pairs", F.explode(F.array(F.transform(templates, overlap))).alias("overlaps"))
    runs = runs.where(F.exists("overlaps", lambda o: o["overlap"] >= min_overlap))
    scored = _scored(runs, [ROW, "paragraph", "last"], ["until", "overlaps"], model, min_probability)
    own = F.transform(F.filter("overlaps", lambda o: o["family"] == F.col("family")), lambda o: o["overlap"])
    return (
        scored.withColumn("overlap", F.coalesce(F.array_max(own), F.lit(0.0))).drop("overlaps")
        .where(F.col("overlap") >= min_overlap).withColumn("confirmed", F.lit(True))
    )


def _per_document(hits: DataFrame) -> DataFrame:
    """(ROW, hits): the scored lines and confirmed runs of a document. If it has
    runs, confirmed matches that share a line with a better one are left out,
    and so are other lines within a run and its last sentence."""
    hit = F.struct(
        (-F.col("overlap")).alias("less"), (F.col("last") - F.col("paragraph")).alias("more"), (-F.round("probability", 6)).alias("unlikely"),
        "paragraph", "last", "until", "family", F.round("probability", 6).alias("probability"), "confirmed",
    )
    # at most one hit for each line with a cue word, and the runs
    docs = hits.groupBy(ROW).agg(F.sort_array(F.collect_list(hit)).alias("hits"), F.max(F.col("last") > F.col("paragraph")).alias("wrapped"))
    meets = lambda a, b: (a["paragraph"] <= b["last"]) & (b["paragraph"] <= a["last"])
    docs = docs.withColumn("best", F.filter("hits", lambda h: h["confirmed"]))
    taken = F.aggregate(
        "best", F.filter("best", lambda h: F.lit(False)),
        lambda acc, h: F.when(F.exists(acc, lambda t: meets(t, h)), acc).otherwise(F.concat(acc, F.array(h))),
    )
    within = lambda h, t: (t["paragraph"] <= h["paragraph"]) & (h["paragraph"] <= t["until"])
    left = F.filter("hits", lambda h: ~h["confirmed"] & ~F.exists("best", lambda t: within(h, t)))
    return docs.select(ROW, F.when(F.col("wrapped"), F.concat(taken, left)).otherwise(F.col("hits")).alias("hits"))


def negatives_of(docs: DataFrame, limit: int) -> list[str]:
    """At most ``limit`` corpus paragraphs with a cue word and hardly any
    notice text, by hash order."""
    head = r"licen[sc]e|copyright|rights reserved|creative commons|\bcc\b|\bgnu\b|permission is hereby|redistribut"
    rows = (
        cue_paragraphs(docs).where(~F.col("body").rlike(head) & (F.length("body") <= 2000)).select("body").distinct()
        .orderBy(F.xxhash64("body"), "body").limit(limit)
    )
    return [r["body"] for r in rows.collect()]


def scan(docs: DataFrame, negatives: int = 300, min_probability: float = 0.5, min_overlap: float = 0.6) -> DataFrame:
    """One row per row of ``docs`` (a scan): doc_id, license, probability,
    confirmed, n_paragraphs, families."""
    base = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    model = train(negatives_of(base, negatives))
    lines = paragraphs(base, model, min_probability, min_overlap)
    lines = lines.withColumns({"last": F.col("paragraph"), "until": F.col("paragraph")})
    hits = _per_document(lines.unionByName(joined(base, model, min_probability, min_overlap)))
    named = lambda h: h["family"] != "unknown"
    # a named family before unknown, confirmed before not, then probability, then place
    order = F.transform("hits", lambda h: F.struct(
        named(h).alias("named"), h["confirmed"].alias("confirmed"), h["probability"].alias("probability"), (-h["paragraph"]).alias("place"),
        h["family"].alias("family"),
    ))
    families = F.transform(F.filter("hits", named), lambda h: h["family"])
    per_doc = hits.select(ROW, F.array_max(order).alias("top"), families.alias("named")).select(
        ROW, F.col("top.family").alias("license"), "top.probability", "top.confirmed",
        F.size("named").cast("long").alias("n_paragraphs"), F.array_sort(F.array_distinct("named")).alias("families"),
    )
    return base.select(ROW, "doc_id").join(per_doc, ROW, "left").select(
        "doc_id",
        F.coalesce("license", F.lit("none")).alias("license"),
        F.coalesce("probability", F.lit(0.0)).alias("probability"),
        F.coalesce("confirmed", F.lit(False)).alias("confirmed"),
        F.coalesce("n_paragraphs", F.lit(0).cast("long")).alias("n_paragraphs"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
    )
