"""Toxicity: a weighted finite-state pattern grammar over clauses.

A lexicon transducer turns the words of a clause into symbols (insult, threat,
target, negation, reported speech, quote mark, other). It is composed with
transducers that rewrite insults and threats in the scope of a negation, after
a reporting verb or between quote marks, and with one that marks a clause that
addresses somebody. What is left of a clause is its pattern; each
pattern's total lexicon weight is a feature, and a logistic model weighs them.
So a word alone does not decide: "not an idiot" and "they called him an idiot"
are other patterns than "you idiot", and a first insult that is aimed at nobody
is another feature than those that follow it.

Insult stems are learned from labelled documents, of equal texts one: word
beginnings of 4 to 8 letters whose share of toxic documents exceeds the base rate
significantly (Chernoff bound of the binomial tail; Benjamini-Hochberg over all
beginnings that were counted) and is at least ``precision``, in many different
contexts (words that only near copies repeat are not stems). Their weight is
their precision. The short seed list holds general words, used also where no
label exists. Pattern weights are fitted with a Gaussian prior at ``PRIOR``, so
patterns that the labels never show keep a sensible weight.

Bounds. Learning uses at most ``sample_rows`` labelled documents outside the
held-out fold (those with the smallest hash of their id); the ``max_stems`` most
significant beginnings are considered. Scoring reads whole texts; only clauses
with an insult or threat are parsed. Labels, lang, source and doc_id are no inputs
of a score.

Defined cases. Null and empty texts score like a text without a match. No
labels: seeds and prior weights. Labels that are null or of unknown documents
are ignored; of repeated labels the largest counts. Null or repeated doc_ids
and extra columns do not matter.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import held_out, written

INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER = "ITYNRQ."
SEED_INSULTS = "idiot idiots moron morons scum imbecile scumbag dumbass dummkopf idiota imbécile crétin connard trottel arschloch".split()
THREATS = "kill murder strangle stab umbringen töten erwürgen tuer assassiner étrangler matar asesinar estrangular".split()
TARGETS = "you your yourself u ya him her them du dich dir euch sie tu toi te vous ti usted ustedes él ellos".split()
NEGATIONS = "not never no isn't aren't wasn't don't won't nicht kein keine nie pas jamais aucun nunca tampoco".split()
REPORTS = (
    "said says called calls wrote writes quoted reported claimed alleged sagte nannte schrieb dit appelé écrit traité "
    "dijo llamó escribió"
).split()

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"“”«»„]")
BORDER = re.compile(r"[.!?;\n]+")
PATTERNS = ("insult", "insult-again", "insult+target", "insult-negated", "insult-reported", "threat", "threat+target", "threat-negated", "threat-reported")
PRIOR = np.array([-3.0, 1.5, 5.0, 6.0, -0.5, 0.2, 1.5, 6.0, -0.5, 0.2])  # bias, then PATTERNS


class Transducer:
    """A deterministic transducer: step(state, symbol) -> (state, output)."""

    def __init__(self, start, step):
        self.start, self._step, self._seen = start, step, {}

    def step(self, state, symbol):
        got = self._seen.get((state, symbol))
        if got is None:
            got = self._seen[state, symbol] = self._step(state, symbol)
        return got

    def then(self, other: Transducer) -> Transducer:
        """Composition: what this one writes, the other one reads."""

        def step(state, symbol):
            a, out = self.step(state[0], symbol)
            b, out = other.step(state[1], out)
            return (a, b), out

        return Transducer((self.start, other.start), step)


def _negated(scope: int = 4) -> Transducer:
    def step(left, s):
        if s == NEGATION:
            return scope, s
        return max(0, left - 1), s + "-" if left and s in (INSULT, THREAT) else s

    return Transducer(0, step)


def _reported() -> Transducer:
    def step(state, s):
        said, quoted = state
        if s == REPORT:
            return (True, quoted), s
        if s == QUOTE:
            return (said, not quoted), s
        return state, s + '"' if (said or quoted) and s in (INSULT, THREAT) else s

    return Transducer((False, False), step)


def _addressed() -> Transducer:
    """State: whether a target was read; the last state marks the clause."""
    return Transducer(False, lambda seen, s: (seen or s == TARGET, s))


_CLASSES = {w: c for c, ws in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}
_CLASSES |= {q: QUOTE for q in '"“”«»„'}


@dataclass
class Grammar:
    """Stems with weights, and the weights of the patterns."""

    stems: dict[str, float] = field(default_factory=lambda: {w: 1.0 for w in SEED_INSULTS})
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())

    def __post_init__(self):
        self._auto = None

    def __getstate__(self):
        return self.__dict__ | {"_auto": None, "_machine": None}

    def _ready(self) -> None:
        if self._auto is None:
            self._auto = ahocorasick.Automaton()
            for w in {*self.stems, *THREATS}:
                self._auto.add_word(w, len(w))
            self._auto.make_automaton()
            self._machine = _negated().then(_reported()).then(_addressed())
            self._lens = sorted({len(s) for s in self.stems})

    def _symbol(self, word: str) -> tuple[str, float]:
        c = _CLASSES.get(word)
        if c is not None:
            return c, 1.0
        for n in self._lens:
            w = self.stems.get(word[:n]) if n <= len(word) else None
            if w is not None:
                return INSULT, w
        return OTHER, 0.0

    def clause(self, clause: str) -> dict[str, float]:
        """Pattern -> weight of one lower-cased clause."""
        self._ready()
        state, found = self._machine.start, []
        for w in WORD.findall(clause):
            s, weight = self._symbol(w)
            state, out = self._machine.step(state, s)
            if s in (INSULT, THREAT):
                found.append((out, weight))
        target = state[1]
        total: dict[str, float] = {}
        for out, weight in found:
            name = "insult" if out[0] == INSULT else "threat"
            if '"' in out:
                name += "-reported"
            elif "-" in out:
                name += "-negated"
            elif target:
                name += "+target"
            total[name] = total.get(name, 0.0) + weight
        return total

    def matches(self, text: str | None) -> Iterator[tuple[int, int, dict[str, float]]]:
        """(start, end, pattern weights) of the matched clauses of a text."""
        if not text:
            return
        self._ready()
        low = text.lower()
        hits = []
        for end, n in self._auto.iter(low):
            s = end - n + 1
            if s == 0 or not low[s - 1].isalpha():
                hits.append(s)
        if not hits:
            return
        ends = [m.end() for m in BORDER.finditer(low)]
        last = -1
        for h in hits:
            i = bisect_right(ends, h)
            if i == last:
                continue
            last = i
            a, b = ends[i - 1] if i else 0, ends[i] if i < len(ends) else len(low)
            if got := self.clause(low[a:b]):
                yield a, b, got

    def features(self, text: str | None) -> np.ndarray:
        """log(1 + total weight) of each pattern. Aimed clauses count as insults
        and threats too, so their own weight is what the target adds; an
        insult weight of one is the first, the rest is ``insult-again``."""
        total = dict.fromkeys(PATTERNS, 0.0)
        for _, _, got in self.matches(text):
            for k, v in got.items():
                total[k] += v
        total["insult"] += total["insult+target"]
        total["threat"] += total["threat+target"]
        total["insult-again"] = max(0.0, total["insult"] - 1.0)
        total["insult"] = min(1.0, total["insult"])
        return np.log1p([total[k] for k in PATTERNS])

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(-1, len(PATTERNS))
        return 1 / (1 + np.exp(-(self.weights[0] + x @ self.weights[1:])))


def _beginnings(word: str) -> list[str]:
    return [word[:n] for n in range(4, min(8, len(word)) + 1)]


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W\d_]+", text.lower())


def learn(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = 20_000,
    max_stems: int = 2000,
    precision: float = 0.9,
    false_discoveries: float = 0.01,
    held_words: int = 30_000,
) -> Grammar:
    """``held_words``: beginnings that a task counts in memory before it passes
    the counts on; they are added up afterwards, so it changes no result."""
    known = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out("doc_id"))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    # at most sample_rows rows of two numbers
    sample = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
        .join(F.broadcast(known), "doc_id").select("text", "toxic"),
        "labelled",
    ).distinct()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows(c):
            return pd.DataFrame([(k, *v) for k, v in c.items()], columns=["stem", "t", "c"])

        seen: dict[str, list[int]] = {}
        for b in batches:
            for text, toxic in zip(b["text"], b["toxic"]):
                own = {p for w in set(_words(text)) for p in _beginnings(w)}
                for p in own:
                    seen.setdefault(p, [0, 0])[0 if toxic else 1] += 1
                if len(seen) > held_words:
                    yield rows(seen)
                    seen = {}
        if seen:
            yield rows(seen)

    counts = sample.mapInPandas(count, "stem string, t long, c long").groupBy("stem").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    counts = written(counts, "beginnings")
    of = sample.agg(F.avg("toxic").alias("rate")).first()["rate"] or 0.0
    tests = counts.count()
    candidates: dict[str, tuple[int, int]] = {}
    if 0 < of < 1:
        n, q = F.col("t") + F.col("c"), F.col("t") / (F.col("t") + F.col("c"))
        rest = F.when(F.col("c") > 0, (1 - q) * F.log((1 - q) / (1 - of))).otherwise(0.0)
        scored = counts.where((F.col("t") >= precision * n) & (q > of)).withColumn("bits", n * (q * F.log(q / of) + rest))
        best = scored.orderBy(F.desc("bits"), "stem").limit(max_stems).collect()  # bits: -log of the bound of the tail
        passed = [i for i, r in enumerate(best, 1) if -r["bits"] <= math.log(false_discoveries * i / tests)]
        candidates = {r["stem"]: (r["t"], r["c"]) for r in best[: max(passed, default=0)]}

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = set()
            for text in b["text"]:
                w = ["", *_words(text), ""]
                out.update((p, f"{w[i - 1]} {w[i + 1]}") for i in range(1, len(w) - 1) for p in _beginnings(w[i]) if p in candidates)
            yield pd.DataFrame(sorted(out), columns=["stem", "around"])

    stems: dict[str, float] = {}
    if candidates:
        varied = sample.where("toxic = 1").select("text").mapInPandas(contexts, "stem string, around string")
        for r in varied.groupBy("stem").agg(F.countDistinct("around").alias("n")).collect():  # at most max_stems rows
            t, c = candidates[r["stem"]]
            if r["n"] >= 0.6 * t:
                stems[r["stem"]] = (t + 0.5) / (t + c + 1)
    chosen: dict[str, float] = {}
    for s in sorted(stems, key=lambda s: (len(s), s)):
        if not any(s[:n] in chosen for n in range(4, len(s))):
            chosen[s] = stems[s]
    grammar = Grammar({w: 1.0 for w in SEED_INSULTS} | chosen)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n = Counter((int(y), *np.round(grammar.features(t), 1)) for t, y in zip(b["text"], b["toxic"]))
            yield pd.DataFrame([(*k, v) for k, v in n.items()], columns=["y", *(f"x{i}" for i in range(len(PATTERNS))), "n"])

    xs = [f"x{i}" for i in range(len(PATTERNS))]
    table = (
        sample.mapInPandas(features, "y int, " + ", ".join(f"{x} double" for x in xs) + ", n long")
        .groupBy("y", *xs).agg(F.sum("n").alias("n")).toPandas()  # at most sample_rows rows
    )
    grammar.weights = fit(table[xs].to_numpy(float), table["y"].to_numpy(float), table["n"].to_numpy(float))
    return grammar


def fit(x: np.ndarray, y: np.ndarray, n: np.ndarray, strength: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Logistic regression of weighted rows with a Gaussian prior at PRIOR."""
    order = np.lexsort([*x.T, y])  # the same sums whatever the order of rows
    x, y, n = np.column_stack([np.ones(len(x)), x])[order], y[order], n[order]
    w = PRIOR.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (n * (p - y)) + strength * (w - PRIOR)
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(grammar: Grammar, text: str = "text") -> Column:
    @F.pandas_udf("double")
    def run(t: pd.Series) -> pd.Series:
        return pd.Series(grammar.scores(t.tolist()))

    return run(F.col(text))


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    g = learn(docs, labels, **options)
    return docs.select("doc_id", held_out("doc_id").alias("held_out"), score(g).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``; all columns are kept."""
    g = learn(docs, labels, **options)
    return docs.withColumn("__score", score(g)).where(F.col("__score") < threshold).drop("__score")
