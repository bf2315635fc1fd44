"""Near and exact duplicates against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundlens.llm import embedding_dedup, exact_dedup, graph, ngram_join
from fundlens.llm._shared import written

DOC = "doc_id long, text string"


def saved(spark, rows, schema):
    """Rows as a written table, like every input of the operators."""
    return written(spark.createDataFrame(rows, schema), "rows")


def classes(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# ------------------------------------------------------------------ graph
@pytest.mark.parametrize(
    "links",
    [
        [],
        [(1, 2)],
        [(i, i + 1) for i in range(40)],
        [(0, i) for i in range(1, 60)],
        [(9, 9), (3, 5), (5, 3), (8, 5), (20, 21), (21, 22), (20, 22)],
    ],
)
def test_components(spark, links):
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    n = 70
    want = classes(n, links)
    assert got == {i: want[i] for i in range(n) if any(i in x and x[0] != x[1] for x in links)}


# -------------------------------------------------------------- embeddings
def vectors(seed=0, n=120, dim=16):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        base = rng.standard_normal(dim)
        out.append(base.tolist())
        for _ in range(i % 4):
            out.append((base * rng.uniform(0.5, 3) + rng.standard_normal(dim) * 0.05).tolist())
    out += [out[3], out[3], (np.array(out[5]) * 1e200).tolist()]
    return out


def embedding_truth(vs):
    x = np.array(vs, dtype=float)
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a = x @ x.T >= 0.9
    np.fill_diagonal(a, False)
    return a.sum(axis=1), classes(len(vs), zip(*np.nonzero(a)))


@pytest.mark.parametrize("block", [512, 3])
def test_embeddings_equal_brute_force(spark, block):
    vs = vectors()
    df = saved(spark, list(enumerate(vs)), "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df, tables=48, block=block).collect()}
    links, comp = embedding_truth(vs)
    assert len(got) == len(vs)
    assert [got[i]["n_links"] for i in range(len(vs))] == links.tolist()
    assert [got[i]["component_id"] for i in range(len(vs))] == comp
    assert all(got[i]["kept"] == (comp[i] == i) for i in range(len(vs)))


def test_embeddings_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, "x"), (2, [], "x"), (3, [0.0, 0.0], "x"), (4, [1.0, None], "x"), (5, [nan, 1.0], "x"), (6, [inf, 1.0], "x"),
        (7, [1.0, 0.0], "x"), (7, [1.0, 0.0], "x"), (8, [1.0, 0.0, 0.0], "x"), (9, [2.0, 0.0], "x"), (None, [-1.0, 0.0], "x"),
    ]
    df = saved(spark, rows, "vec_id long, embedding array<float>, rep string")
    got = embedding_dedup.near_duplicates(df).collect()
    by = defaultdict(list)
    for r in got:
        by[r["vec_id"]].append((r["n_links"], r["component_id"], r["kept"]))
    assert len(got) == len(rows)
    for i in (1, 2, 3, 4, 5, 6, 8):
        assert by[i] == [(0, i, True)]
    assert by[7] == [(2, 7, True)] * 2 and by[9] == [(2, 7, False)]
    assert by[None] == [(0, None, True)]
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_default_recall(spark):
    rng = np.random.default_rng(11)
    vs = []
    for _ in range(1500):  # pairs just above the threshold
        x, y = rng.standard_normal((2, 32))
        x /= np.linalg.norm(x)
        y -= (x @ y) * x
        c = rng.uniform(0.9001, 0.905)
        vs += [x.tolist(), (c * x + np.sqrt(1 - c * c) * y / np.linalg.norm(y)).tolist()]
    links, _ = embedding_truth(vs)
    df = saved(spark, list(enumerate(vs)), "vec_id long, embedding array<double>")
    found = embedding_dedup.near_duplicates(df).agg(F.sum("n_links")).first()[0]
    assert 0.99 * links.sum() <= found <= links.sum()
    assert embedding_dedup.recall(0.9) > 0.99


def test_embedding_recall_rule():
    assert embedding_dedup.recall(0.9) > 0.95 and embedding_dedup.recall(0.95) > 0.999
    assert embedding_dedup.agree(0, 1.8) == 1.0


# ----------------------------------------------------------------- n-grams
def jaccard_truth(texts, n=5, threshold=0.8):
    sets = []
    for t in texts:
        w = ngram_join.words_of(t)
        sets.append(set(zip(*(w[i:] for i in range(n)))) if len(w) >= n else {tuple(w)} if w else set())
    links = [
        (i, j)
        for i in range(len(sets)) for j in range(i)
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9
    ]
    count = Counter(k for x in links for k in x)
    return [count[i] for i in range(len(sets))], classes(len(sets), links)


def near_texts():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    out = []
    for g in range(12):
        base = [words[i] for i in rng.integers(0, 400, 60 + 10 * g)]
        for c in range(g):
            t = list(base)
            for _ in range(c % 4):
                t[rng.integers(0, len(t))] = "changed"
            out.append(" ".join(t))
    return out + ["one two", "One, two!", "two one", "a b c d e", "a b c d e f"]


@pytest.mark.parametrize("block", [512, 4])
def test_ngram_join_equals_brute_force(spark, block):
    texts = near_texts()
    df = saved(spark, list(enumerate(texts)), DOC)
    got = {r["doc_id"]: r for r in ngram_join.jaccard_join(df, block=block).collect()}
    links, comp = jaccard_truth(texts)
    assert [got[i]["n_links"] for i in range(len(texts))] == links
    assert [got[i]["class_id"] for i in range(len(texts))] == comp
    assert [i for i in got if got[i]["kept"]] == [i for i in got if comp[i] == i]


def test_ngram_join_odd_rows(spark):
    long = " ".join(f"x{i % 977}y{i}" for i in range(60_000))
    rows = [(1, None, 0), (2, "", 0), (3, "...", 0), (4, long, 0), (5, long + " end", 0), (6, "same text here", 0), (6, "same text here", 0), (None, "Same text here", 0)]
    df = saved(spark, rows, "doc_id long, text string, n_links int")
    got = ngram_join.jaccard_join(df).collect()
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append((r["n_links"], r["class_id"], r["kept"]))
    assert by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)]
    assert by[4] == [(1, 4, True)] and by[5] == [(1, 4, False)]
    assert sorted(by[6]) == [(2, 6, False), (2, 6, True)] and by[None] == [(2, 6, False)]
    assert ngram_join.jaccard_join(df.limit(0)).count() == 0


def test_bands():
    assert 1 - (1 - 0.8**7) ** ngram_join.bands_for(0.8, 7, 0.9995) >= 0.9995


# ------------------------------------------------------------- exact dedup
@pytest.mark.parametrize("block", [2048, 4, 1])
def test_exact_dedup(spark, block):
    texts = ["", None, "a", "a ", "A", "abcd", "abcdabcd", "abcdabce", "abcdabcd", "é" * 9, "é" * 9, "e" * 9, "x" * 37, "x" * 38, "x" * 37, "abcd"]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    df = saved(spark, rows, "doc_id long, text string, name string")
    got = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(df, block_bytes=block).collect()}
    same = defaultdict(list)
    for i, t in enumerate(texts):
        same[t or ""].append(i)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        g = same[t or ""]
        r = got[i]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(g), len(g), i == max(g))
        assert r["text_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_exact_dedup_repeated_rows_and_null_ids(spark):
    long = "long text " * 30_000
    rows = [(5, "t"), (5, "t"), (None, "t"), (None, "u"), (None, "u"), (7, long), (8, long), (9, long + ".")]
    got = exact_dedup.exact_duplicates(saved(spark, rows, DOC)).collect()
    t = [r for r in got if r["doc_id"] == 5]
    assert sorted(r["kept"] for r in t) == [False, True] and {r["group_size"] for r in t} == {3}
    nulls = sorted((r["group_size"], r["keep_id"], r["kept"]) for r in got if r["doc_id"] is None)
    assert nulls[0] == (2, None, False) and nulls[1] == (2, None, True) and nulls[2] == (3, 5, False)
    assert {r["doc_id"]: r["keep_id"] for r in got if r["doc_id"] in (7, 8, 9)} == {7: 8, 8: 8, 9: 9}
    assert exact_dedup.exact_duplicates(saved(spark, rows, DOC).limit(0)).count() == 0


def test_exact_dedup_uses_no_python(spark):
    df = saved(spark, [(1, "a")], DOC)
    out = exact_dedup.exact_duplicates(df).select(F.col("*"))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("min_hot", [0, 2, 1024])
def test_block_names_are_places_in_sorted_order(spark, monkeypatch, min_hot):
    """Names do not depend on files, partitions or on which keys are hot."""
    monkeypatch.setattr(exact_dedup, "MIN_HOT", min_hot)
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("ab"), rng.integers(0, 14))) for _ in range(120)] + ["abab"] * 40 + ["b" * 11] * 30
    seen = []
    for parts in (1, 7):
        df = spark.createDataFrame(list(enumerate(texts)), DOC).repartition(parts, "doc_id")
        df = exact_dedup.numbered(written(df, "rows"))
        ids = exact_dedup.identities(df, block_bytes=4).join(df, "__row").collect()
        assert len(ids) == len(texts)
        seen.append({r["doc_id"]: (r["blocks"], r["name"]) for r in ids})
    assert seen[0] == seen[1]
    by_text = defaultdict(set)
    for i, t in enumerate(texts):
        by_text[t].add(seen[0][i])
    assert all(len(v) == 1 for v in by_text.values())
    assert len({next(iter(v)) for v in by_text.values()}) == len(by_text)
    # places of the different blocks: ordered by hash, then by bytes
    blocks = {t[p : p + 4] for t in texts for p in range(0, max(1, len(t)), 4)}
    order = spark.createDataFrame([(b,) for b in blocks], "b string").selectExpr("b", "xxhash64(cast(b as binary)) h").collect()
    order = sorted(order, key=lambda r: (r["h"] % 2**64, r["b"]))
    place = {r["b"]: i for i, r in enumerate(order)}
    assert all(seen[0][i][1] == place[t] for i, t in enumerate(texts) if len(t) <= 4)
