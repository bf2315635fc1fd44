"""Decontamination, filter audit and centroid clusters against brute force."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest

from fundlens.llm import centroid_clusters, decontamination, filter_audit
from fundlens.llm._shared import written
from fundlens.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
BENCH = "item_id long, text string"
DOC = "doc_id long, text string, source string, item_id long, words int"


def saved(spark, rows, schema):
    return written(spark.createDataFrame(rows, schema), "rows")


@pytest.mark.parametrize("name", ["op11_decontamination", "op12_filter_audit", "op13_centroid_clusters"])
def test_equal_to_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()
    assert want and Counter(tuple(r[c] for c in cols) for r in df.collect()) == Counter(want)


# ---------------------------------------------------------- decontamination
def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_hits(text, items, window):
    ws = plain_words(text)
    hit, ids = set(), set()
    for item, t in items:
        iw = plain_words(t)
        n = min(window, len(iw))
        wins = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(ws) - n + 1 if n else 0):
            if tuple(ws[i : i + n]) in wins:
                hit.update(range(i, i + n))
                ids.add(str(item)) if item is not None else None
    return len(ws), len(hit), sorted(ids)


LEAK = "The Größe of 3 APPLES_und, pears—is: not known (yet) 「語」 to any of us here"
ITEMS = [
    (1, LEAK), (2, "one two"), (3, "Zebra!"), (4, ""), (5, None), (6, "?! --"), (7, "one two three"), (None, "null item words"),
    (10, "a a a a a a a a a a a a"), (1, "second text of one"), (11, "ÀB İx ß"),
]
TEXTS = [
    LEAK, "before it " + LEAK.upper() + " after", LEAK.replace(" ", "\n\t--"), "one, two; three", "onetwo one", "zebra", "zebras",
    None, "", "...", "a " * 30, "a " * 9, "null ITEM words here", "second text of one two zebra", "àb i̇x ß", "Àb İx ß", "ÀB İX ß",
    " ".join(LEAK.split()[2:]) + " x " + " ".join(LEAK.split()[:9]), "x " * 50_000 + "one\0two three " + "y " * 50_000 + "é zebra",
]


@pytest.mark.parametrize("block_bytes", [256_000, 40])
def test_decontamination_equals_brute_force(spark, block_bytes):
    docs = saved(spark, [(i, t, "s", 1, 2) for i, t in enumerate(TEXTS)] + [(None, LEAK, None, None, None), (0, LEAK, "s", 1, 2)], DOC)
    bench = saved(spark, [(i, t) for i, t in ITEMS], BENCH)
    got = defaultdict(list)
    for r in decontamination.scan(docs, bench, block_bytes=block_bytes).collect():
        got[r["doc_id"]].append((r["n_words"], r["n_hit"], list(r["items"])))
    for i, t in enumerate(TEXTS):
        assert got[i] == [plain_hits(t, ITEMS, 10)] * (2 if i == 0 else 1), t
    assert got[None] == [plain_hits(LEAK, ITEMS, 10)]
    digest = {r["doc_id"]: r for r in decontamination.decontaminate(docs, bench, block_bytes=block_bytes).collect()}
    assert digest[3]["items_sha256"] == hashlib.sha256(b"2,7").hexdigest() and digest[3]["contaminated"] and digest[3]["n_items"] == 2
    assert digest[7]["items_sha256"] == hashlib.sha256(b"").hexdigest() and not digest[7]["contaminated"]


@pytest.mark.parametrize("block_bytes", [256_000, 40])
def test_decontamination_spans_lie_in_the_original(spark, block_bytes):
    text = "«Ünï» ONE...two THREE, and Zebra! zebra 語 one"
    docs = saved(spark, [(1, text, "s", 1, 2)], DOC)
    row = decontamination.scan(docs, saved(spark, ITEMS, BENCH), block_bytes=block_bytes).first()
    assert [text[a:b] for a, b in row["spans"]] == ["ONE...two THREE", "Zebra! zebra"] and row["n_hit"] == 5


def test_decontamination_empty_tables(spark):
    docs, bench = saved(spark, [(1, "one two", "s", 1, 2)], DOC), saved(spark, ITEMS, BENCH)
    assert decontamination.decontaminate(docs.limit(0), bench).count() == 0
    row = decontamination.decontaminate(docs, bench.limit(0)).first()
    assert (row["n_words"], row["n_hit"], row["n_items"], row["contaminated"]) == (2, 0, 0, False)


# ------------------------------------------------------------- filter audit
def plain_audit(counts):
    """{(order, step): [filter, kept, ...]} by filtering the masks again."""
    rows, total = {}, Counter()
    for p in permutations("ABCDE"):
        left = dict(counts)
        for step, f in enumerate(p, 1):
            bit = 1 << "ABCDE".index(f)
            gone = {m: v for m, v in left.items() if m & bit}
            left = {m: v for m, v in left.items() if not m & bit}
            n = sum(v[0] for v in gone.values())
            total[f] += n
            fails = sum(v[0] for m, v in counts.items() if m & bit)
            rows["".join(p), step] = [
                f, sum(v[0] for v in left.values()), n, fails - n, counts.get(bit, (0,))[0],
                sum(v[1] for v in gone.values()), sum(v[2] for v in gone.values()),
            ]
    return {k: (*v, total[v[0]]) for k, v in rows.items()}


@pytest.mark.parametrize("seed", range(4))
def test_diagrams_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    counts = {int(m): tuple(int(x) for x in rng.integers(0, 9, 3)) for m in rng.choice(32, [32, 20, 3, 1][seed], replace=False)}
    assert {(r[0], r[1]): r[2:] for r in filter_audit.audit(counts)} == plain_audit(counts)


def test_orders_differ_by_one_swap():
    for n in range(2, 6):
        order, seen = list(range(n)), set()
        for level in [None, *filter_audit.adjacent_swaps(n)]:
            if level is not None:
                order[level : level + 2] = order[level + 1], order[level]
            seen.add(tuple(order))
        assert len(seen) == math.factorial(n) == len(filter_audit.adjacent_swaps(n)) + 1


def test_diagram_shares_equal_nodes():
    d = filter_audit.Diagram("ABCDE", {m: (1, 0, 0) for m in range(32)})
    assert len(d.what) == 6  # one node for each level and one terminal
    for level in filter_audit.adjacent_swaps(5):
        d.swap(level)
        assert d.weight[d.root] == (32, 0, 0)
    assert len(d.what) == sum(math.factorial(5) // math.factorial(5 - n) for n in range(6))  # one for each order of the levels below


def plain_mask(text, smaller):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    caps = sum("A" <= c <= "Z" for c in text)
    conditions = (len(ws) < 50, 100 * len(set(ws)) < 65 * len(ws), 100 * caps > 5 * len(text), bool(re.search(r"[#$%&*|]", text)), text in smaller)
    return sum(1 << i for i, c in enumerate(conditions) if c)


def test_filter_audit_equals_brute_force(spark):
    many = " ".join(f"w{i}" for i in range(50))
    odd = "a b \x1c c\x0bd\x0ce\rf é" + many  # no-break space and \x1c stay inside words
    texts = [
        (5, many, "x"), (3, many, "x"), (3, many, "y"), (9, many, None), (None, many, "x"), (None, many, ""), (1, None, "x"), (2, "", None),
        (4, many + " A" * 9, "x"), (6, "A" * 6 + "é" * 114, "x"), (7, "A" * 6 + "é" * 113, "x"), (8, many + " |", "y"), (10, many + " w1" * 27, "y"),
        (11, many + " w1" * 26, "y"), (12, odd, "x"), (13, "long " * 60_000, "x"), (14, "50%", "y"), (15, many, "x"),
    ]
    labels = [(3, 1, 0), (3, 0, 1), (4, None, None), (5, 1, 1), (None, 1, 1), (99, 1, 1), (13, 0, 1), (14, 1, None)]
    docs = saved(spark, [(i, t, s, 0, 0) for i, t, s in texts], "doc_id long, text string, source string, mask int, n int")
    got = defaultdict(dict)
    for r in filter_audit.interactions(docs, saved(spark, labels, "doc_id long, quality int, toxic int")).collect():
        assert (r["filter_order"], r["step"]) not in got[r["part"]]
        got[r["part"]][r["filter_order"], r["step"]] = tuple(r)[3:]
    parts = defaultdict(lambda: defaultdict(lambda: [0, 0, 0]))
    for i, t, s in texts:
        smaller = {u or "" for j, u, _ in texts if i is not None and j is not None and j < i}
        c = parts[s or ""][plain_mask(t or "", smaller)]
        c[0] += 1
        c[1] += any(a == i and q == 1 for a, q, _ in labels) if i is not None else 0
        c[2] += any(a == i and x == 1 for a, _, x in labels) if i is not None else 0
    assert set(got) == {"", "x", "y"}
    for part, counts in parts.items():
        assert got[part] == plain_audit({m: tuple(c) for m, c in counts.items()})
    assert filter_audit.interactions(docs.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


# -------------------------------------------------------- centroid clusters
def plain_clusters(rows, k, rounds, dim):
    pts = [
        (i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(pts, key=lambda p: (p[0] is None, hashlib.sha256(f"2:{p[0]}".encode()).hexdigest() if p[0] is not None else "", p[1]))
    cents = [p[1] for p in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        got = [near(v)[1] for _, v in pts]
        new = []
        for j, c in enumerate(cents):
            own = [v for (_, v), g in zip(pts, got) if g == j]
            new.append([sum(x) // len(own) for x in zip(*own)] if own else c)
        cents = new
    last = [near(v) for _, v in pts]
    inertia = Counter()
    for d, j in last:
        inertia[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return Counter((i, j, d, inertia[j], sum(inertia.values()), sha[j]) for (i, _), (d, j) in zip(pts, last))


def run_clusters(spark, rows, **options):
    df = saved(spark, [(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, cluster int")
    out = centroid_clusters.cluster(df, **options).collect()
    return Counter((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in out)


@pytest.mark.parametrize("scale", [0.01, 1.0, 800.0])
def test_clusters_equal_brute_force(spark, scale):
    rng = np.random.default_rng(3)
    near = rng.standard_normal((12, 8)) * 4
    rows = [(i, ((near[i % 12] + rng.standard_normal(8)) * scale).tolist()) for i in range(300)]
    rows += [(i, rows[5][1]) for i in range(300, 450)]  # a hot point
    assert run_clusters(spark, rows, k=15, dim=8, pivots=4) == plain_clusters(rows, 15, 5, 8)


def test_clusters_ties_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [1.0, -inf]), (6, [1.0, 2.0, 3.0]), (None, [0.0, 0.0]), (None, [5.0, 5.0])]
    rows += [(i, [float(i % 3), 0.0]) for i in range(10, 40)] + [(11, [2.0, 0.0]), (11, [2.0, 0.0]), (11, [-0.001, 1e-9])]
    for k in (1, 4, 40):
        assert run_clusters(spark, rows, k=k, dim=2) == plain_clusters(rows, k, 5, 2)
    few = rows[:6] + [(None, [1.0, 1.0]), (7, [3.0, 3.0])]
    assert run_clusters(spark, few, dim=2) == plain_clusters(few, 40, 5, 2)
    assert run_clusters(spark, rows[:6], dim=2) == Counter()
    with pytest.raises(ValueError, match="too large"):
        run_clusters(spark, [(1, [1e30, 0.0])], dim=2)


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(5)
    pts = rng.integers(-900, 900, (400, 64))
    pts[:200] = pts[:20].repeat(10, axis=0) + rng.integers(-60, 60, (200, 64))
    s = centroid_clusters.Simplex.choose(pts[:40], 16)
    a, b = s.apexes(pts), s.apexes(pts[:40])
    true = np.sqrt(centroid_clusters.squared(pts, pts[:40]))
    flat = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(axis=2)
    low = np.sqrt(flat + (a[:, None, -1] - b[None, :, -1]) ** 2)
    high = np.sqrt(flat + (a[:, None, -1] + b[None, :, -1]) ** 2)
    assert (low <= true + 1e-6 * true.max()).all() and (true <= high + 1e-6 * true.max()).all()
    best, d = centroid_clusters.nearest(pts, a, pts[:40], b, s.margin)
    assert (d == (true**2).round().astype(int).min(axis=1)).all()
    assert (low <= high.min(axis=1)[:, None]).mean() < 1


def test_flat_pivots():
    line = np.outer(np.arange(6), np.ones(4, dtype=int)).astype(np.int64)
    s = centroid_clusters.Simplex.choose(line, 4)
    assert len(s.pivots) == 2
    same = centroid_clusters.Simplex.choose(np.ones((5, 4), dtype=np.int64), 4)
    assert len(same.pivots) == 1 and np.allclose(same.apexes(line)[:, 0] ** 2, ((line - 1) ** 2).sum(axis=1))
