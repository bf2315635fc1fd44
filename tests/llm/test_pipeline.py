"""The pipeline against a plain version of its stages."""

import corpus_pipeline as cp
from collections import defaultdict

from fundlens.llm._shared import table, written
from fundlens.llm.ngram_join import words_of

SF = "/root/testdata/sf0.001"


def test_stages_keep_and_drop(spark):
    docs = table(spark, SF, "documents")
    kept = [docs]
    for name, stage in cp.STAGES[:4]:
        out = written(stage(spark, kept[-1], SF), name)
        assert out.columns == docs.columns
        kept.append(out)
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in kept]
    assert ids[0] >= ids[1] >= ids[2] >= ids[3] >= ids[4] and ids[4]
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    gone = ids[0] - ids[1]
    assert all(labels.get(i) != 0 for i in gone)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    # exact copies: the largest doc_id of the texts that reach the stage
    best = {}
    for i in ids[2]:
        best[text[i]] = max(i, best.get(text[i], -1))
    assert ids[3] == set(best.values())
    # near copies: one document of each class
    left = sorted(ids[3])
    sets = {}
    for i in left:
        w = words_of(text[i])
        sets[i] = set(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else {tuple(w)}
    root = {i: i for i in left}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(left):
        for j in left[:n]:
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert ids[4] == {find(i) for i in left}


def test_run_packs_what_is_left(spark):
    rows = cp.run(spark, SF).collect()
    spans = defaultdict(list)
    for r in rows:
        spans[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(spans) == list(range(len(spans)))
    for i, s in spans.items():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at == 2048 or i == max(spans)


def test_odd_rows(spark, tmp_path):
    schema = table(spark, SF, "documents").schema
    rows = [(None, "plain words in a text", None, None, None), (1, None, "en", "s", 0), (1, "", "en", "s", 0), (2, "123", "en", "s", 3), (2, "123", "en", "s", 3)]
    rows += [(i, "some plain english words stand here", "en", "s", 5) for i in (11, 12, 13, 14, 16, 17)]
    for data in (rows, []):
        d = str(tmp_path / f"n{len(data)}")
        spark.createDataFrame(data, schema).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(11, 1, 0)][: len(data)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        out = cp.run(spark, d).collect()
        assert (len(out) > 0) == bool(data)
