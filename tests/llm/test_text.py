"""Classifiers, license scans and quotation linking on small fixtures."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundlens.llm import chat_quotes, language_id, license_scan, toxicity
from fundlens.llm._shared import written

SF = "/root/testdata/sf0.01"


def saved(spark, rows, schema):
    return written(spark.createDataFrame(rows, schema), "rows")


# ---------------------------------------------------------------- toxicity
def pattern(text):
    g = toxicity.Grammar()
    return {k for _, _, m in g.matches(text) for k in m}


@pytest.mark.parametrize(
    "text,want",
    [
        ("You are an idiot.", {"insult+target"}),
        ("What an idiot.", {"insult"}),
        ("You are not an idiot.", {"insult-negated"}),
        ("They said he is an idiot.", {"insult-reported"}),
        ('The word "idiot" is old.', {"insult-reported"}),
        ("I will kill you", {"threat+target"}),
        ("I will never kill him", {"threat-negated"}),
        ("Idiotic? A supidiot.", {"insult"}),
        ("Nice day.\nGood food", set()),
        ("", set()),
        (None, set()),
    ],
)
def test_patterns(text, want):
    assert pattern(text) == want


def test_direct_clauses_weigh_more():
    g = toxicity.Grammar()
    s = g.scores(["you idiot", "an idiot", "not an idiot", "he said idiot", "hello", "", None])
    assert s[0] > 0.5 and s[0] > s[1] > max(s[2:]) and s[4] == s[5] == s[6]


def test_composition_equals_running_in_turn():
    a, b = toxicity._negated(), toxicity._reported()
    both = a.then(b)
    for seq in ("NI.I", 'QIQI', "RNIT", "IN...I", "TYNT"):
        state, got, sa, sb, want = both.start, [], a.start, b.start, []
        for s in seq:
            state, out = both.step(state, s)
            got.append(out)
            sa, x = a.step(sa, s)
            sb, x = b.step(sb, x)
            want.append(x)
        assert got == want


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in got)
    assert len(got) > 50 and right / len(got) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_toxicity_precision_and_recall(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    train = docs.where("text is not null")
    seen = train.where(~toxicity.held_out("doc_id")).select("text").distinct()
    grammar = toxicity.learn(docs, labels)
    # texts that both folds share would flatter the figures
    fresh = train.where(toxicity.held_out("doc_id")).join(seen, "text", "left_anti").join(labels, "doc_id").where("toxic is not null")
    got = fresh.select("toxic", (toxicity.score(grammar) >= 0.5).cast("int").alias("predicted")).collect()
    hit = sum(r["toxic"] == r["predicted"] == 1 for r in got)
    assert len(got) > 500
    assert hit >= 0.95 * sum(r["predicted"] for r in got)
    assert hit >= 0.85 * sum(r["toxic"] for r in got)
    # a word that is aimed at nobody does not decide, two do
    one, two, aimed = grammar.scores(["what an idiot it was", "an idiot and a moron", "you idiot"])
    assert one < 0.5 < two and aimed > 0.5


def test_toxicity_stems_need_significance(spark):
    rows, labels = [], []
    names = ["".join(p) for p in itertools.product("abcdefg", repeat=3)]
    for i in range(1, 241):
        bad = i % 4 == 0
        rare = " oddword" if i in (4, 8, 12) else ""  # in three toxic texts only: chance
        rows.append((i, f"some prose {names[i]} of {names[i * 7 % 50]}" + (f" grumpf {names[i + 1]}" if bad else "") + f"{rare} {names[i + 2]}"))
        labels.append((i, int(bad)))
    docs = saved(spark, rows, "doc_id long, text string")
    stems = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).stems
    assert "grum" in stems and not any(s.startswith("odd") for s in stems)


def test_toxicity_edges(spark):
    docs = saved(spark, [(1, None, 9), (2, "", 9), (2, "you idiot " * 20_000, 9), (None, "fine", 9)], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(1, None), (77, 1), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 4 and sorted(r["predicted"] for r in got) == [0, 0, 0, 1]
    assert toxicity.clean(docs, labels).columns == docs.columns and toxicity.clean(docs, labels).count() == 3
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0


# ------------------------------------------------------------- language ID
def test_filters_equal_sets():
    rng = np.random.default_rng(1)
    grams = {f"l{i}": rng.integers(1, 2**63, 500).astype(np.uint64) for i in range(70)}
    m = language_id.BitFilters.build(grams, (3,), "l0")
    assert len(m.tables) == 2 and len(m.langs) == 70
    for j in (0, 9, 63, 64, 69):
        lang = m.langs[j]
        t = m.tables[j // 64]
        hit = np.ones(500, dtype=bool)
        for p in m._places(grams[lang], m.bits, m.hashes):
            hit &= (t[p] >> t.dtype.type(j % 64)) & t.dtype.type(1) == 1
        assert hit.all()
    assert (m.false_rate < 0.05).all()


def test_gram_hashes_stay_in_their_document():
    together = language_id.gram_hashes(["ab c", "", "12", "xyz!"], (3, 4))
    for i, t in enumerate(["ab c", "", "12", "xyz!"]):
        h, _, has = language_id.gram_hashes([t], (3, 4))
        assert sorted(together[0][together[1] == i]) == sorted(h)
        assert bool(together[2][i]) == bool(has[0]) == any(c.isalpha() for c in t)


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edges(spark):
    rows = [(i, "the cat sat on the mat again", "en", 1.0) for i in range(20)] + [(i, "der hund liegt auf der matte", "de", 1.0) for i in range(20, 40)]
    rows += [(100, None, "en", 0.0), (101, "", "de", 0.0), (102, "123 !!", "de", 0.0), (103, "щука", None, 0.0), (None, "the cat", None, 0.0), (104, "der hund " * 100_000, None, 0.0)]
    docs = saved(spark, rows, "doc_id long, text string, lang string, score double")
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    assert [got[i]["lang_pred"] for i in (0, 25, 100, 101, 102, 104)] == ["en", "de", "und", "und", "und", "de"]
    assert got[103]["score"] == 0 and got[103]["lang_pred"] in ("en", "de") and got[None]["lang_pred"] == "en"
    kept = language_id.known_language(docs)
    assert kept.columns == docs.columns and kept.count() == 42
    none = language_id.identify(docs.where("doc_id in (100, 103)")).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert language_id.identify(docs.limit(0)).count() == 0


def test_language_copies_count_once(spark):
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5][:2400]  # not held out
    rng = np.random.default_rng(4)
    rows = []
    for k, i in enumerate(ids[:2000]):
        letters = ["abcdefgh", "ghijklmn"][k % 2]
        rows.append((i, " ".join("".join(rng.choice(list(letters), 4)) for _ in range(12)), ["l0", "l1"][k % 2]))
    rows += [(ids[2000 + k], f"{w} {w}{w}", "few") for k, w in enumerate(["uvw", "xyz", "vwx"])]
    plain = language_id.learn(saved(spark, rows + rows[-3:], "doc_id long, text string, lang string"), sample_rows=300)
    assert plain.langs == ["few", "l0", "l1"]
    # any row of the large language may be hot; the texts of the small one are all hot
    for hot in (rows[0], rows[2]):
        docs = saved(spark, rows + [hot] * 9000 + rows[-3:] * 3000, "doc_id long, text string, lang string")
        got = language_id.learn(docs, sample_rows=300)
        assert got.langs == plain.langs and got.bits == plain.bits
        assert all(np.array_equal(a, b) for a, b in zip(got.tables, plain.tables))


# ----------------------------------------------------------- license scans
LICENSED = {
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "Licensed under CC BY 4.0.": "CC-BY",
    "All rights reserved.": "Proprietary",
}


def test_license_scan_equals_brute_force(spark):
    texts = [f"Some prose here.\n{n}\nmore prose" for n in LICENSED] + [
        "plain words only", None, "", "He lost his driving license last year.", "x\n" * 3000 + "Released under the MIT License.", "version public",
    ]
    docs = saved(spark, [(i, t, "none") for i, t in enumerate(texts)], "doc_id long, text string, license string")
    got = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    assert len(got) == len(texts)
    for i, want in enumerate(LICENSED.values()):
        assert got[i]["license"] == want and got[i]["confirmed"] and got[i]["families"] == [want], texts[i]
    n = len(LICENSED)
    assert [got[i]["license"] for i in range(n, n + 3)] == ["none"] * 3
    assert got[n + 3]["license"] == "unknown" and got[n + 4]["license"] == "MIT" and got[n + 5]["license"] == "unknown"
    # the SQL scores against the model itself
    from fundlens.llm._shared import ROW, numbered

    base = numbered(docs.select("doc_id", "text"))
    model = license_scan.train(license_scan.negatives_of(base, 300))
    rows = license_scan.paragraphs(base, model).join(base, ROW).collect()
    for r in rows:
        p = model.probabilities(license_scan.words(r["text"].split("\n")[r["paragraph"]]))
        assert r["probability"] == pytest.approx(p.max(), abs=1e-6)
    assert license_scan.scan(docs.limit(0)).count() == 0


WRAPPED = {
    "GPL": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as "
    "published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "LGPL": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\n"
    "License as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.",
    "BSD": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following "
    "conditions\nare met:",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not\nuse this file except in compliance with\n'
    "the License.",
}


def test_license_wrapped_over_lines(spark):
    texts, want = [], []
    for family, notice in WRAPPED.items():
        starred = "/*\n * " + notice.replace("\n", "\r\n * ") + "\n */"
        words = notice.replace("\n", " ").replace(" ", "\n")
        for t in (notice, f"Some prose here.\n{notice}\nmore prose", f"{notice}\n\n{notice}", starred, f"The prose. {notice} More.", words):
            texts.append(t)
            want.append((family, True, 2 if "\n\n" in t else 1, [family]))
    texts += [
        WRAPPED["GPL"] + "\n" + WRAPPED["BSD"] + "\nAll rights reserved.\nAll rights reserved.",
        "All\nrights reserved.", "Prose here\nLicensed under CC\nBY 4.0\nand more.", "Released under\n\nthe MIT License.", "A line.\nThe public\nversion.",
    ]
    docs = saved(spark, list(enumerate(texts)), "doc_id long, text string")
    got = [(r["license"], r["confirmed"], r["n_paragraphs"], r["families"]) for r in license_scan.scan(docs).orderBy("doc_id").collect()]
    assert got[: len(want)] == want
    both, short, cc, split, none = got[len(want) :]
    assert both[1:] == (True, 4, ["BSD", "GPL", "Proprietary"])
    assert short == ("Proprietary", True, 1, ["Proprietary"]) and cc == ("CC-BY", True, 1, ["CC-BY"])
    assert not split[1] and none[0] == "unknown" and not none[1]


def test_license_plan_has_no_python(spark):
    docs = saved(spark, [(1, "Released under the MIT License.")], "doc_id long, text string")
    plan = license_scan.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# ------------------------------------------------------------ chat quotes
def chat(spark, rows):
    df = saved(spark, [(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, position string")
    return {(r["conv_id"], r["turn"]): r for r in chat_quotes.conversations(df).collect()}


def test_quotes_are_linked_and_removed(spark):
    rows = [
        (1, 0, "user", "How do I sort a list?\nIt is long."),
        (1, 1, "assistant", "Use the sort function.\n\nOr sort a copy."),
        (1, 2, "user", "New topic: files."),
        (1, 3, "user", "> Use  the SORT function.\nThanks!"),
        (1, 4, "assistant", ">> Use the sort function.\n> Thanks!\nWelcome."),
        (1, 5, None, "> nobody said this\nreally"),
        (1, 6, "user", "> New topic: files.\n> and more\nI know files."),
        (2, 0, "user", "> Use the sort function.\nother conversation"),
        (2, 1, "user", None),
    ]
    got = chat(spark, rows)
    assert len(got) == len(rows)
    parent = {k: r["parent_turn"] for k, r in got.items()}
    assert parent == {(1, 0): None, (1, 1): None, (1, 2): None, (1, 3): 1, (1, 4): 3, (1, 5): None, (1, 6): 2, (2, 0): None, (2, 1): None}
    order = [t for _, t in sorted((r["position"], k[1]) for k, r in got.items() if k[0] == 1)]
    assert order == [0, 1, 3, 4, 2, 6, 5]
    assert got[1, 4]["thread_turn"] == 1 and got[1, 4]["n_quotes"] == 2 and got[1, 4]["n_linked"] == 2
    assert got[1, 3]["formatted"] == "<|user|>\nThanks!<|end|>" and got[1, 5]["formatted"] == "<|unknown|>\nreally<|end|>"
    assert got[2, 1]["formatted"] == "<|user|>\n<|end|>"


def test_long_reply_chains_and_order(spark):
    rows = [(7, 0, "user", "line 0")] + [(7, i, "user", f"> line {i - 1}\nline {i}") for i in range(1, 40)] + [(7, 40, "user", "alone")]
    got = chat(spark, rows)
    assert all(got[7, i]["thread_turn"] == 0 and got[7, i]["position"] == i + 1 for i in range(40))
    assert got[7, 40]["position"] == 41


def test_chat_edges(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (None, 1, "user", "> a"), (1, None, "user", "> a"), (1, 5, "user", ">\n> \n")]
    df = saved(spark, rows, "conv_id long, turn long, role string, text string")
    out = chat_quotes.conversations(df).collect()
    assert len(out) == 5 and {r["parent_turn"] for r in out} == {None}
    assert sorted(r["position"] for r in out if r["conv_id"] == 1) == [1, 2, 3, 4]
    assert chat_quotes.conversations(df.limit(0)).count() == 0


def test_without_quotes_turn_order_stays(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    out = chat_quotes.conversations(df)
    assert out.count() == df.count() and out.where(F.col("position") != F.col("turn") + 1).count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_toxicity_counts_are_passed_on_early(spark):
    rows = [(i, f"grumblefoot walks by {'abcdefghijklmnopqrst'[i % 20] * 5}{i}", "en", "x") for i in range(60)]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), "docs")
    labels = written(spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int"), "labels")
    few, many = (toxicity.learn(docs, labels, held_words=n) for n in (3, 1_000_000))
    assert few.stems == many.stems and np.array_equal(few.weights, many.weights)
