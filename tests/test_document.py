"""The document that many writers leave is one JSON document in order."""

import json
from pathlib import Path

from pyspark.sql import functions as F

from fundlens.sources.document import read_sections, write_document


def _assemble(path):
    manifest = [json.loads(x) for f in sorted(Path(path, "manifest").glob("*.json")) for x in f.read_text().splitlines()]
    texts = [Path(path, "parts", f"section_no={m['section_no']}", m["file"]).read_text() for m in manifest]
    assert [len(t.encode()) for t in texts] == [m["bytes"] for m in manifest]
    return json.loads("".join(texts)), manifest


def test_document_is_ordered_and_read_back(spark, tmp_dir):
    long = spark.range(1, 20_001, numPartitions=7).select(
        F.col("id").alias("position"), F.concat(F.lit('x,{"\n] '), F.col("id")).alias("name"), (F.col("id") / 7).alias("v"),
        F.when(F.col("id") % 2 == 0, "even").alias("note")).orderBy(F.xxhash64("position"))
    one = spark.createDataFrame([("ALL", None, 1.5)], "scope string, gone string, v double")
    sections = {"summary": one, "empty": long.limit(0), "long": long, "last": one}
    path = f"{tmp_dir}/doc"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep several writers on a small table
    try:
        write_document(sections, {"empty": "position", "long": "position"}, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got, manifest = _assemble(path)
    assert list(got) == list(sections)
    assert got["summary"] == got["last"] == {"scope": "ALL", "gone": None, "v": 1.5}
    assert got["empty"] == []
    assert [r["position"] for r in got["long"]] == list(range(1, 20_001))
    assert got["long"][6] == {"position": 7, "name": 'x,{"\n] 7', "v": 1.0, "note": None}
    assert sum(m["section_no"] == 2 for m in manifest) > 1  # more than one writer
    back = read_sections(spark, path, {k: df.schema for k, df in sections.items()})
    for name, df in sections.items():
        a, b = sorted(map(tuple, df.collect()), key=str), sorted(map(tuple, back[name].collect()), key=str)
        assert a == b
