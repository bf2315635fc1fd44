"""Atomic publish, digests, key dictionaries and output contracts."""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from fundlens.operators.keys import assign_ids, extended
from fundlens.plans.serving import serving_views
from fundlens.plans.star import StarSchema
from fundlens.registry.common import mart
from fundlens.registry.contracts import MART, STAR, VIEWS, columns, digests_sql
from fundlens.sources import publish as pb
from fundlens.sources.testdata import SOURCE_VIEWS


def numbers(spark, n):
    return spark.range(n).select("id", (F.col("id") / 7).alias("x"), F.col("id").cast("string").alias("s"))


def test_readers_see_a_whole_build_or_the_one_before(spark, tmp_dir):
    names = [f"t{i}" for i in range(14)]
    assert pb.published(spark, tmp_dir) == {} and pb.damaged(spark, tmp_dir) == []
    assert pb.publish({t: numbers(spark, 5) for t in names}, tmp_dir) == 1
    broken = {t: numbers(spark, 9) for t in names}
    broken["t7"] = broken["t7"].withColumn("s", F.raise_error(F.lit("lost source")).cast("string"))
    with pytest.raises(Exception, match="lost source"):
        pb.publish(broken, tmp_dir)
    now = pb.published(spark, tmp_dir)
    assert sorted(now) == sorted(names) and {df.count() for df in now.values()} == {5}
    assert pb.publish({t: numbers(spark, 9) for t in names}, tmp_dir) == 2
    assert {df.count() for df in pb.published(spark, tmp_dir).values()} == {9}
    assert {df.count() for df in pb.published(spark, tmp_dir, 1).values()} == {5}


def test_observed_digest_equals_the_files_and_finds_damage(spark, tmp_dir):
    pb.publish({"a": numbers(spark, 100).repartition(7), "b": numbers(spark, 0)}, tmp_dir)
    rows = {r["table_name"]: r for r in pb.manifest(spark, tmp_dir)}
    again = {r["table_name"]: r for r in pb.digests(pb.published(spark, tmp_dir)).collect()}
    assert rows["a"]["digest"] == again["a"]["digest"] and rows["a"]["row_count"] == 100
    assert (rows["b"]["row_count"], rows["b"]["digest"]) == (0, "0") and pb.damaged(spark, tmp_dir) == []
    numbers(spark, 100).withColumn("s", F.lit("other")).write.mode("overwrite").parquet(rows["a"]["path"])
    assert pb.damaged(spark, tmp_dir) == ["a"]


def test_digest_equals_sql_for_every_type(spark):
    rows = [
        ("a", 1, 1.5, dt.date(2024, 2, 29), True), (None, None, None, None, None), ("", -(2**60), -0.0000004, dt.date(1970, 1, 1), False),
        ("é\n'x", 7, 1e20, dt.date(2000, 1, 1), True), ("a", 1, 1.5, dt.date(2024, 2, 29), True), ("null", 0, -1234.5678915, None, None),
    ]
    df = spark.createDataFrame(rows, "s string, i long, d double, t date, b boolean")
    con = duckdb.connect()
    con.execute("CREATE TABLE t (s VARCHAR, i BIGINT, d DOUBLE, t DATE, b BOOLEAN)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?)", rows)
    want = con.sql(digests_sql({"x": "t"}, {"x": "s i:long d:double t:date b:boolean"})).fetchall()
    assert [tuple(r) for r in pb.digests({"x": df}).collect()] == want
    moved = df.repartition(5).select("b", "t", "d", "i", "s")
    assert pb.digests({"x": moved}).first()["digest"] == want[0][2]
    changed = df.withColumn("d", F.when(F.col("i") == 7, F.lit(1.5)).otherwise(F.col("d")))
    assert pb.digests({"x": changed}).first()["digest"] != want[0][2]
    dec = df.withColumn("d", F.lit(Decimal("2.50")))
    assert pb.digests({"x": dec}).first()["digest"] == pb.digests({"x": df.withColumn("d", F.lit(2.5))}).first()["digest"]


def test_tables_and_views_keep_their_contract(spark):
    m = mart(spark, SF_SMALL)
    for tables, contracts in ((m.tables(), MART), (serving_views(m), VIEWS), (m.star.tables(), STAR)):
        assert set(tables) == set(contracts)
        for name, df in tables.items():
            got = [(c, {"bigint": "long"}.get(t, t)) for c, t in df.dtypes]
            assert got == columns(contracts[name]), name


def ids(df):
    return {r["code"]: r["id"] for r in df.collect()}


def test_ids_survive_added_and_missing_keys(spark):
    def codes(*cs):
        return spark.createDataFrame([(c, "x") for c in cs], "code string, note string")

    order = [F.col("code").asc_nulls_last()]
    first = assign_ids(codes("d", "b", None, "f"), "code", order)
    assert ids(first) == {"b": 1, "d": 2, "f": 3, None: 4}
    known = extended(None, first, "code")
    second = assign_ids(codes("a", "b", "f", None, "e"), "code", order, known)
    assert ids(second) == {"b": 1, "f": 3, None: 4, "a": 5, "e": 6}
    known = extended(known, second, "code")
    assert ids(known) == {"b": 1, "d": 2, "f": 3, None: 4, "a": 5, "e": 6}
    third = assign_ids(codes("d", "c"), "code", order, known)  # a key that comes back finds its id
    assert ids(third) == {"d": 2, "c": 7}
    assert ids(assign_ids(codes(), "code", order, known)) == {}
    assert ids(assign_ids(codes("b", "a"), "code", order, known.limit(0))) == {"a": 1, "b": 2}


class Sources(dict):
    """A mart's sources with some tables replaced."""


def test_star_refresh_keeps_ids_and_repeated_performance_rows(spark, tmp_dir):
    m = mart(spark, SF_SMALL)
    star = StarSchema(m)
    pb.publish({"funds": star.dim_funds, "funds_keys": star.key_tables()["funds_keys"]}, tmp_dir)
    old = ids(star.dim_funds)
    later = StarSchema(m, known=pb.published(spark, tmp_dir))
    src = Sources({t: m.src[t] for t in SOURCE_VIEWS})
    extra = src["funds_master_info"].limit(1).withColumn("fund_code", F.lit(" 0 before all others"))
    src["funds_master_info"] = src["funds_master_info"].where(F.col("fund_code") != min(old)).unionByName(extra)
    src["funds_performance"] = src["funds_performance"].unionByName(src["funds_performance"])
    later.src = src
    new = later.dim_funds.collect()
    assert len(new) == len(old) == len({r["code"] for r in new})
    assert all(old[r["code"]] == r["id"] for r in new if r["code"] in old)
    assert [r["id"] for r in new if r["code"] == " 0 before all others"] == [len(old) + 1]
    assert set(ids(later.key_tables()["funds_keys"])) == set(old) | {" 0 before all others"}
