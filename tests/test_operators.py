"""Operators: snapshots, ranking, top-k, as-of, upsert, payload checks."""

import datetime as dt

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from fundlens.functions.numeric import exact_sum
from fundlens.operators import quality
from fundlens.operators.distribution import attach_scalars, global_row_number, group_row_number
from fundlens.operators.snapshots import asc, desc, first_per_key, latest_snapshot, latest_snapshot_filtered
from fundlens.plans import fx_refresh as fr
from fundlens.plans.navfx import asof_join

D = dt.date


def test_first_per_key_matches_window_with_nulls(spark):
    data = [("a", 1, D(2024, 1, 1), None), ("a", 2, D(2024, 1, 2), None), ("a", 3, D(2024, 1, 2), 5.0),
            (None, 1, None, 1.0), (None, 2, D(2024, 1, 1), 2.0), ("b", 1, None, None)]
    df = spark.createDataFrame(data, "k string, id long, d date, v double")
    got = first_per_key(df, ["k"], [asc(F.col("v").isNull()), desc("d"), desc("id")])
    w = Window.partitionBy("k").orderBy(F.col("v").isNull(), F.col("d").desc_nulls_last(), F.col("id").desc())
    exp = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, exp.collect()), key=str)


def test_latest_snapshot_then_filter(spark):
    # fund F2: newest snapshot has no Fund row -> yields nothing (FIXTURES 3)
    data = [("F1", D(2024, 3, 31), "Fund", "x"), ("F1", D(2023, 12, 31), "Fund", "old"),
            ("F2", D(2024, 3, 31), "Equity", "e"), ("F2", D(2023, 12, 31), "Fund", "f"),
            (None, D(2024, 3, 31), "Fund", "nokey"), ("F3", None, "Fund", "nodate")]
    df = spark.createDataFrame(data, "fund_code string, as_of_date date, type string, name string")
    got = latest_snapshot_filtered(df, ["fund_code"], "as_of_date", F.col("type") == "Fund")
    assert [r.name for r in got.collect()] == ["x"]
    assert latest_snapshot(df, ["fund_code"], "as_of_date").count() == 2


def test_global_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("v"), F.col("id"))
    order = [F.col("v").desc(), F.col("id").asc()]
    got = global_row_number(df.repartition(7), order, "rn")
    exp = df.withColumn("rn", F.row_number().over(Window.orderBy(*order)).cast("long"))
    assert sorted(map(tuple, got.select("v", "id", "rn").collect())) == sorted(map(tuple, exp.collect()))


def test_group_row_number_with_hot_key(spark):
    # one key holds about a third of all rows and spans several partitions
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 50 != 0, (F.col("id") % 50).cast("string")).alias("g"),
        F.col("id").alias("fund"), ((F.col("id") * 7919) % 1000).cast("double").alias("v"))
    order = [F.col("v").desc(), F.col("fund").asc()]
    got = group_row_number(df, ["g"], order)
    exp = df.withColumn("rank_no", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("long"))
    assert sorted(map(str, got.collect())) == sorted(map(str, exp.collect()))


def test_exact_sum_neither_clips_nor_drops(spark):
    big = spark.createDataFrame([(5e12,), (2e13,), (3e13,)], "v double")
    assert big.agg(exact_sum("v")).first()[0] == 5.5e13
    assert spark.range(1_000_000).agg(exact_sum(F.lit(4e-7))).first()[0] == pytest.approx(0.4, abs=1e-9)
    mixed = spark.createDataFrame([(-1.25,), (None,), (0.5,)], "v double")
    assert mixed.agg(exact_sum("v")).first()[0] == -0.75


def test_asof_join_with_repeated_rates(spark):
    # two spellings and a repeated day: one row per NAV row, no rate from a later day
    fx = spark.createDataFrame(
        [("USD", D(2024, 1, 5), 35.0), ("usd", D(2024, 1, 5), 36.0), ("USD", D(2024, 1, 8), 40.0)],
        "from_ccy string, date_rate date, rate_to_thb double")
    nav = spark.createDataFrame([("USD", D(2024, 1, d)) for d in (4, 5, 6, 8, 9)], "ccy string, d date")
    got = sorted((r.d.day, r.asof_rate, r.asof_date and r.asof_date.day) for r in asof_join(nav, "ccy", "d", fx).collect())
    assert got == [(4, None, None), (5, 36.0, 5), (6, 36.0, 5), (8, 40.0, 8), (9, 40.0, 8)]


def test_missing_tables_reports_an_empty_one(spark):
    full, empty = spark.range(3), spark.range(0)
    got = quality.missing_tables({"a": full, "b": empty}, required=("a", "b", "c"))
    assert sorted(r[0] for r in got.collect()) == ["b", "c"]


def test_attach_scalars(spark):
    df = spark.range(3)
    out = attach_scalars(df, df.agg(F.sum("id").alias("s")))
    assert sorted(r.s for r in out.collect()) == [3, 3, 3]


def test_asof_join_edges(spark):
    # FIXTURES 7: exact, gap day, before the first rate, after the last, unknown ccy
    fx = spark.createDataFrame(
        [("USD", D(2024, 1, 2), 35.0), ("USD", D(2024, 1, 4), 36.0), ("EUR", D(2024, 1, 3), 38.0)],
        "from_ccy string, date_rate date, rate_to_thb double")
    nav = spark.createDataFrame(
        [("USD", D(2024, 1, 2)), ("USD", D(2024, 1, 3)), ("USD", D(2024, 1, 1)), ("USD", D(2024, 2, 1)),
         ("XXX", D(2024, 1, 3)), ("EUR", D(2024, 1, 3))], "ccy string, d date")
    got = {(r.ccy, r.d): r.asof_rate for r in asof_join(nav, "ccy", "d", fx).collect()}
    assert got == {("USD", D(2024, 1, 2)): 35.0, ("USD", D(2024, 1, 3)): 35.0, ("USD", D(2024, 1, 1)): None,
                   ("USD", D(2024, 2, 1)): 36.0, ("XXX", D(2024, 1, 3)): None, ("EUR", D(2024, 1, 3)): 38.0}


def test_upsert_new_same_and_late(spark):
    # FIXTURES 11
    cols = "date_rate date, from_ccy string, to_ccy string, rate_to_thb double, source_system string, updated_at timestamp"
    t0 = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([(D(2024, 1, 1), "USD", "THB", 35.0, "a", t0), (D(2023, 6, 1), "USD", "THB", 33.0, "a", t0)], cols)
    new = spark.createDataFrame([(D(2024, 1, 2), "USD", "THB", 36.0, "b", t0), (D(2024, 1, 1), "USD", "THB", 35.5, "b", t0),
                                 (D(2023, 6, 1), "USD", "THB", 33.3, "late", t0)], cols)
    got = {(r.date_rate, r.from_ccy): (r.rate_to_thb, r.source_system) for r in fr.upsert(old, new).collect()}
    assert got == {(D(2024, 1, 1), "USD"): (35.5, "b"), (D(2024, 1, 2), "USD"): (36.0, "b"),
                   (D(2023, 6, 1), "USD"): (33.3, "late")}


def test_payload_validity_and_cross_rates(spark):
    # FIXTURES 12: no THB, zero THB, no timestamp (falls back to now)
    payloads = [
        '{"rates": {"thb": 35.0, "usd": 1.0, "eur": 0.9, "jpy": 0.0}, "time_last_update_unix": 1704110400, "provider": ""}',
        '{"rates": {"USD": 1.0}, "time_last_update_unix": 1704110400}',
        '{"rates": {"THB": 0.0, "USD": 1.0}, "time_last_update_unix": 1704110400}',
        '{"rates": {"THB": 36.0, "USD": 1.0}}',
    ]
    df = spark.createDataFrame([(p,) for p in payloads], "payload string")
    parsed = fr.parse_payloads(df, now=F.lit("2024-05-05 00:00:00").cast("timestamp"))
    valid = [r.is_valid for r in fr.payload_valid(parsed).collect()]
    assert valid == [True, False, False, True]
    rates = {(r.date_rate, r.from_ccy): (r.rate_to_thb, r.source_system) for r in fr.cross_rates(parsed).collect()}
    assert rates[(D(2024, 1, 1), "THB")] == (1.0, "open.er-api.com")
    assert rates[(D(2024, 1, 1), "EUR")][0] == 35.0 / 0.9
    assert (D(2024, 1, 1), "JPY") not in rates  # rate 0 is skipped
    assert rates[(D(2024, 5, 5), "USD")][0] == 36.0


def test_currency_list(spark):
    got = spark.range(1).select(fr.currency_list(" usd, eur ,,")).first()[0]
    assert got == ["USD", "EUR", "THB"]
