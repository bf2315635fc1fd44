"""Mart rules on hand-made sources (FIXTURES.md 2-4, 6, 7) and at sf0.001."""

import datetime as dt

from pyspark.sql import functions as F

from fundlens.plans.bridge import build_bridge
from fundlens.plans.exposure import bridge_ok
from fundlens.plans.loaders import load_dataset
from fundlens.plans.mart import Mart
from fundlens.sources.testdata import TestData

from conftest import SF_SMALL

D = dt.date
TS = dt.datetime(2024, 1, 1)


def small_src(spark):
    holding = spark.createDataFrame([
        ("F1", "Master A (LU0000000001)", 80.0, D(2024, 3, 31), "Fund"),
        ("F2", "Master B (LU0000000002)", 30.0, D(2024, 3, 31), "Fund"),
        ("F2", "Master C (LU 0000000003)", 20.0, D(2024, 3, 31), "Fund"),
        ("F3", "Something (junk)", 40.0, D(2024, 3, 31), "Fund"),
        ("F3", "Other", 10.0, D(2024, 3, 31), "Fund"),
        ("F4", "Master B (LU0000000002)", 50.0, D(2023, 12, 31), "Fund"),
        ("F4", "Stock", 50.0, D(2024, 3, 31), "Equity"),
    ], "fund_code string, name string, percent double, as_of_date date, type string")
    static = spark.createDataFrame([
        ("FT1", "T1", "A1", "Fund", "lu0000000001", D(2024, 1, 1), 10.0, TS),
        ("FT2", "T2", "A2", "ETF", "LU0000000001", D(2024, 1, 1), 20.0, TS),
        ("FT3", "T3", "B", "Fund", "LU0000000002", D(2024, 1, 1), 5.0, TS),
        ("FT4", "T4", "C", "Fund", "LU0000000003", D(2024, 1, 1), 5.0, TS),
        ("FT5", "T5", "F3 trust", "Trust", "TH0000000009", D(2024, 1, 1), 999.0, TS),
        ("FT6", "T6", "F3 etf", "ETF", "TH0000000009", D(2024, 1, 1), 50.0, TS),
        ("FT7", "T7", "F3 fund", "Fund", "TH0000000009", D(2024, 1, 1), 1.0, TS),
    ], "ft_ticker string, ticker string, name string, ticker_type string, isin_number string, date_scraper date, "
       "assets_aum_full_value double, created_at timestamp")
    codes = spark.createDataFrame([("F3", "ISIN", " th0000000009 "), ("F1", "ISIN", "TH0000000009")],
                                  "fund_code string, type string, code string")
    return {"funds_holding": holding, "ft_static_detail": static, "funds_codes": codes}


def test_bridge_rules(spark):
    ds = load_dataset(spark, small_src(spark))
    b = build_bridge(ds)
    rows = {(r.fund_code, r.ft_ticker): r for r in b.collect()}
    # shared ISIN fans out to both masters (FIXTURES 2)
    assert {k for k in rows if k[0] == "F1"} == {("F1", "FT1"), ("F1", "FT2")}
    # unmapped feeders collapse to one null-master row, plus the Fund fallback (FIXTURES 4)
    assert ("F3", None) in rows and ("F3", "FT7") in rows
    assert rows[("F3", "FT7")].map_method == "thai_fund_isin_fallback"
    assert rows[("F3", "FT7")].feeder_weight_pct == 100.0
    # F1 is mapped through its feeder, so no fallback row
    assert all(r.map_method == "feeder_holding_isin" for k, r in rows.items() if k[0] == "F1")
    # newest snapshot has no Fund row (FIXTURES 3)
    assert not [k for k in rows if k[0] == "F4"]
    ok = {(r.fund_code, r.ft_ticker): r.feeder_weight_pct_norm for r in bridge_ok(b).collect()}
    assert ok[("F1", "FT1")] == 50.0 and ok[("F1", "FT2")] == 50.0  # 80 + 80 scaled to 100
    assert ok[("F2", "FT3")] == 30.0 and ok[("F2", "FT4")] == 20.0  # 30 + 20 unchanged


def test_missing_fx_table(spark):
    td = TestData(spark, SF_SMALL, missing=("daily_fx_rates",))
    nav = Mart(spark, td).nav
    statuses = {r.fx_rate_status for r in nav.select("fx_rate_status").distinct().collect()}
    assert statuses == {"default_1_no_fx_table"}
    assert nav.where("fx_rate_to_thb <> 1.0").count() == 0


def test_nav_prefers_non_null_aum(spark):
    # FIXTURES 6: newest row has null AUM, older has a value; all null
    daily = spark.createDataFrame([
        ("F1", D(2024, 2, 1), None, 1), ("F1", D(2024, 1, 1), 5.0, 2),
        ("F2", D(2024, 2, 1), None, 3), ("F2", D(2024, 1, 1), None, 4),
    ], "fund_code string, nav_date date, aum double, daily_id long")
    ds = load_dataset(spark, {"funds_daily": daily})
    got = {r.fund_code: (r.nav_as_of_date, r.aum) for r in ds.thai_nav_aum.collect()}
    assert got == {"F1": (D(2024, 1, 1), 5.0), "F2": (D(2024, 2, 1), None)}


def test_quality_report_passes_at_small_scale(spark):
    from fundlens.operators.quality import overall, report

    m = Mart(spark, TestData(spark, SF_SMALL))
    rep = report(m)
    names = [r.check_name for r in rep.collect()]
    assert len(names) == 8
    assert overall(rep).first().result in ("PASS", "FAIL")


def test_payload_sections_and_facts_are_planned_from_kept_files(spark):
    # the driver ran out of memory on plans that held the cached plans of every shared frame
    from fundlens.plans.serving import payload_sections
    from fundlens.registry.common import mart

    m = mart(spark, SF_SMALL)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (*payload_sections(m).values(), m.cards, m.sector_agg)]
    assert not any("InMemoryRelation" in p for p in plans)
    assert max(p.count("\n") for p in plans) < 80


def test_payload_export_lists_every_search_row(spark, monkeypatch):
    # the search lists of the export ended after 500 rows
    import copy

    import __spark_entry__ as entry
    from fundlens.registry import serving as reg
    from fundlens.registry.common import mart

    m = copy.copy(mart(spark, SF_SMALL))
    n = 1300
    no = F.col("id") % n  # two rows for each search row
    own = spark.range(2 * n).select(
        F.concat(F.lit("F"), no % 7).alias("fund_code"), F.format_string("Name %04d", no).alias("holding_name"),
        F.lit("").alias("holding_ticker_norm"), F.format_string("NAME %04d", no).alias("holding_key"),
        F.lit("Equity").alias("holding_type"), F.lit(0.25).alias("true_weight_pct"),
        F.when(no < 600, 0.0).when(no < 610, None).otherwise(F.floor(no / 2).cast("double")).alias("true_value_thb"))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in m.stock.schema if f.name not in own.columns]
    m.stock_shared = own.select("*", *missing)
    monkeypatch.setattr(reg, "mart", lambda *_: m)

    def want(name):
        rows = [(f"F{i % 7}", f"Name {i:04d}", 0.0 if i < 600 else None if i < 610 else i // 2 * 2.0) for i in range(n)]
        rows.sort(key=lambda r: (r[2] is None, -(r[2] or 0.0), r[0], r[1]))
        return [(i, r[name], r[2], 0.5) for i, r in enumerate(rows, 1)]

    for key, size in (("payload_export", n), ("dashboard_payload", 500)):
        got = entry.queries()[key](spark, SF_SMALL).where("section like 'search%'").collect()
        for section, name in (("search_by_fund", 0), ("search_by_asset", 1)):
            assert sorted(tuple(r[1:]) for r in got if r.section == section) == want(name)[:size], (key, section)


def test_facts_attach_nav_before_they_fan_out(spark):
    from fundlens.registry.common import mart

    m = mart(spark, SF_SMALL)
    for fact in (m.stock, m.sector, m.region):
        assert fact._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_newest_rows_equal_latest_snapshot(spark):
    from fundlens.operators.snapshots import latest_snapshot, newest_rows

    rows = spark.createDataFrame([
        ("A", D(2024, 1, 1), 1), ("A", D(2024, 2, 1), 2), ("A", D(2024, 2, 1), 2), ("A", None, 3),
        (None, D(2024, 3, 1), 4), ("B", None, 5), ("C", D(2023, 1, 1), None),
    ], "k string, d date, v int")
    got = newest_rows(rows, ["k"], "d")
    assert got.columns == rows.columns
    key = lambda r: (r.k, r.d, str(r.v))
    assert sorted(map(key, got.collect())) == sorted(map(key, latest_snapshot(rows, ["k"], "d").collect()))
    assert got.count() == 3


def test_old_rows_go_before_the_daily_aggregate(spark):
    """The semi join with the written newest dates lies below the aggregate that
    derives the daily records, and gives the rows that ranking gives."""
    from fundlens.plans.loaders import load_allocation, load_ft_static
    from fundlens.session import written

    def keep(df):
        return written(df, "test")

    src = TestData(spark, SF_SMALL)
    plan = load_ft_static(src, keep)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Aggregate") < plan.index("LeftSemi")
    ranked, kept = load_allocation(src, "sector"), load_allocation(src, "sector", keep)
    assert ranked.columns == kept.columns and ranked.count() == kept.count() and ranked.exceptAll(kept).isEmpty()


def test_static_record_without_date_and_newest_dates(spark):
    from fundlens.plans.loaders import load_ft_static

    src = small_src(spark)
    rows = [
        ("N", None, "none", "Fund", "X1", None, 1.0, TS),
        ("N", None, "later", "Fund", "X1", None, 2.0, TS + dt.timedelta(days=1)),
        ("O", None, "old", "Fund", "X2", D(2024, 1, 1), 1.0, TS + dt.timedelta(days=9)),
        ("O", None, "new", "Fund", "X2", D(2024, 1, 2), 2.0, TS),
        ("O", None, "undated", "Fund", "X2", None, 3.0, TS),
        (None, None, "nobody", "Fund", "X3", D(2024, 1, 1), 1.0, TS),
    ]
    src["ft_static_detail"] = spark.createDataFrame(rows, src["ft_static_detail"].schema)
    assert {r["ft_ticker"]: r["name"] for r in load_ft_static(src, lambda df: df).collect()} == {"N": "later", "O": "new"}
    # the date of a fund's newest snapshot is fixed over all types
    dates = {r["fund_code"]: r["as_of_date"] for r in load_dataset(spark, src).holding_dates.collect()}
    assert dates["F4"] == D(2024, 3, 31)


def test_newest_dates_filter_the_table_they_come_from(spark):
    """The newest dates drop rows below the joins that derive a table, also where
    other columns are expressions over both sides; null and repeated rows as in SQL."""
    from pyspark.sql import functions as F

    from fundlens.operators.snapshots import at_newest, latest_snapshot, newest_dates
    from fundlens.session import written

    o = spark.createDataFrame([(1, 7, D(2024, 1, 1)), (2, 7, D(2024, 2, 1)), (3, 8, D(2024, 1, 1)), (3, 8, D(2024, 1, 1)),
                               (4, None, D(2024, 3, 1)), (5, 8, None), (6, 9, D(2024, 5, 1))], "k int, f int, d date")
    line = spark.createDataFrame([(1, "a"), (2, "b"), (2, None), (3, "c"), (4, "d"), (5, "e"), (None, "f")], "k2 int, v string")
    o, line = written(o, "test"), written(line, "test")
    j = line.join(o, line["k2"] == o["k"]).select(
        F.concat(F.lit("F"), F.col("f").cast("string")).alias("fund"), F.concat("v", F.col("k").cast("string")).alias("name"), "d")
    got = at_newest(j, ["fund"], "d", written(newest_dates(j, ["fund"], "d"), "test"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Join Inner") < plan.index("Join LeftSemi")
    want = [("F7", "b2"), ("F7", None), ("F8", "c3"), ("F8", "c3")]
    for df in (got, latest_snapshot(j, ["fund"], "d")):
        assert sorted(((r["fund"], r["name"]) for r in df.collect()), key=str) == sorted(want, key=str)


def test_newest_region_rows_before_the_joins(spark):
    from fundlens.plans.loaders import Dataset, load_allocation

    src = TestData(spark, SF_SMALL)
    ds = Dataset(spark, src)
    plan = ds.ft_region._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Join LeftSemi")
    ranked = load_allocation(src, "region")
    assert ranked.columns == ds.ft_region.columns
    assert ranked.count() == ds.ft_region.count() and ranked.exceptAll(ds.ft_region).isEmpty()


def test_cards_alone_write_no_fact(spark):
    m, n = (Mart(spark, TestData(spark, SF_SMALL)) for _ in range(2))
    cards = m.cards.collect()
    assert not {"stock_shared", "sector_shared", "region_shared"} & m.__dict__.keys()
    n.stock_shared, n.sector_shared, n.region_shared  # noqa: B018  as a build asks for them
    assert n.cards.collect() == cards

def test_newest_rows_near_other_dates(spark):
    """Right whatever the other table's dates are: the same, older, newer or missing;
    rows without a partner in the derived table's join do not count."""
    from fundlens.operators.snapshots import latest_snapshot, newest_rows_near
    from fundlens.session import written

    o = written(spark.createDataFrame([(1, "a"), (1, "a2"), (2, "b"), (None, "z")], "k int, v string"), "test")
    line = written(spark.createDataFrame([
        (1, 7, D(2024, 1, 1)), (9, 7, D(2024, 2, 1)),  # the newest row has no partner
        (1, 8, D(2024, 1, 1)), (2, 8, D(2024, 3, 1)), (2, 8, D(2024, 3, 1)),  # later than the other table
        (2, 5, D(2023, 1, 1)), (1, 5, D(2022, 1, 1)),  # not in the other table
        (2, 6, D(2024, 2, 1)), (1, 6, D(2024, 1, 1)), (None, 6, D(2025, 1, 1)), (2, 6, None), (2, None, D(2024, 1, 1)),
    ], "k2 int, m int, d date"), "test")
    near = written(spark.createDataFrame([(f"T{m}", d) for m, d in [
        (7, D(2024, 2, 1)), (8, D(2024, 1, 1)), (8, None), (6, D(2024, 2, 1)), (6, D(2024, 2, 1)), (4, D(2024, 1, 1))]]
        + [(None, D(2024, 1, 1))], "t string, d date"), "test")
    j = line.join(o, line["k2"] == o["k"]).select(F.concat(F.lit("T"), F.col("m").cast("string")).alias("t"), "v", "d")
    kept = []

    def keep(df):
        kept.append(df._jdf.queryExecution().optimizedPlan().toString())
        return written(df, "test")

    got = newest_rows_near(j, ["t"], "d", near, keep)
    want = latest_snapshot(j, ["t"], "d")
    assert got.columns == j.columns
    key = lambda r: (r["t"], r["v"], r["d"])
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    assert {r["t"]: r["d"] for r in got.collect()} == {
        "T5": D(2023, 1, 1), "T6": D(2024, 2, 1), "T7": D(2024, 1, 1), "T8": D(2024, 3, 1)}
    assert 0 <= kept[0].index("Join Inner") < kept[0].index("Join LeftSemi")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Join Inner") < plan.index("Join LeftAnti")


def test_region_dates_join_no_old_line_items(spark):
    """Every join with orders reads line items near the newest dates only, and the
    facts' bridge holds the facts' columns only."""
    from fundlens.plans.loaders import Dataset, load_allocation

    src, plans = TestData(spark, SF_SMALL), []

    def keep(df):
        from fundlens.session import written

        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return written(df, "test")

    got, ranked = Dataset(spark, src, keep).ft_region, load_allocation(src, "region")
    assert ranked.count() == got.count() and ranked.exceptAll(got).isEmpty()
    joined = [p for p in plans if "o_orderkey" in p]
    assert joined and all("Join LeftSemi" in p for p in joined)


def test_kept_bridge_has_the_columns_of_the_facts(spark):
    from fundlens.registry.common import mart

    m = mart(spark, SF_SMALL)
    assert not {"token", "token_isin", "name", "ticker_type", "as_of_date"} & set(m.bridge_nav.columns)
    assert m.stock.count() > 0
    assert any(f.endswith(".zstd.parquet") for f in m.bridge_nav.inputFiles())
