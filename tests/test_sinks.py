"""Sinks and the table catalog."""

from pyspark.sql import functions as F

from fundlens.sources.catalog import profile, samples
from fundlens.sources.sinks import fx_alias_view, write_tables

from conftest import SF_SMALL


def test_alias_view_and_writes(spark, tmp_dir):
    fx = spark.createDataFrame(
        [("2024-01-01", "USD", "THB", 35.0, "s", None)],
        "date_rate string, from_ccy string, to_ccy string, rate_to_thb double, source_system string, updated_at timestamp")
    fx_alias_view(fx)
    prof = {(r.column_name, r.data_type) for r in profile({"dim_fx_rates": spark.table("dim_fx_rates")}).collect()}
    assert ("rate_to_thb", "double") in prof and len(prof) == 6
    paths = write_tables({"fx": fx.select(F.col("from_ccy"))}, tmp_dir)
    assert spark.read.parquet(paths["fx"]).count() == 1


def test_profile_of_odd_columns(spark):
    df = spark.createDataFrame(
        [(1, [1.0], {"a": 1}, None), (2, None, None, None), (2, [1.0], {"a": 1}, None)],
        "k int, xs array<double>, m map<string,int>, `odd name` string")
    rows = {r.column_name: r for r in profile({"t": df, "none": df.limit(0)}).collect() if r.table_name == "t"}
    assert (rows["k"].smallest, rows["k"].largest, rows["k"].distinct_estimate) == ("=1", "=2", 2)
    assert rows["xs"].null_count == 1 and rows["xs"].smallest is None and rows["xs"].distinct_estimate == 1
    assert rows["m"].distinct_estimate is None and abs(rows["m"].null_share - 1 / 3) < 1e-12
    assert rows["odd name"].null_count == 3 and rows["odd name"].smallest == "null"
    empty = profile({"none": df.limit(0)}).collect()
    assert len(empty) == 4 and {(r.row_count, r.null_share) for r in empty} == {(0, None)}
    got = samples({"t": df.select("k", "odd name")}, {"t": ["k"]}, n=2).orderBy("position").collect()
    assert [r.row_text for r in got] == ["=1|null", "=2|null"]


def test_estimates_lie_within_their_error(spark):
    """Relative standard error 0.02: five of them at most, on every column."""
    tables = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("orders", "lineitem", "events")}
    for r in profile(tables).collect():
        exact = tables[r.table_name].select(F.countDistinct(r.column_name)).first()[0]
        assert abs(r.distinct_estimate - exact) <= max(1, 0.1 * exact), r
