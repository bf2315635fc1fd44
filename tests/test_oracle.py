"""Spark results equal the DuckDB oracle on the sf0.001 tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from fundlens.registry import ORACLE, QUERIES, load_all
from fundlens.sources.testdata import RAW_TABLES



def _distinct_keys() -> list[str]:
    """One key for each callable of the mart registry; aliases share it."""
    load_all()
    seen: dict[tuple, str] = {}
    for key, fn in QUERIES.items():
        if key in ORACLE:
            seen.setdefault((fn, ORACLE[key]), key)
    return sorted(seen.values())


def _norm(v):
    import datetime as dt
    import decimal

    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in RAW_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", _distinct_keys())
def test_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    s = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(entry.oracle_sql()[key])
    ocols = list(rel.columns)
    assert sorted(ocols) == cols
    idx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    o = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert s == o


def test_every_key_has_a_callable_and_oracle():
    q, o = entry.queries(), entry.oracle_sql()
    assert len(q) >= 160
    assert set(o) <= set(q)


def test_payload_sections_have_their_own_columns(spark, tmp_path):
    import json

    from fundlens.plans.serving import payload_sections, write_payload
    from fundlens.registry.common import mart

    sections = payload_sections(mart(spark, SF_SMALL))
    assert len(sections) == 13
    small = {k: sections[k] for k in ("dashboard_summary_thai", "sector_allocation_thai", "search_by_asset")}
    write_payload(small, str(tmp_path))
    rows = {k: [json.loads(x) for f in (tmp_path / k).glob("*.json") for x in f.read_text().splitlines()] for k in small}
    assert len(rows["dashboard_summary_thai"]) == 1 and rows["dashboard_summary_thai"][0]["scope"] == "TH"
    assert {"sector_name", "allocation_share_pct", "as_of_date"} <= set(rows["sector_allocation_thai"][0])
    found = sorted(r["position"] for r in rows["search_by_asset"])
    assert found == list(range(1, len(found) + 1)) and 0 < len(found) <= 500


def test_partitioned_jdbc_options():
    from fundlens.sources.readers import jdbc_options

    plain = jdbc_options("jdbc:x", "SELECT 1 AS a")
    assert plain == {"url": "jdbc:x", "query": "SELECT 1 AS a"}
    cut = jdbc_options("jdbc:x", "SELECT a FROM t", {"user": "u"}, ("a", 0, 100, 8))
    assert cut["numPartitions"] == "8" and cut["partitionColumn"] == "a" and cut["lowerBound"] == "0"
    assert "query" not in cut and cut["dbtable"].startswith("(SELECT a FROM t)") and cut["user"] == "u"


def test_wrong_values_fail_the_enum_check(spark):
    from fundlens import config
    from fundlens.operators.quality import check_row, not_accepted

    rows = spark.createDataFrame([("STOCK",), ("fund",), (None,)], "item_type string")
    bad = check_row(not_accepted(rows, "item_type", config.ITEM_TYPES), "item_type_values", 0, "n").first()
    assert (bad["status"], bad["metric"]) == ("FAIL", 2.0)


@pytest.mark.parametrize("key, label", [("view_sector_allocation", "sector_name"), ("view_country_allocation", "region_name")])
def test_allocation_views_hold_the_whole_aggregate(key, label):
    cols = [d[0] for d in duckdb_columns(entry.oracle_sql()[key])]
    assert {label, "total_true_weight_pct", "total_true_value_thb", "allocation_share_pct"} <= set(cols)
    assert QUERIES[key] is QUERIES["agg_sector_exposure" if label == "sector_name" else "agg_country_exposure"]


def duckdb_columns(sql):
    c = duckdb.connect()
    for t in RAW_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c.execute(f"SELECT * FROM ({sql}) LIMIT 0").description
