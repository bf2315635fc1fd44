"""Mart keys: loaders, bridge, NAV/FX, facts, aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import config
from ..oracle import stages  # noqa: F401  (registers oracle blocks)
from ..oracle.stages import HOLDING_ORDER
from ..operators.snapshots import latest_snapshot
from ..plans import bridge as br
from ..plans import exposure as ex
from ..plans.loaders import load_allocation, load_fx_rates
from ..plans.navfx import clean_fx, fund_currency, fx_latest_per_ccy, nav_with_fx
from ..plans.loaders import load_dataset
from . import register
from .common import mart, test_data


def alias(keys: list[str], oracle: str | None):
    """Register one Spark callable under several keys."""

    def deco(fn):
        for k in keys:
            register(k, oracle)(fn)
        return fn

    return deco


# ---------------- loaders ----------------
@alias(["scan_projected"], "SELECT * FROM o_thai_funds")
def q_scan_projected(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).ds.thai_funds


@alias(["scan_schema_drift"], "SELECT * FROM o_ft_region")
def q_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    return load_allocation(test_data(spark, sf), "region")


@alias(["scan_optional_empty"], "SELECT * FROM o_nav_nofx")
def q_optional_empty(spark: SparkSession, sf: str) -> DataFrame:
    src = test_data(spark, sf, missing=("daily_fx_rates",))
    return nav_with_fx(load_dataset(spark, src))


@alias(["latest_nav_prefer_nonnull"], "SELECT * FROM o_thai_nav_aum")
def q_latest_nav(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).ds.thai_nav_aum


JOIN_LATEST_SQL = stages.latest_snapshot(
    "funds_holding", "fund_code", "as_of_date",
    "h.fund_code, h.symbol, h.name, h.type, h.sector, h.percent, h.as_of_date")


@alias(["join_latest_snapshot"], JOIN_LATEST_SQL)
def q_join_latest(spark: SparkSession, sf: str) -> DataFrame:
    h = test_data(spark, sf)["funds_holding"]
    return latest_snapshot(h, ["fund_code"], "as_of_date")


@alias(["join_latest_snapshot_multikey", "filter_in_list"], """
SELECT a.fund_code, a.type, a.name, a.percent, a.as_of_date::DATE AS as_of_date FROM funds_allocations a
JOIN (SELECT fund_code, type, max(as_of_date) AS d FROM funds_allocations
      WHERE type IN ('sector_alloc', 'country_alloc') AND fund_code IS NOT NULL AND as_of_date IS NOT NULL
      GROUP BY fund_code, type) l
  ON a.fund_code = l.fund_code AND a.type = l.type AND a.as_of_date = l.d
WHERE a.name IS NOT NULL AND trim(a.name) <> ''""")
def q_join_latest_multikey(spark: SparkSession, sf: str) -> DataFrame:
    from ..plans.star import latest_allocations

    return latest_allocations(test_data(spark, sf)["funds_allocations"])


@alias(["snapshot_then_filter"], "SELECT * FROM o_thai_feeder")
def q_snapshot_then_filter(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).ds.thai_feeder


@alias(["latest_static"], "SELECT * FROM o_ft_static")
def q_latest_static(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).ds.ft_static


@alias(["latest_return"], "SELECT * FROM o_ft_return")
def q_latest_return(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).ds.ft_return


@alias(["filter_literal_eq"], "SELECT * FROM o_fx_rates")
def q_filter_literal_eq(spark: SparkSession, sf: str) -> DataFrame:
    return load_fx_rates(spark, test_data(spark, sf))


@alias(["filter_nonblank", "str_upper_trim"], "SELECT * FROM o_thai_isin")
def q_filter_nonblank(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).ds.thai_isin


# ---------------- bridge ----------------
@alias(["extract_token", "token_isin"], "SELECT * FROM o_feeder_tok")
def q_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return br.feeder_with_tokens(mart(spark, sf).ds.thai_feeder)


@alias(["join_bridge_isin"], "SELECT * FROM o_bridge_feeder")
def q_bridge_feeder(spark: SparkSession, sf: str) -> DataFrame:
    m = mart(spark, sf)
    return br.bridge_feeder(br.feeder_with_tokens(m.ds.thai_feeder), br.static_isin_ready(m.ds.ft_static))


@alias(["join_fund_isin_inner"], """
SELECT i.fund_code, i.isin_code, s.ft_ticker, s.ticker, s.name, s.ticker_type
FROM o_thai_isin i JOIN o_static_ready s ON i.isin_code = s.isin_number""")
def q_fund_isin_inner(spark: SparkSession, sf: str) -> DataFrame:
    m = mart(spark, sf)
    s = br.static_isin_ready(m.ds.ft_static)
    j = m.ds.thai_isin.join(s, m.ds.thai_isin["isin_code"] == s["isin_number"], "inner")
    return j.select("fund_code", "isin_code", "ft_ticker", "ticker", "name", "ticker_type")


@alias(["anti_mapped_funds"], """
SELECT i.fund_code, i.isin_code FROM o_thai_isin i
WHERE NOT EXISTS (SELECT 1 FROM o_bridge_feeder b WHERE b.ft_ticker IS NOT NULL AND b.fund_code = i.fund_code)""")
def q_anti_mapped(spark: SparkSession, sf: str) -> DataFrame:
    m = mart(spark, sf)
    bf = br.bridge_feeder(br.feeder_with_tokens(m.ds.thai_feeder), br.static_isin_ready(m.ds.ft_static))
    return m.ds.thai_isin.join(br.mapped_funds(bf), "fund_code", "left_anti")


@alias(["distinct_rows"], "SELECT DISTINCT fund_code FROM o_bridge_feeder WHERE ft_ticker IS NOT NULL")
def q_distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    m = mart(spark, sf)
    bf = br.bridge_feeder(br.feeder_with_tokens(m.ds.thai_feeder), br.static_isin_ready(m.ds.ft_static))
    return br.mapped_funds(bf)


@alias(["fallback_best_master", "proj_align_union", "map_to_priority"], "SELECT * FROM o_bridge_fallback")
def q_fallback(spark: SparkSession, sf: str) -> DataFrame:
    m = mart(spark, sf)
    static = br.static_isin_ready(m.ds.ft_static)
    bf = br.bridge_feeder(br.feeder_with_tokens(m.ds.thai_feeder), static)
    return br.bridge_fallback(m.ds.thai_isin, static, br.mapped_funds(bf))


@alias(["union_bridge"], f"""
SELECT {stages.BRIDGE_COLS} FROM o_bridge_feeder UNION ALL SELECT {stages.BRIDGE_COLS} FROM o_bridge_fallback""")
def q_union_bridge(spark: SparkSession, sf: str) -> DataFrame:
    m = mart(spark, sf)
    static = br.static_isin_ready(m.ds.ft_static)
    bf = br.bridge_feeder(br.feeder_with_tokens(m.ds.thai_feeder), static)
    return bf.unionByName(br.bridge_fallback(m.ds.thai_isin, static, br.mapped_funds(bf)))


@alias(["bridge_thai_master", "bridge_priority_dedupe"], "SELECT * FROM o_bridge")
def q_bridge(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).bridge


@alias(["filter_positive_mapped", "null_to_zero", "to_float"], "SELECT * FROM o_bridge_pos")
def q_bridge_pos(spark: SparkSession, sf: str) -> DataFrame:
    return ex.bridge_mapped(mart(spark, sf).bridge)


@alias(["normalize_weights", "safe_ratio"], "SELECT * FROM o_bridge_ok")
def q_bridge_ok(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).bridge_ok


# ---------------- NAV / FX ----------------
@alias(["nav_with_fx", "fx_exact_join", "fx_latest_overall_join", "fx_status_fact", "coalesce_chain", "fx_convert",
        "to_date_lenient"], "SELECT * FROM o_nav")
def q_nav(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).nav


@alias(["join_currency_dim"], "SELECT * FROM o_fund_ccy")
def q_fund_ccy(spark: SparkSession, sf: str) -> DataFrame:
    return fund_currency(mart(spark, sf).ds.thai_funds)


@alias(["filter_valid_fx"], "SELECT * FROM o_fx_clean")
def q_fx_clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_fx(mart(spark, sf).ds.fx_rates)


@alias(["latest_per_ccy"], "SELECT * FROM o_fx_latest")
def q_fx_latest(spark: SparkSession, sf: str) -> DataFrame:
    return fx_latest_per_ccy(clean_fx(mart(spark, sf).ds.fx_rates))


@alias(["stg_nav_aum_native", "dedupe_keep_first"], "SELECT * FROM o_stg_nav")
def q_stg_nav(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).stg_nav


@alias(["vw_nav_aum_thb", "fx_asof_join", "fx_status_case"], "SELECT * FROM o_vw_nav")
def q_vw_nav(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).vw_nav_aum_thb


# ---------------- facts ----------------
@alias(["agg_dedupe_max_holdings"], "SELECT * FROM o_holdings_dedup")
def q_dedupe_holdings(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["ticker", "holding_name", "holding_ticker", "holding_type", "date_scraper"]
    return ex.dedupe_max(mart(spark, sf).ds.ft_holdings, keys, "portfolio_weight_pct")


@alias(["agg_dedupe_max_alloc"], f"""
SELECT ticker, category_name, date_scraper, max({stages.f0('weight_pct')}) AS weight_pct FROM o_ft_sector
WHERE ticker IS NOT NULL AND category_name IS NOT NULL AND date_scraper IS NOT NULL
GROUP BY ticker, category_name, date_scraper""")
def q_dedupe_alloc(spark: SparkSession, sf: str) -> DataFrame:
    return ex.dedupe_max(mart(spark, sf).ds.ft_sector, ["ticker", "category_name", "date_scraper"], "weight_pct")


@alias(["fact_exposure_stock", "lookthrough_stock", "proj_fact_columns", "holding_key", "pct_product"],
       "SELECT * FROM o_stock")
def q_stock(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).stock


@alias(["join_nav_value"], """
SELECT fund_code, ft_ticker, ticker, sector_name, aum, true_weight_pct, true_value_thb, fx_rate_status FROM o_sector""")
def q_join_nav_value(spark: SparkSession, sf: str) -> DataFrame:
    s = mart(spark, sf).sector
    return s.select("fund_code", "ft_ticker", "ticker", "sector_name", "aum", "true_weight_pct", "true_value_thb",
                    "fx_rate_status")


@alias(["fact_exposure_sector", "lookthrough_sector", "proj_rename"], "SELECT * FROM o_sector")
def q_sector(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).sector


@alias(["fact_exposure_region", "lookthrough_region", "is_country_label"], "SELECT * FROM o_region")
def q_region(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).region


@alias(["agg_fund_coverage", "fund_coverage", "agg_feeder_total_clip", "agg_mapped_weight", "coverage_join",
        "clip_bounds"], "SELECT * FROM o_coverage")
def q_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).coverage


@alias(["join_returns_nullsafe"], "SELECT * FROM o_fund_ret")
def q_fund_ret(spark: SparkSession, sf: str) -> DataFrame:
    m = mart(spark, sf)
    return ex.fund_returns(m.bridge_ok, m.ds.ft_return, m.nav)


@alias(["avg_fund_return", "agg_weighted_avg"], "SELECT * FROM o_avg_return")
def q_avg_return(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).returns


# ---------------- aggregates ----------------
@alias(["agg_top_holdings", "rank_global", "blank_to_null"], "SELECT * FROM o_top_holdings")
def q_top_holdings(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).top_holdings


@alias(["topn_holdings"], f"""
SELECT *, row_number() OVER (ORDER BY {HOLDING_ORDER}) AS rank_no FROM o_top_unranked ORDER BY {HOLDING_ORDER} LIMIT {config.TOP_N}""")
def q_topn(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).top_holdings_topn


@alias(["agg_sector_exposure", "share_of_total", "view_sector_allocation"], "SELECT * FROM o_sector_agg")
def q_sector_agg(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).sector_agg


@alias(["topn_sector"], f"""
SELECT * FROM o_sector_agg ORDER BY total_true_value_thb DESC NULLS LAST, sector_name NULLS LAST LIMIT {config.TOP_N}""")
def q_topn_sector(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).sector_topn()


@alias(["agg_region_exposure"], "SELECT * FROM o_region_agg")
def q_region_agg(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).region_agg


@alias(["agg_country_exposure", "filter_country_rows", "view_country_allocation"], "SELECT * FROM o_country_agg")
def q_country_agg(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).country_agg


@alias(["topn_country"], f"""
SELECT * FROM o_country_agg ORDER BY total_true_value_thb DESC NULLS LAST, region_name NULLS LAST LIMIT {config.TOP_N}""")
def q_topn_country(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).country_topn()


@alias(["agg_dashboard_cards", "dashboard_cards", "agg_distinct_counts", "top1_pick"], "SELECT * FROM o_cards")
def q_cards(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).cards
