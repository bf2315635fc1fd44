"""Data-quality keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.numeric import exact_sum
from ..operators import quality as dq
from ..oracle import star  # noqa: F401
from ..oracle.ctes import define
from ..oracle.stages import HOLDING_ORDER, dsum, f0
from ..sources.publish import digests
from .common import mart
from .contracts import MART, digests_sql
from .core import alias


def check_sql(name: str, metric_sql: str, threshold: float, note: str) -> str:
    return (f"SELECT '{name}' AS check_name, CASE WHEN coalesce(metric, 0.0) <= {threshold} THEN 'PASS' ELSE 'FAIL' END AS status, "
            f"coalesce(CAST(metric AS DOUBLE), 0.0::DOUBLE) AS metric, CAST({threshold} AS DOUBLE) AS threshold, "
            f"'{note}' AS note FROM ({metric_sql})")


define("o_topn", f"SELECT *, row_number() OVER (ORDER BY {HOLDING_ORDER}) AS rank_no FROM o_top_unranked "
                 f"ORDER BY {HOLDING_ORDER} LIMIT {config.TOP_N}")

M_NONNEG = ("SELECT CAST(count_if(coalesce(true_weight_pct, -1.0) < 0 OR coalesce(true_value_thb, -1.0) < 0) AS DOUBLE) "
            "AS metric FROM o_stock")
M_OVER100 = (f"SELECT CAST(count_if(v > {config.WEIGHT_SUM_TOLERANCE}) AS DOUBLE) AS metric FROM "
             f"(SELECT fund_code, {dsum('coalesce(true_weight_pct, 0.0::DOUBLE)')} AS v FROM o_stock GROUP BY fund_code)")
M_COVER = "SELECT CAST(count_if(coverage_ratio < 0 OR coverage_ratio > 1) AS DOUBLE) AS metric FROM o_coverage"
M_RANK = "SELECT CAST(count_if(c > 1) AS DOUBLE) AS metric FROM (SELECT rank_no, count(*) AS c FROM o_topn GROUP BY rank_no)"
M_TOTAL = (f"SELECT abs(coalesce(a, 0.0::DOUBLE) - b) AS metric FROM "
           f"(SELECT max(coalesce(total_holdings_value_thb, 0.0::DOUBLE)) AS a FROM (SELECT * FROM o_cards LIMIT 1)), "
           f"(SELECT coalesce({dsum('true_value_thb')}, 0.0::DOUBLE) AS b FROM o_stock)")
M_SINGLE = "SELECT CAST(abs(count(*) - 1) AS DOUBLE) AS metric FROM o_cards"
M_FXMISS = ("SELECT CASE WHEN count(*) = 0 THEN 0.0::DOUBLE ELSE count_if(fund_currency <> 'THB' AND "
            "fx_rate_status = 'default_1_missing_fx') * 100.0::DOUBLE / count(*) END AS metric FROM o_vw_nav")

MART_SRC = {
    "stg_nav_aum_native": "o_stg_nav", "bridge_thai_master": "o_bridge", "fact_effective_exposure_stock": "o_stock",
    "fact_effective_exposure_sector": "o_sector", "fact_effective_exposure_region": "o_region",
    "agg_top_holdings": "o_top_holdings", "agg_top_holdings_topn": "o_topn", "agg_sector_exposure": "o_sector_agg",
    "agg_sector_exposure_topn": "(SELECT * FROM o_sector_agg ORDER BY total_true_value_thb DESC NULLS LAST, "
                                f"sector_name NULLS LAST LIMIT {config.TOP_N})",
    "agg_country_exposure": "o_country_agg",
    "agg_country_exposure_topn": "(SELECT * FROM o_country_agg ORDER BY total_true_value_thb DESC NULLS LAST, "
                                 f"region_name NULLS LAST LIMIT {config.TOP_N})",
    "agg_region_exposure": "o_region_agg", "agg_fund_coverage": "o_coverage", "agg_dashboard_cards": "o_cards",
}
MISSING_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name FROM (SELECT count(*) AS c FROM {MART_SRC[t]}) WHERE c = 0" for t in config.REQUIRED_MART_TABLES)

REPORT_SQL = " UNION ALL ".join([
    check_sql("required_tables_present", f"SELECT CAST(count(*) AS DOUBLE) AS metric FROM ({MISSING_SQL})", 0, "every required table holds rows"),
    check_sql("stock_negative_values", M_NONNEG, 0, "no stock weight or value is below zero"),
    check_sql("fund_weight_over_100", M_OVER100, 0, "weights of a fund add up to 100.5 at most"),
    check_sql("coverage_ratio_out_of_range", M_COVER, 0, "coverage lies between 0 and 1"),
    check_sql("duplicate_topn_rank", M_RANK, 0, "each rank is given once"),
    check_sql("dashboard_total_diff", M_TOTAL, config.CARD_TOTAL_TOLERANCE, "card total and fact total agree"),
    check_sql("dashboard_cards_rowcount", M_SINGLE, 0, "there is one card row"),
    check_sql("fx_missing_rate_pct", M_FXMISS, config.FX_MISSING_MAX_PCT,
              "share of foreign rows without a rate"),
])


@alias(["dq_report", "union_check_report", "dq_required_tables"], REPORT_SQL)
def q_report(spark: SparkSession, sf: str) -> DataFrame:
    return dq.report(mart(spark, sf))


@alias(["dq_non_negative"], check_sql("stock_negative_values", M_NONNEG, 0, "no stock weight or value is below zero"))
def q_nonneg(spark: SparkSession, sf: str) -> DataFrame:
    return dq.check_row(dq.non_negative(mart(spark, sf).stock), "stock_negative_values", 0,
                        "no stock weight or value is below zero")


@alias(["dq_weight_le_100"], check_sql("fund_weight_over_100", M_OVER100, 0, "weights of a fund add up to 100.5 at most"))
def q_over100(spark: SparkSession, sf: str) -> DataFrame:
    return dq.check_row(dq.weight_over_100(mart(spark, sf).stock), "fund_weight_over_100", 0,
                        "weights of a fund add up to 100.5 at most")


@alias(["dq_coverage_range"], check_sql("coverage_ratio_out_of_range", M_COVER, 0, "coverage lies between 0 and 1"))
def q_cover(spark: SparkSession, sf: str) -> DataFrame:
    return dq.check_row(dq.coverage_out_of_range(mart(spark, sf).coverage), "coverage_ratio_out_of_range", 0,
                        "coverage lies between 0 and 1")


@alias(["dq_rank_unique"], check_sql("duplicate_topn_rank", M_RANK, 0, "each rank is given once"))
def q_rank(spark: SparkSession, sf: str) -> DataFrame:
    return dq.check_row(dq.duplicate_ranks(mart(spark, sf).top_holdings_topn), "duplicate_topn_rank", 0,
                        "each rank is given once")


@alias(["dq_total_matches", "cross_scalar_compare", "abs_diff"], check_sql(
    "dashboard_total_diff", M_TOTAL, config.CARD_TOTAL_TOLERANCE, "card total and fact total agree"))
def q_total(spark: SparkSession, sf: str) -> DataFrame:
    m = mart(spark, sf)
    return dq.check_row(dq.total_diff(m.cards, m.stock), "dashboard_total_diff", config.CARD_TOTAL_TOLERANCE,
                        "card total and fact total agree")


@alias(["dq_single_row"], check_sql("dashboard_cards_rowcount", M_SINGLE, 0, "there is one card row"))
def q_single(spark: SparkSession, sf: str) -> DataFrame:
    return dq.check_row(dq.single_row(mart(spark, sf).cards), "dashboard_cards_rowcount", 0,
                        "there is one card row")


@alias(["dq_fx_missing_pct"], check_sql("fx_missing_rate_pct", M_FXMISS, config.FX_MISSING_MAX_PCT,
                                        "share of foreign rows without a rate"))
def q_fxmiss(spark: SparkSession, sf: str) -> DataFrame:
    return dq.check_row(dq.fx_missing_pct(mart(spark, sf).vw_nav_aum_thb), "fx_missing_rate_pct",
                        config.FX_MISSING_MAX_PCT, "share of foreign rows without a rate")


@alias(["agg_conditional_pct"], """
SELECT CASE WHEN count_if(fund_currency <> 'THB') = 0 THEN 0.0::DOUBLE
            ELSE count_if(fund_currency <> 'THB' AND fx_rate_status = 'default_1_missing_fx') * 100.0::DOUBLE
                 / count_if(fund_currency <> 'THB') END AS metric FROM o_vw_nav""")
def q_cond_pct(spark: SparkSession, sf: str) -> DataFrame:
    """Q13 option: the documented reading (denominator = non-base rows)."""
    return dq.fx_missing_pct(mart(spark, sf).vw_nav_aum_thb, non_base_only=True)


@alias(["agg_having_over"], f"""
SELECT fund_code, {dsum(f0('feeder_weight_pct'))} AS total_weight_pct FROM o_thai_feeder
GROUP BY fund_code HAVING {dsum(f0('feeder_weight_pct'))} > {config.WEIGHT_SUM_TOLERANCE}""")
def q_having(spark: SparkSession, sf: str) -> DataFrame:
    f = mart(spark, sf).ds.thai_feeder
    from ..functions.numeric import to_float0

    g = f.groupBy("fund_code").agg(exact_sum(to_float0("feeder_weight_pct")).alias("total_weight_pct"))
    return g.where(F.col("total_weight_pct") > config.WEIGHT_SUM_TOLERANCE)


SMOKE_SRC = {
    "bridge_thai_master": "o_bridge", "fact_effective_exposure_stock": "o_stock",
    "fact_effective_exposure_sector": "o_sector", "fact_effective_exposure_region": "o_region",
    "agg_top_holdings": "o_top_holdings", "agg_dashboard_cards": "o_cards",
}
SMOKE_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({mn} AS BIGINT) AS min_expected, "
    f"CASE WHEN count(*) >= {mn} THEN 'PASS' ELSE 'FAIL' END AS status FROM {SMOKE_SRC[t]}"
    for t, mn in config.SMOKE_MIN_ROWS)


@alias(["dq_smoke_counts", "smoke_row_counts"], SMOKE_SQL)
def q_smoke(spark: SparkSession, sf: str) -> DataFrame:
    return dq.smoke_counts(mart(spark, sf).tables())




@alias(["build_exposure_tables"], digests_sql(MART_SRC, MART))
def q_build(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and a digest over all columns of the 14 mart tables."""
    return digests(mart(spark, sf).tables())


@alias(["set_missing_tables"], MISSING_SQL)
def q_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Required mart tables minus the tables that hold rows."""
    return dq.missing_tables(mart(spark, sf).tables())


UNIQUE_SQL = " UNION ALL ".join([
    check_sql("fx_primary_key", "SELECT CAST(count_if(c > 1) AS DOUBLE) AS metric FROM (SELECT count(*) AS c FROM daily_fx_rates "
              "GROUP BY date_rate, from_ccy, to_ccy)", 0, "(date_rate, from_ccy, to_ccy) unique"),
    check_sql("nav_unique", "SELECT CAST(count_if(c > 1) AS DOUBLE) AS metric FROM (SELECT count(*) AS c FROM funds_daily "
              "GROUP BY fund_code, nav_date)", 0, "(fund_code, nav_date) unique"),
    check_sql("stock_symbol_unique", "SELECT CAST(count_if(c > 1) AS DOUBLE) AS metric FROM (SELECT count(*) AS c FROM o_dim_stocks "
              "GROUP BY symbol)", 0, "stocks.symbol unique"),
    check_sql("fund_code_unique", "SELECT CAST(count_if(c > 1) AS DOUBLE) AS metric FROM (SELECT count(*) AS c FROM o_dim_funds "
              "GROUP BY code)", 0, "funds.code unique"),
])


@alias(["dq_unique_key"], UNIQUE_SQL)
def q_unique(spark: SparkSession, sf: str) -> DataFrame:
    m = mart(spark, sf)
    st = m.star
    rows = [
        dq.check_row(dq.duplicate_keys(m.src["daily_fx_rates"], ["date_rate", "from_ccy", "to_ccy"]), "fx_primary_key", 0,
                     "(date_rate, from_ccy, to_ccy) unique"),
        dq.check_row(dq.duplicate_keys(m.src["funds_daily"], ["fund_code", "nav_date"]), "nav_unique", 0,
                     "(fund_code, nav_date) unique"),
        dq.check_row(dq.duplicate_keys(st.dim_stocks, ["symbol"]), "stock_symbol_unique", 0, "stocks.symbol unique"),
        dq.check_row(dq.duplicate_keys(st.dim_funds, ["code"]), "fund_code_unique", 0, "funds.code unique"),
    ]
    return reduce(DataFrame.unionByName, rows)


ACCEPT_SQL = " UNION ALL ".join([
    check_sql("map_method_values", "SELECT CAST(count_if(NOT coalesce(map_method IN ('feeder_holding_isin', "
              "'thai_fund_isin_fallback'), false)) AS DOUBLE) AS metric FROM o_bridge", 0, "map_method accepted"),
    check_sql("stock_type_values", "SELECT CAST(count_if(NOT coalesce(stock_type IN ('TH', 'FOREIGN', 'GOLD'), false)) "
              "AS DOUBLE) AS metric FROM o_dim_stocks", 0, "stock_type accepted"),
    check_sql("fx_status_values", "SELECT CAST(count_if(NOT coalesce(fx_rate_status IN ('base_currency', 'exact', 'latest', "
              "'default_1_missing_fx'), false)) AS DOUBLE) AS metric FROM o_vw_nav", 0, "fx_rate_status accepted"),
    *[check_sql(f"{c}_values", f"SELECT CAST(count_if(NOT coalesce({x} IN ({', '.join(repr(v) for v in ok)}), false)) AS DOUBLE) "
                               f"AS metric FROM {src}", 0, f"{c} accepted")
      for c, x, ok, src in (
          ("scope", "scope", config.SCOPES, "o_scoped_exposure"),
          ("investment_method", "investment_method", config.INVESTMENT_METHODS, "o_fund_holdings"),
          ("item_type", "item_type", config.ITEM_TYPES, "o_suggestions"),
          ("alloc_type", "regexp_replace(lower(type), '_alloc$', '')", config.ALLOC_TYPES, "funds_allocations"))],
])


@alias(["dq_accepted_values"], ACCEPT_SQL)
def q_accepted(spark: SparkSession, sf: str) -> DataFrame:
    m = mart(spark, sf)
    rows = [
        dq.check_row(dq.not_accepted(m.bridge, "map_method", (config.MAP_FEEDER, config.MAP_FALLBACK)),
                     "map_method_values", 0, "map_method accepted"),
        dq.check_row(dq.not_accepted(m.star.dim_stocks, "stock_type", config.STOCK_TYPES), "stock_type_values", 0,
                     "stock_type accepted"),
        dq.check_row(dq.not_accepted(m.vw_nav_aum_thb, "fx_rate_status", (
            config.FX_STATUS_BASE, config.FX_STATUS_EXACT, config.FX_STATUS_LATEST, config.FX_STATUS_MISSING)),
            "fx_status_values", 0, "fx_rate_status accepted"),
    ]
    alloc = m.src["funds_allocations"].select(F.regexp_replace(F.lower("type"), "_alloc$", "").alias("alloc_type"))
    for df, col, accepted in (
        (m.star.scoped_exposure(), "scope", config.SCOPES),
        (m.star.fund_holdings(), "investment_method", config.INVESTMENT_METHODS),
        (m.star.suggestions(), "item_type", config.ITEM_TYPES),
        (alloc, "alloc_type", config.ALLOC_TYPES),
    ):
        rows.append(dq.check_row(dq.not_accepted(df, col, accepted), f"{col}_values", 0, f"{col} accepted"))
    return reduce(DataFrame.unionByName, rows)


FK = [
    ("direct_fund_fk", "o_fact_direct", "fund_id", "o_dim_funds"),
    ("direct_stock_fk", "o_fact_direct", "stock_id", "o_dim_stocks"),
    ("master_fund_fk", "o_fact_master", "fund_id", "o_dim_funds"),
    ("master_master_fk", "o_fact_master", "master_fund_id", "o_dim_master"),
    ("master_stock_master_fk", "o_master_fund_holdings", "master_fund_id", "o_dim_master"),
    ("master_stock_stock_fk", "o_master_fund_holdings", "stock_id", "o_dim_stocks"),
]
FK_SQL = " UNION ALL ".join(
    check_sql(n, f"SELECT CAST(count(*) AS DOUBLE) AS metric FROM {f} x WHERE NOT EXISTS "
                 f"(SELECT 1 FROM {d} y WHERE y.id = x.{c})", 0, f"{c} resolves")
    for n, f, c, d in FK)


@alias(["dq_foreign_key"], FK_SQL)
def q_fk(spark: SparkSession, sf: str) -> DataFrame:
    st = mart(spark, sf).star
    facts = {"o_fact_direct": st.fact_direct_holdings, "o_fact_master": st.fact_master_holdings,
             "o_master_fund_holdings": st.master_fund_holdings}
    dims = {"o_dim_funds": st.dim_funds, "o_dim_stocks": st.dim_stocks, "o_dim_master": st.dim_master_funds}
    rows = [dq.check_row(dq.orphans(facts[f], c, dims[d]), n, 0, f"{c} resolves") for n, f, c, d in FK]
    return reduce(DataFrame.unionByName, rows)
