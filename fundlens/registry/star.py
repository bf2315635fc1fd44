"""Star-schema and contract-output keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from ..functions.strings import extract_symbol
from ..oracle import star  # noqa: F401
from ..oracle.ctes import CTE
from ..sources.publish import digests
from .common import mart
from .contracts import STAR, digests_sql
from .core import alias

STAR_TABLES = {
    "stocks": "o_dim_stocks",
    "funds": "o_dim_funds",
    "master_funds": "o_dim_master",
    "fund_direct_holdings": "o_fact_direct",
    "fund_master_holdings": "o_fact_master",
    "master_fund_holdings": "o_master_fund_holdings",
    "fund_sector_breakdown": "(SELECT fund_id, alloc_name AS sector_name, percentage FROM o_alloc_rows WHERE alloc_type = 'sector_alloc')",
    "fund_country_breakdown": "(SELECT fund_id, alloc_name AS country_name, percentage FROM o_alloc_rows WHERE alloc_type = 'country_alloc')",
}


def _star(spark: SparkSession, sf: str):
    return mart(spark, sf).star


@alias(["api_star_schema"], digests_sql(STAR_TABLES, STAR))
def q_star(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and a digest over all columns of the eight tables."""
    return digests(_star(spark, sf).tables())


@alias(["dim_funds", "join_fund_return", "surrogate_keys"], "SELECT * FROM o_dim_funds")
def q_dim_funds(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).dim_funds


@alias(["dim_stocks"], "SELECT * FROM o_dim_stocks")
def q_dim_stocks(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).dim_stocks


@alias(["dim_master_funds"], "SELECT * FROM o_dim_master")
def q_dim_master(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).dim_master_funds


@alias(["fact_master_holdings", "classify_instrument"], "SELECT * FROM o_fact_master")
def q_fact_master(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).fact_master_holdings


@alias(["fact_direct_holdings", "join_surrogate_lookup"], "SELECT * FROM o_fact_direct")
def q_fact_direct(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).fact_direct_holdings


@alias(["join_holdings_aum"], """
SELECT fund_code, fund_id, symbol, holding_name, sector, type, percent, aum, value_thb, is_master, as_of_date,
       nav_thb, thb_value FROM o_thai_holdings""")
def q_holdings_aum(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).thai_holdings


@alias(["lookthrough_first_master"], "SELECT * FROM o_master_fund_holdings")
def q_first_master(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).master_fund_holdings


@alias(["alloc_breakdown"], """
SELECT fund_id, alloc_name AS sector_name, percentage FROM o_alloc_rows WHERE alloc_type = 'sector_alloc'""")
def q_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).breakdown("sector")


@alias(["alloc_breakdown_country"], """
SELECT fund_id, alloc_name AS country_name, percentage FROM o_alloc_rows WHERE alloc_type = 'country_alloc'""")
def q_breakdown_country(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).breakdown("country")


@alias(["clean_stock_name"], "SELECT fund_code, sym, holding_name, full_name FROM o_direct_rows")
def q_clean_stock(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).direct_rows.select("fund_code", "sym", "holding_name", "full_name")


_SYM_PAREN = "'\\(([A-Za-z0-9._\\-]+)\\)\\s*$'"
_SYM_TAIL = "'([A-Za-z0-9._\\-]{2,})$'"


@alias(["extract_symbol"], f"""
SELECT fund_code, name, CASE WHEN name IS NOT NULL AND name <> '' THEN
         coalesce(CASE WHEN regexp_matches(name, {_SYM_PAREN}) THEN upper(regexp_extract(name, {_SYM_PAREN}, 1)) END,
                  CASE WHEN regexp_matches(trim(name), {_SYM_TAIL}) THEN upper(regexp_extract(trim(name), {_SYM_TAIL}, 1)) END)
       END AS symbol_from_name
FROM funds_holding""")
def q_extract_symbol(spark: SparkSession, sf: str) -> DataFrame:
    h = mart(spark, sf).src["funds_holding"]
    return h.select("fund_code", "name", extract_symbol("name").alias("symbol_from_name"))


@alias(["agg_top_thai_holdings"], "SELECT * FROM o_top_thai")
def q_top_thai(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).top_thai_holdings()


@alias(["agg_top_global_traceability"], """
SELECT rank_no, holding_key, holding_ticker, holding_name, holding_type, total_true_weight_pct AS total_weight_pct,
       total_true_value_thb AS global_fund_value FROM o_top_holdings""")
def q_top_global(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).top_global_traceability()


@alias(["agg_scoped_exposure"], "SELECT * FROM o_scoped_exposure")
def q_scoped_exposure(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).scoped_exposure()


@alias(["agg_scoped_cards"], "SELECT * FROM o_scoped_cards")
def q_scoped_cards(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).scoped_cards()


@alias(["agg_search_asset_to_funds"], "SELECT * FROM o_asset_to_funds")
def q_asset_to_funds(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).search_asset_to_funds()


@alias(["agg_search_fund_to_assets"], "SELECT * FROM o_fund_to_assets")
def q_fund_to_assets(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).search_fund_to_assets()


@alias(["stock_aggregates"], "SELECT * FROM o_stock_aggregates")
def q_stock_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).stock_aggregates()


@alias(["api_suggestions"], "SELECT * FROM o_suggestions")
def q_suggestions(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).suggestions()


@alias(["map_investment_method"], "SELECT * FROM o_investment_method")
def q_investment_method(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).investment_method()


@alias(["api_fund_holdings"], "SELECT * FROM o_fund_holdings")
def q_fund_holdings(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).fund_holdings()


@alias(["gold_stock_type"], """
SELECT stock_type, count(*) AS stocks, stock_type IN ('TH', 'FOREIGN', 'GOLD') AS accepted FROM o_dim_stocks GROUP BY stock_type""")
def q_stock_types(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).stock_type_counts()


assert CTE  # blocks registered
