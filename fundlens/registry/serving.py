"""Serving keys: views, search, dashboard maths, payload."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import trigrams
from ..oracle import stages, star  # noqa: F401
from ..oracle.ctes import define
from ..oracle.stages import dsum, strip
from ..plans import serving as sv
from ..plans.exposure import alloc_order
from ..session import ensure_checkpoint_dir
from ..sources import catalog, document
from ..sources.publish import digests, publish, published
from .common import mart
from .contracts import GIVEN, GIVEN_KEYS, MART, SECTIONS, VIEWS, columns, digests_sql, profile_sql, samples_sql
from .core import alias
from .quality import MART_SRC

SEARCH_ORDER = ("total_true_value_thb DESC NULLS LAST, fund_code NULLS LAST, holding_name NULLS LAST, "
                "holding_ticker NULLS LAST, holding_type NULLS LAST")
FUND_QUERY = "F1"
FUND_GRAMS = "F12"
ASSET_QUERY = "Ring"
DONUT_K = 5

define("o_search_by_fund", f"""
SELECT fund_code, min(holding_name) AS holding_name, nullif(holding_ticker_norm, '') AS holding_ticker, holding_type,
       {dsum('true_weight_pct')} AS total_true_weight_pct, {dsum('true_value_thb')} AS total_true_value_thb
FROM o_stock GROUP BY fund_code, holding_key, holding_ticker_norm, holding_type""")


@alias(["search_by_fund"], "SELECT * FROM o_search_by_fund")
def q_search_by_fund(spark: SparkSession, sf: str) -> DataFrame:
    return sv.search_by_fund(mart(spark, sf).stock)


@alias(["search_by_asset"], "SELECT * FROM o_search_by_fund")
def q_search_by_asset(spark: SparkSession, sf: str) -> DataFrame:
    return sv.search_by_asset(mart(spark, sf).stock)


@alias(["search_top500"], f"SELECT * FROM o_search_by_fund ORDER BY {SEARCH_ORDER} LIMIT {config.SEARCH_PAYLOAD_LIMIT}")
def q_search_top(spark: SparkSession, sf: str) -> DataFrame:
    return sv.search_top(sv.search_by_fund(mart(spark, sf).stock))


@alias(["search_fund_contains"], f"""
SELECT * FROM o_search_by_fund WHERE contains(lower(coalesce(fund_code, '')), '{FUND_QUERY.lower()}')
ORDER BY {SEARCH_ORDER} LIMIT {config.SEARCH_UI_LIMIT}""")
def q_search_fund_contains(spark: SparkSession, sf: str) -> DataFrame:
    return sv.search_fund_contains(sv.search_by_fund(mart(spark, sf).stock), FUND_QUERY)


@alias(["search_asset_contains"], f"""
SELECT * FROM o_search_by_fund
WHERE contains(lower(coalesce(holding_name, '')), '{ASSET_QUERY.lower()}')
   OR contains(lower(coalesce(holding_ticker, '')), '{ASSET_QUERY.lower()}')
ORDER BY {SEARCH_ORDER} LIMIT {config.SEARCH_UI_LIMIT}""")
def q_search_asset_contains(spark: SparkSession, sf: str) -> DataFrame:
    return sv.search_asset_contains(sv.search_by_asset(mart(spark, sf).stock), ASSET_QUERY)


def _clean(name: str, ticker: str) -> str:
    s = strip(f"coalesce({name}, '')")
    t = strip(f"coalesce({ticker}, '')")
    s1 = f"CASE WHEN length({t}) > 0 AND ends_with(upper({s}), upper({t})) THEN {strip(f'left({s}, length({s}) - length({t}))')} ELSE {s} END"
    s2 = strip(f"regexp_replace({s1}, '\\s*\\(([A-Z0-9.\\-:]{{2,20}})\\)\\s*$', '')")
    return f"regexp_replace({s2}, '\\s{{2,}}', ' ', 'g')"


define("o_labels", f"""
SELECT *, coalesce(CASE WHEN clean_name <> '' AND ticker_display <> '' THEN clean_name || ' (' || ticker_display || ')' END,
                   nullif(clean_name, ''), nullif(ticker_display, ''), '-') AS label
FROM (SELECT *, split_part(upper({strip("coalesce(holding_ticker, '')")}), ':', 1) AS ticker_display,
             {_clean('holding_name', 'holding_ticker')} AS clean_name
      FROM o_top_holdings)""")


@alias(["normalize_ticker", "clean_holding_name", "display_label"], "SELECT * FROM o_labels")
def q_labels(spark: SparkSession, sf: str) -> DataFrame:
    return sv.holding_labels(mart(spark, sf).top_holdings)


@alias(["pct_of_max"], f"""
SELECT *, total_true_value_thb / greatest(coalesce(max(total_true_value_thb) OVER (), 1.0::DOUBLE), 1.0::DOUBLE) * 100.0::DOUBLE
       AS pct_of_max
FROM (SELECT *, row_number() OVER (ORDER BY {stages.HOLDING_ORDER}) AS rank_no FROM o_top_unranked
      ORDER BY {stages.HOLDING_ORDER} LIMIT {config.TOP_N})""")
def q_pct_of_max(spark: SparkSession, sf: str) -> DataFrame:
    return sv.pct_of_max(mart(spark, sf).top_holdings_topn, "total_true_value_thb")


def donut_sql(src: str, label: str, k: int, basis: str) -> str:
    order = "value DESC NULLS LAST, label NULLS LAST"
    denom = "t.a" if basis == "all" else "st.s"
    body = f"""
WITH r AS (SELECT {label} AS label, total_true_value_thb AS value FROM {src}),
shown AS (SELECT *, row_number() OVER (ORDER BY {order}) AS rank_no FROM r ORDER BY {order} LIMIT {k}),
t AS (SELECT {dsum('value')} AS a FROM r),
st AS (SELECT {dsum('value')} AS s FROM shown),
sl AS (SELECT shown.label, shown.value, shown.rank_no,
              coalesce(shown.value, 0.0::DOUBLE) / (CASE WHEN coalesce({denom}, 0.0::DOUBLE) <> 0 THEN {denom} ELSE 1.0::DOUBLE END)
              * 100.0::DOUBLE AS share_pct
       FROM shown, t, st),
cum AS (SELECT *, CAST(sum(CAST(floor(share_pct * 1000000.0::DOUBLE + 0.5::DOUBLE) AS DECIMAL(38,0)))
                 OVER (ORDER BY rank_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 1000000.0::DOUBLE AS end_pct
        FROM sl)
SELECT label, value, rank_no, share_pct, end_pct - share_pct AS start_pct, end_pct FROM cum"""
    if basis == "all":
        body += f"""
UNION ALL
SELECT 'Others', t.a - coalesce(st.s, 0.0::DOUBLE), CAST({k + 1} AS BIGINT),
       (t.a - coalesce(st.s, 0.0::DOUBLE)) / t.a * 100.0::DOUBLE, NULL::DOUBLE, NULL::DOUBLE
FROM t, st WHERE coalesce(st.s, 0.0::DOUBLE) < t.a"""
    return body


@alias(["topk_with_others", "cumulative_share"], donut_sql("o_sector_agg", "sector_name", DONUT_K, "all"))
def q_donut_sector(spark: SparkSession, sf: str) -> DataFrame:
    return sv.donut(mart(spark, sf).sector_agg, "sector_name", "total_true_value_thb", alloc_order("sector_name"),
                    DONUT_K, "all")


@alias(["share_shown_vs_all"], donut_sql("o_country_agg", "region_name", DONUT_K, "shown"))
def q_donut_country(spark: SparkSession, sf: str) -> DataFrame:
    return sv.donut(mart(spark, sf).country_agg, "region_name", "total_true_value_thb", alloc_order("region_name"),
                    DONUT_K, "shown")


TYPED_SRC = ("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderdate AS ordered_at, "
             "CAST(o_orderdate AS DATE) AS ordered_on FROM orders")


@alias(["payload_norm_typed"], f"""
SELECT o_orderkey, CAST(price AS DOUBLE) AS price, strftime(ordered_at, '%Y-%m-%dT%H:%M:%S') AS ordered_at,
       strftime(ordered_on, '%Y-%m-%d') AS ordered_on FROM ({TYPED_SRC})""")
def q_norm_typed(spark: SparkSession, sf: str) -> DataFrame:
    """S10 on input that has a decimal, a timestamp and a date."""
    orders = mart(spark, sf).src.raw("orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.col("o_orderdate").alias("ordered_at"), F.col("o_orderdate").cast("date").alias("ordered_on"))
    return sv.norm_rows(orders)


@alias(["catalog_profile"], profile_sql())
def q_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The given tables by column; the estimate is tested by its error."""
    raw = mart(spark, sf).src.raw
    return catalog.profile({t: raw(t) for t in GIVEN}).drop("distinct_estimate")


@alias(["catalog_samples"], samples_sql())
def q_samples(spark: SparkSession, sf: str) -> DataFrame:
    raw = mart(spark, sf).src.raw
    return catalog.samples({t: raw(t) for t in GIVEN}, GIVEN_KEYS)


def _indexed(rows: DataFrame, columns_: list[str], query: str) -> DataFrame:
    """Write the index of each column to the shared folder and search it."""
    root = f"{ensure_checkpoint_dir(rows.sparkSession).rstrip('/')}/trigrams-{uuid.uuid4().hex}"
    rows.write.parquet(f"{root}/rows")  # read by the indexes and by the search
    rows = rows.sparkSession.read.schema(rows.schema).parquet(f"{root}/rows")
    for c in columns_:
        trigrams.write_index(rows, c, f"{root}/{c}")
    return trigrams.search(rows, query, {c: f"{root}/{c}" for c in columns_})


@alias(["search_fund_indexed"], f"""
SELECT * FROM o_search_by_fund WHERE contains(lower(coalesce(fund_code, '')), '{FUND_GRAMS.lower()}')""")
def q_search_fund_indexed(spark: SparkSession, sf: str) -> DataFrame:
    return _indexed(sv.search_by_fund(mart(spark, sf).stock), ["fund_code"], FUND_GRAMS)


@alias(["search_asset_indexed"], f"""
SELECT * FROM o_search_by_fund
WHERE contains(lower(coalesce(holding_name, '')), '{ASSET_QUERY.lower()}')
   OR contains(lower(coalesce(holding_ticker, '')), '{ASSET_QUERY.lower()}')""")
def q_search_asset_indexed(spark: SparkSession, sf: str) -> DataFrame:
    return _indexed(sv.search_by_asset(mart(spark, sf).stock), ["holding_name", "holding_ticker"], ASSET_QUERY)


@alias(["payload_norm_row", "iso_format"], """
SELECT fund_code, strftime(nav_as_of_date, '%Y-%m-%d') AS nav_as_of_date, aum_native, fund_currency FROM o_stg_nav""")
def q_norm_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sv.norm_rows(mart(spark, sf).stg_nav)


VIEW_SRC = {
    "vw_dashboard_cards": "o_cards",
    "vw_top_holdings": "o_topn",
    "vw_sector_allocation": "o_sector_agg",
    "vw_country_allocation": "(SELECT *, region_name AS country_name FROM o_country_agg)",
    "vw_search_by_fund": "o_search_by_fund",
    "vw_search_by_asset": "o_search_by_fund",
    "vw_nav_aum_thb": "o_vw_nav",
}


@alias(["mart_views"], digests_sql(VIEW_SRC, VIEWS, "view_name"))
def q_views(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and digest of the seven registered views, read by name."""
    mart(spark, sf).register_views()
    return digests({v: spark.table(v) for v in VIEW_SRC}, "view_name")


def _view(name: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return sv.serving_views(mart(spark, sf))[name]

    return run


def _view_sql(name: str) -> str:
    return f"SELECT {', '.join(c for c, _ in columns(VIEWS[name]))} FROM {VIEW_SRC[name]}"


alias(["view_top_holdings"], _view_sql("vw_top_holdings"))(_view("vw_top_holdings"))


@alias(["limit1_summary"], """
SELECT 'ALL' AS scope, total_holdings_value_thb AS total_value_thb, top_sector_name, top_sector_weight_pct, top_country_name,
       top_country_weight_pct, avg_fund_return_1y, avg_fund_return_3y, mapped_fund_count, mapped_master_count,
       NULL::BIGINT AS fund_count, NULL::DATE AS as_of_date FROM (SELECT * FROM o_cards LIMIT 1)
UNION ALL
SELECT scope, total_value_thb, top_sector_name, top_sector_weight_pct, top_country_name, top_country_weight_pct,
       avg_fund_return_1y, avg_fund_return_3y, mapped_fund_count, mapped_master_count, fund_count, as_of_date
FROM o_scoped_cards WHERE scope <> 'ALL'""")
def q_limit1(spark: SparkSession, sf: str) -> DataFrame:
    """One summary row for each of the three scopes."""
    return sv.summary_rows(mart(spark, sf))


def payload_sql(searched: str) -> str:
    """The 13 sections; ``searched`` are the rows of the two search lists."""
    return f"""
SELECT 'dashboard_summary' AS section, CAST(1 AS BIGINT) AS position, top_sector_name AS name,
       total_holdings_value_thb AS value_thb, top_sector_weight_pct AS weight_pct FROM (SELECT * FROM o_cards LIMIT 1)
UNION ALL
SELECT 'top_global_traceability_top10', rank_no, holding_name, total_true_value_thb, total_true_weight_pct FROM (
  SELECT *, row_number() OVER (ORDER BY {stages.HOLDING_ORDER}) AS rank_no FROM o_top_unranked
  ORDER BY {stages.HOLDING_ORDER} LIMIT {config.TOP_N})
UNION ALL
SELECT 'sector_allocation_global', row_number() OVER (ORDER BY total_true_value_thb DESC NULLS LAST, sector_name NULLS LAST),
       sector_name, total_true_value_thb, total_true_weight_pct FROM o_sector_agg
UNION ALL
SELECT 'country_allocation_global', row_number() OVER (ORDER BY total_true_value_thb DESC NULLS LAST, region_name NULLS LAST),
       region_name, total_true_value_thb, total_true_weight_pct FROM o_country_agg
UNION ALL
SELECT 'search_by_fund', row_number() OVER (ORDER BY {SEARCH_ORDER}), fund_code, total_true_value_thb, total_true_weight_pct
FROM {searched}
UNION ALL
SELECT 'search_by_asset', row_number() OVER (ORDER BY {SEARCH_ORDER}), holding_name, total_true_value_thb, total_true_weight_pct
FROM {searched}
UNION ALL
SELECT CASE WHEN scope = 'TH' THEN 'dashboard_summary_thai' ELSE 'dashboard_summary_global' END, 1, top_sector_name,
       total_value_thb, top_sector_weight_pct FROM o_scoped_cards WHERE scope <> 'ALL'
UNION ALL
SELECT 'top_thai_holdings_top10', rank_no, symbol, total_thai_fund_value, total_weight_pct FROM o_top_thai WHERE rank_no <= {config.TOP_N}
UNION ALL
SELECT 'top_thai_holdings_all', rank_no, symbol, total_thai_fund_value, total_weight_pct FROM o_top_thai
UNION ALL
SELECT 'top_global_traceability_all', rank_no, holding_name, total_true_value_thb, total_true_weight_pct FROM o_top_holdings
UNION ALL
SELECT dimension || '_allocation_thai',
       row_number() OVER (PARTITION BY dimension ORDER BY total_value_thb DESC NULLS LAST, name NULLS LAST),
       name, total_value_thb, total_weight_pct FROM o_scoped_exposure WHERE scope = 'TH'"""


define("o_payload_items", payload_sql(f"(SELECT * FROM o_search_by_fund ORDER BY {SEARCH_ORDER} LIMIT {config.SEARCH_PAYLOAD_LIMIT})"))


@alias(["dashboard_payload"], "SELECT * FROM o_payload_items")
def q_payload(spark: SparkSession, sf: str) -> DataFrame:
    return sv.payload_items(mart(spark, sf))


@alias(["payload_export"], payload_sql("o_search_by_fund"))
def q_payload_export(spark: SparkSession, sf: str) -> DataFrame:
    """The payload with every search row, not the most valuable ones alone."""
    return sv.payload_items(mart(spark, sf), search_limit=None)


_GLOBAL = "SELECT *, row_number() OVER (ORDER BY total_true_value_thb DESC NULLS LAST, {0} NULLS LAST) AS position FROM {1}"
_THAI = ("SELECT name AS {0}_name, total_weight_pct AS total_true_weight_pct, total_value_thb AS total_true_value_thb, "
         "allocation_share_pct, as_of_date, row_number() OVER (ORDER BY total_value_thb DESC NULLS LAST, name NULLS LAST) AS position "
         "FROM o_scoped_exposure WHERE scope = 'TH' AND dimension = '{0}'")
_SEARCH_LIST = (f"SELECT *, row_number() OVER (ORDER BY {SEARCH_ORDER}) AS position FROM (SELECT * FROM o_search_by_fund "
                f"ORDER BY {SEARCH_ORDER} LIMIT {config.SEARCH_PAYLOAD_LIMIT})")
SECTION_SRC = {name: f"({sql})" for name, sql in {
    "dashboard_summary": "SELECT 'ALL' AS scope, total_holdings_value_thb AS total_value_thb, * FROM o_cards LIMIT 1",
    "dashboard_summary_thai": "SELECT * FROM o_scoped_cards WHERE scope = 'TH'",
    "dashboard_summary_global": "SELECT * FROM o_scoped_cards WHERE scope = 'FOREIGN'",
    "top_thai_holdings_top10": f"SELECT * FROM o_top_thai WHERE rank_no <= {config.TOP_N}",
    "top_thai_holdings_all": "SELECT * FROM o_top_thai",
    "top_global_traceability_top10": "SELECT * FROM o_topn",
    "top_global_traceability_all": "SELECT *, total_true_weight_pct AS total_weight_pct, total_true_value_thb AS global_fund_value FROM o_top_holdings",
    "sector_allocation_thai": _THAI.format("sector"),
    "sector_allocation_global": _GLOBAL.format("sector_name", "o_sector_agg"),
    "country_allocation_thai": _THAI.format("country"),
    "country_allocation_global": _GLOBAL.format("country_name", "(SELECT *, region_name AS country_name FROM o_country_agg)"),
    "search_by_fund": _SEARCH_LIST,
    "search_by_asset": _SEARCH_LIST,
}.items()}


@alias(["payload_document"], digests_sql(SECTION_SRC, SECTIONS, "section"))
def q_document(spark: SparkSession, sf: str) -> DataFrame:
    """The payload as one document, read back from its files: records and
    digest over all columns of every section."""
    sections = {name: sv.norm_rows(df) for name, df in sv.payload_sections(mart(spark, sf)).items()}
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/payload-{uuid.uuid4().hex}"
    document.write_document(sections, sv.section_order(sections), path)
    return digests(document.read_sections(spark, path, {n: df.schema for n, df in sections.items()}), "section")


@alias(["round_summary"], """
SELECT mapped_fund_count, mapped_master_count, round(total_holdings_value_thb, 2) AS total_holdings_value_thb,
       top_sector_name, round(coalesce(top_sector_weight_pct, 0.0::DOUBLE), 4) AS top_sector_weight_pct,
       top_country_name, round(coalesce(top_country_weight_pct, 0.0::DOUBLE), 4) AS top_country_weight_pct,
       round(total_holdings_value_thb / 1e9, 0) AS total_billions, round(top_sector_weight_pct, 1) AS top_sector_pct_1dp
FROM o_cards""")
def q_round(spark: SparkSession, sf: str) -> DataFrame:
    return sv.round_summary(mart(spark, sf).cards)


@alias(["sort_multi_nulls_last"], """
SELECT *, row_number() OVER (ORDER BY coverage_ratio DESC NULLS LAST, raw_total_fund_holdings_pct ASC NULLS LAST,
                             fund_code ASC NULLS LAST) AS position FROM o_coverage""")
def q_sort_multi(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.distribution import global_row_number

    cov = mart(spark, sf).coverage
    order = [F.col("coverage_ratio").desc_nulls_last(), F.col("raw_total_fund_holdings_pct").asc_nulls_last(),
             F.col("fund_code").asc_nulls_last()]
    return global_row_number(cov, order, "position")


@alias(["mart_write_replace"], digests_sql(MART_SRC, MART))
def q_write(spark: SparkSession, sf: str) -> DataFrame:
    """Publish the 14 mart tables as a new version under the shared
    checkpoint folder, then read what readers now see."""
    import hashlib

    from ..session import ensure_checkpoint_dir

    root = ensure_checkpoint_dir(spark).rstrip("/") + "/fundlens-mart/" + hashlib.sha1(sf.encode()).hexdigest()[:12]
    version = publish(mart(spark, sf).tables(), root)
    return digests(published(spark, root, version))
