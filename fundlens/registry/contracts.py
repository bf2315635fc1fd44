"""Output contracts: the columns of every published table and view, in order
(``name`` for text, ``name:type`` for the rest), and the digest of ``sources/publish.py`` in SQL."""

from __future__ import annotations

MART: dict[str, str] = {
    "stg_nav_aum_native": "fund_code nav_as_of_date:date aum_native:double fund_currency",
    "bridge_thai_master": (
        "fund_code feeder_name feeder_weight_pct:double as_of_date:date token token_isin ft_ticker ticker name "
        "ticker_type map_method"
    ),
    "fact_effective_exposure_stock": (
        "fund_code ft_ticker ticker map_method feeder_name feeder_weight_pct:double feeder_weight_pct_norm:double "
        "holding_name holding_ticker holding_type portfolio_weight_pct:double true_weight_pct:double aum:double "
        "aum_native:double fund_currency fx_rate_to_thb:double fx_rate_date:date fx_rate_status "
        "true_value_thb:double nav_as_of_date:date date_scraper:date holding_ticker_norm holding_name_norm "
        "holding_key"
    ),
    "fact_effective_exposure_sector": (
        "fund_code ft_ticker ticker map_method sector_name sector_weight_pct:double feeder_weight_pct:double "
        "feeder_weight_pct_norm:double true_weight_pct:double aum:double aum_native:double fund_currency "
        "fx_rate_to_thb:double fx_rate_date:date fx_rate_status true_value_thb:double nav_as_of_date:date "
        "date_scraper:date"
    ),
    "fact_effective_exposure_region": (
        "fund_code ft_ticker ticker map_method region_name region_weight_pct:double feeder_weight_pct:double "
        "feeder_weight_pct_norm:double true_weight_pct:double aum:double aum_native:double fund_currency "
        "fx_rate_to_thb:double fx_rate_date:date fx_rate_status true_value_thb:double is_country_like:boolean "
        "nav_as_of_date:date date_scraper:date"
    ),
    "agg_top_holdings": (
        "holding_key holding_ticker holding_type total_true_weight_pct:double total_true_value_thb:double "
        "holding_name rank_no:long"
    ),
    "agg_top_holdings_topn": (
        "holding_key holding_ticker holding_type total_true_weight_pct:double total_true_value_thb:double "
        "holding_name rank_no:long"
    ),
    "agg_sector_exposure": "sector_name total_true_weight_pct:double total_true_value_thb:double allocation_share_pct:double",
    "agg_sector_exposure_topn": "sector_name total_true_weight_pct:double total_true_value_thb:double allocation_share_pct:double",
    "agg_country_exposure": (
        "region_name is_country_like:boolean total_true_weight_pct:double total_true_value_thb:double "
        "allocation_share_pct:double"
    ),
    "agg_country_exposure_topn": (
        "region_name is_country_like:boolean total_true_weight_pct:double total_true_value_thb:double "
        "allocation_share_pct:double"
    ),
    "agg_region_exposure": "region_name is_country_like:boolean total_true_weight_pct:double total_true_value_thb:double",
    "agg_fund_coverage": (
        "fund_code raw_total_fund_holdings_pct:double total_fund_holdings_pct:double mapped_holdings_pct:double "
        "coverage_ratio:double nav_as_of_date:date aum:double aum_native:double fund_currency fx_rate_to_thb:double "
        "fx_rate_date:date fx_rate_status"
    ),
    "agg_dashboard_cards": (
        "total_holdings_value_thb:double top_sector_name top_sector_weight_pct:double top_country_name "
        "top_country_weight_pct:double avg_fund_return_1y:double avg_fund_return_3y:double mapped_fund_count:long "
        "mapped_master_count:long"
    ),
}

VIEWS: dict[str, str] = {
    "vw_dashboard_cards": (
        "total_holdings_value_thb:double top_sector_name top_sector_weight_pct:double top_country_name "
        "top_country_weight_pct:double avg_fund_return_1y:double avg_fund_return_3y:double mapped_fund_count:long "
        "mapped_master_count:long"
    ),
    "vw_top_holdings": (
        "rank_no:long holding_name holding_ticker holding_type total_true_weight_pct:double "
        "total_true_value_thb:double"
    ),
    "vw_sector_allocation": "sector_name total_true_weight_pct:double total_true_value_thb:double",
    "vw_country_allocation": "country_name total_true_weight_pct:double total_true_value_thb:double",
    "vw_search_by_fund": (
        "fund_code holding_name holding_ticker holding_type total_true_weight_pct:double "
        "total_true_value_thb:double"
    ),
    "vw_search_by_asset": (
        "holding_name holding_ticker holding_type fund_code total_true_weight_pct:double "
        "total_true_value_thb:double"
    ),
    "vw_nav_aum_thb": (
        "fund_code nav_as_of_date:date fund_currency aum_native:double fx_rate_to_thb:double aum_thb:double "
        "fx_rate_status"
    ),
}

STAR: dict[str, str] = {
    "stocks": "symbol full_name sector stock_type percent_change:double country id:long",
    "funds": "name_th name_en amc category code risk_level:long return_1y:double id:long",
    "master_funds": "name_en amc category id:long",
    "fund_direct_holdings": "fund_id:long stock_id:long ranking:int holding_value_thb:double nav_thb:double percent_nav:double",
    "fund_master_holdings": "fund_id:long master_fund_id:long holding_value_thb:double percent_nav:double",
    "master_fund_holdings": "master_fund_id:long stock_id:long percent_weight:double",
    "fund_sector_breakdown": "fund_id:long sector_name percentage:double",
    "fund_country_breakdown": "fund_id:long country_name percentage:double",
}

# payload sections as they are read back
_SUMMARY = (
    "scope total_value_thb:double top_sector_name top_sector_weight_pct:double top_country_name top_country_weight_pct:double "
    "avg_fund_return_1y:double avg_fund_return_3y:double mapped_fund_count:long mapped_master_count:long"
)
_THAI_HOLDINGS = (
    "symbol total_thai_fund_value:double total_weight_pct:double fund_count:long holding_type as_of_date:date full_name rank_no:long"
)
_SHARES = "total_true_weight_pct:double total_true_value_thb:double allocation_share_pct:double position:long"
_SEARCHED = (
    "fund_code holding_name holding_ticker holding_type total_true_weight_pct:double total_true_value_thb:double position:long"
)
SECTIONS: dict[str, str] = {
    "dashboard_summary": _SUMMARY,
    "dashboard_summary_thai": f"{_SUMMARY} fund_count:long as_of_date:date",
    "dashboard_summary_global": f"{_SUMMARY} fund_count:long as_of_date:date",
    "top_thai_holdings_top10": _THAI_HOLDINGS,
    "top_thai_holdings_all": _THAI_HOLDINGS,
    "top_global_traceability_top10": (
        "holding_key holding_ticker holding_type total_true_weight_pct:double total_true_value_thb:double holding_name rank_no:long"
    ),
    "top_global_traceability_all": (
        "rank_no:long holding_key holding_ticker holding_name holding_type total_weight_pct:double global_fund_value:double"
    ),
    "sector_allocation_thai": f"sector_name {_SHARES} as_of_date:date",
    "sector_allocation_global": f"sector_name {_SHARES}",
    "country_allocation_thai": f"country_name {_SHARES} as_of_date:date",
    "country_allocation_global": f"country_name is_country_like:boolean {_SHARES}",
    "search_by_fund": _SEARCHED,
    "search_by_asset": _SEARCHED,
}

# given tables, with the Spark type names of their columns
GIVEN: dict[str, str] = {
    "region": "r_regionkey:int r_name",
    "nation": "n_nationkey:int n_name n_regionkey:int",
    "customer": "c_custkey:bigint c_name c_nationkey:int c_acctbal:double c_mktsegment",
    "supplier": "s_suppkey:bigint s_name s_nationkey:int s_acctbal:double",
    "part": "p_partkey:bigint p_name p_brand p_type p_size:int p_retailprice:double",
    "orders": "o_orderkey:bigint o_custkey:bigint o_orderstatus o_totalprice:double o_orderdate:timestamp_ntz o_orderpriority",
    "lineitem": (
        "l_orderkey:bigint l_partkey:bigint l_suppkey:bigint l_linenumber:int l_quantity:double l_extendedprice:double "
        "l_discount:double l_tax:double l_returnflag l_linestatus l_shipdate:timestamp_ntz"
    ),
    "events": "event_id:bigint ts:timestamp_ntz user_id:bigint event_type value:double props",
}
GIVEN_KEYS: dict[str, list[str]] = {t: [c.split()[0].split(":")[0]] for t, c in GIVEN.items()} | {
    "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
}


def columns(contract: str) -> list[tuple[str, str]]:
    """(name, type) pairs."""
    return [(c.split(":")[0], c.split(":")[1] if ":" in c else "string") for c in contract.split()]


def _text_sql(name: str, dtype: str) -> str:
    if dtype == "double":
        x = f"CAST({name} AS DOUBLE)"
        part = f"CAST(floor({x} % 1.0::DOUBLE * 1000000.0::DOUBLE + 0.5::DOUBLE) AS BIGINT)"
        value = (
            f"CASE WHEN abs({x}) < {2**62}::DOUBLE THEN CAST({x} - {x} % 1.0::DOUBLE AS BIGINT) || ':' || {part} "
            f"WHEN abs({x}) < {2.0**104}::DOUBLE THEN 'B' || CAST(floor({x} / {2**42}::DOUBLE) AS BIGINT) "
            f"WHEN {x} IS NOT NULL THEN 'big' END")
    elif dtype == "date":
        value = f"strftime(CAST({name} AS DATE), '%Y-%m-%d')"
    elif dtype.startswith("timestamp"):
        value = f"strftime(CAST({name} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')"
    else:
        value = f"CAST({name} AS VARCHAR)"
    return f"coalesce('=' || ({value}), 'null')"


def digests_sql(sources: dict[str, str], contracts: dict[str, str], label: str = "table_name") -> str:
    """Rows and digest of each table, from its SQL source."""
    parts = []
    for table, source in sources.items():
        text = ", ".join(_text_sql(n, t) for n, t in sorted(columns(contracts[table])))
        bits = f"CAST(('0x' || substring(md5(concat_ws(chr(31), {text})), 1, 15)) AS BIGINT)"
        parts.append(
            f"SELECT '{table}' AS {label}, count(*) AS row_count, CAST(coalesce(sum({bits}), 0) AS VARCHAR) AS digest FROM {source}")
    return " UNION ALL ".join(parts)


def profile_sql() -> str:
    """The exact columns of ``sources/catalog.profile`` over the given tables."""
    parts = []
    for table, contract in GIVEN.items():
        for i, (name, dtype) in enumerate(columns(contract), start=1):
            parts.append(
                f"SELECT '{table}' AS table_name, {i} AS ordinal, '{name}' AS column_name, "
                f"'{dtype}' AS data_type, true AS nullable, "
                f"count(*) AS row_count, count(*) - count({name}) AS null_count, "
                f"(count(*) - count({name}))::DOUBLE / nullif(count(*), 0) AS null_share, "
                f"{_text_sql(f'min({name})', dtype)} AS smallest, {_text_sql(f'max({name})', dtype)} AS largest FROM {table}")
    return " UNION ALL ".join(parts)


def samples_sql(n: int = 3) -> str:
    """The rows of ``sources/catalog.samples`` over the given tables."""
    parts = []
    for table, contract in GIVEN.items():
        text = ", ".join(_text_sql(c, t) for c, t in columns(contract))
        order = ", ".join(f"{k} NULLS LAST" for k in GIVEN_KEYS[table])
        parts.append(
            f"SELECT * FROM (SELECT '{table}' AS table_name, row_number() OVER (ORDER BY {order})::INT AS position, "
            f"concat_ws('|', {text}) AS row_text FROM {table}) WHERE position <= {n}")
    return " UNION ALL ".join(parts)
