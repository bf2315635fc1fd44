"""Serving layer: views (S7), search tables (A16/A17/T5), dashboard maths
(W9-W12, P12/P13, C6/C7/C11) and the payload (S9/S10/X14).

The dashboard lists are bounded (Top-k, 500-row search lists); the universe
totals they compare against are one-row aggregates. The payload export lists
every search row. Nothing collects an unbounded list into one row: the payload
is a long table, one row per item, that a writer emits as JSON lines in parallel.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions.numeric import SUM_SCALE, exact_sum
from ..functions.strings import clean_holding_name, contains_ci, display_label, normalize_ticker
from ..operators.distribution import attach_scalars, top_n


def search_by_fund(stock: DataFrame) -> DataFrame:
    """Per (fund, holding) sums, fund first."""
    g = stock.groupBy("fund_code", "holding_key", "holding_ticker_norm", "holding_type").agg(
        F.min("holding_name").alias("holding_name"),
        exact_sum("true_weight_pct").alias("total_true_weight_pct"),
        exact_sum("true_value_thb").alias("total_true_value_thb"),
    )
    g = g.withColumn("holding_ticker", F.nullif(F.col("holding_ticker_norm"), F.lit("")))
    return g.select(
        "fund_code", "holding_name", "holding_ticker", "holding_type", "total_true_weight_pct", "total_true_value_thb")


def asset_first(search: DataFrame) -> DataFrame:
    """Search rows (or numbered search rows) with the asset's columns first."""
    first = ["holding_name", "holding_ticker", "holding_type", "fund_code"]
    return search.select(*first, *[c for c in search.columns if c not in first])


def search_by_asset(stock: DataFrame) -> DataFrame:
    """The same grouping, asset first."""
    return asset_first(search_by_fund(stock))


def search_order() -> list:
    return [
        F.col("total_true_value_thb").desc_nulls_last(),
        F.col("fund_code").asc_nulls_last(),
        F.col("holding_name").asc_nulls_last(),
        F.col("holding_ticker").asc_nulls_last(),
        F.col("holding_type").asc_nulls_last(),
    ]


def search_top(search: DataFrame, n: int = config.SEARCH_PAYLOAD_LIMIT) -> DataFrame:
    """T5: the n most valuable search rows (distributed top-n)."""
    return top_n(search, search_order(), n)


def search_fund_contains(search: DataFrame, query: str, n: int = config.SEARCH_UI_LIMIT) -> DataFrame:
    """Case-blind substring match on fund_code; first n in list order."""
    return top_n(search.where(contains_ci("fund_code", query)), search_order(), n)


def search_asset_contains(search: DataFrame, query: str, n: int = config.SEARCH_UI_LIMIT) -> DataFrame:
    """Match on holding name or ticker (null -> '')."""
    cond = contains_ci("holding_name", query) | contains_ci("holding_ticker", query)
    return top_n(search.where(cond), search_order(), n)


def holding_labels(top: DataFrame) -> DataFrame:
    """C6 + C7 + C11: display columns of a holdings list."""
    t = top.withColumn("ticker_display", normalize_ticker("holding_ticker"))
    t = t.withColumn("clean_name", clean_holding_name("holding_name", "holding_ticker"))
    return t.withColumn("label", display_label("clean_name", "ticker_display"))


def pct_of_max(shown: DataFrame, value: str) -> DataFrame:
    """Value / max(max(value), 1) * 100 over a shown (bounded) list."""
    mx = shown.agg(F.max(value).alias("_max"))
    out = attach_scalars(shown, mx)
    denom = F.greatest(F.coalesce(F.col("_max"), F.lit(1.0)), F.lit(1.0))
    return out.withColumn("pct_of_max", F.col(value) / denom * 100.0).drop("_max")


def donut(
    rows: DataFrame, label: str, value: str, order: list, k: int, basis: str = "all"
) -> DataFrame:
    """W10 + W11 + W12: Top-k slices with shares of the shown total or of
    the universe total (0 -> 1), running start/end, and an 'Others' slice
    for the remainder when basis is 'all' and the shown total is smaller."""
    shown = top_n(rows, order, k)
    shown = shown.withColumn("rank_no", F.row_number().over(Window.orderBy(*order)).cast("long"))
    all_total = rows.agg(exact_sum(value).alias("_all"))
    shown_total = shown.agg(exact_sum(value).alias("_shown"))
    s = attach_scalars(attach_scalars(shown, all_total), shown_total)
    base = F.col("_all") if basis == "all" else F.col("_shown")
    denom = F.when(F.coalesce(base, F.lit(0.0)) != 0, base).otherwise(F.lit(1.0))
    s = s.withColumn("share_pct", F.coalesce(F.col(value), F.lit(0.0)) / denom * 100.0)
    w = Window.orderBy("rank_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = F.sum(F.floor(F.col("share_pct") * SUM_SCALE + 0.5).cast("decimal(38,0)")).over(w)
    s = s.withColumn("end_pct", cum.cast("double") / SUM_SCALE)
    s = s.withColumn("start_pct", F.col("end_pct") - F.col("share_pct"))
    slices = s.select(
        F.col(label).cast("string").alias("label"), F.col(value).alias("value"), "rank_no", "share_pct",
        "start_pct", "end_pct",
    )
    if basis != "all":
        return slices
    rest = attach_scalars(all_total, shown_total).where(F.coalesce(F.col("_shown"), F.lit(0.0)) < F.col("_all"))
    others = rest.select(
        F.lit("Others").alias("label"),
        (F.col("_all") - F.coalesce(F.col("_shown"), F.lit(0.0))).alias("value"),
        F.lit(k + 1).cast("long").alias("rank_no"),
        ((F.col("_all") - F.coalesce(F.col("_shown"), F.lit(0.0))) / F.col("_all") * 100.0).alias("share_pct"),
        F.lit(None).cast("double").alias("start_pct"),
        F.lit(None).cast("double").alias("end_pct"),
    )
    return slices.unionByName(others)


def norm_rows(df: DataFrame) -> DataFrame:
    """Decimals -> double, dates / timestamps -> ISO text, rest as is."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


def serving_views(m) -> dict[str, DataFrame]:
    """The seven serving views over a Mart."""
    return {
        "vw_dashboard_cards": m.cards,
        "vw_top_holdings": m.top_holdings_topn.select(
            "rank_no", "holding_name", "holding_ticker", "holding_type", "total_true_weight_pct",
            "total_true_value_thb",
        ),
        "vw_sector_allocation": m.sector_agg.select("sector_name", "total_true_weight_pct", "total_true_value_thb"),
        "vw_country_allocation": m.country_agg.select(
            F.col("region_name").alias("country_name"), "total_true_weight_pct", "total_true_value_thb"
        ),
        "vw_search_by_fund": search_by_fund(m.stock),
        "vw_search_by_asset": search_by_asset(m.stock),
        "vw_nav_aum_thb": m.vw_nav_aum_thb,
    }


def summary_rows(m) -> DataFrame:
    """One summary row per scope: ``ALL`` from the dashboard cards, TH and
    FOREIGN from the scoped cards. A scope without a card gets an empty row."""
    both = ["top_sector_name", "top_sector_weight_pct", "top_country_name", "top_country_weight_pct",
            "avg_fund_return_1y", "avg_fund_return_3y", "mapped_fund_count", "mapped_master_count"]
    main = m.cards.limit(1).select(
        F.lit("ALL").alias("scope"), F.col("total_holdings_value_thb").alias("total_value_thb"), *both,
        F.lit(None).cast("long").alias("fund_count"), F.lit(None).cast("date").alias("as_of_date"))
    found = main.unionByName(m.star.scoped_cards().where("scope <> 'ALL'"))
    scopes = m.cards.sparkSession.range(1).select(F.explode(F.array(*[F.lit(s) for s in config.SCOPES])).alias("scope"))
    return m._keep(scopes.join(found, "scope", "left"))  # three rows, read by three sections


def payload_sections(m, search_limit: int | None = config.SEARCH_PAYLOAD_LIMIT) -> dict[str, DataFrame]:
    """The 13 payload sections, each with its own columns. Lists are
    ordered by ``position`` or ``rank_no``; search lists hold the ``search_limit``
    most valuable rows, or every row (None)."""
    from ..operators.distribution import global_row_number
    from .exposure import agg_top_holdings_topn, alloc_order

    def alloc(df: DataFrame, label: str) -> DataFrame:
        return global_row_number(df, alloc_order(label), "position")

    def thai(kind: str) -> DataFrame:
        rows = m.star.scoped_exposure().where((F.col("scope") == "TH") & (F.col("dimension") == kind))
        return alloc(rows.select(
            F.col("name").alias(f"{kind}_name"), F.col("total_weight_pct").alias("total_true_weight_pct"),
            F.col("total_value_thb").alias("total_true_value_thb"), "allocation_share_pct", "as_of_date"), f"{kind}_name")

    summary = summary_rows(m)
    top_thai = m.star.top_thai_holdings()
    if search_limit is None:
        # both lists have the same rows in the same order: grouped and numbered once
        by_fund = global_row_number(search_by_fund(m.stock_shared), search_order(), "position")
        by_asset = asset_first(by_fund)
    else:
        # at most search_limit rows: a bounded window
        place = F.row_number().over(Window.orderBy(*search_order())).cast("long")
        by_fund, by_asset = (search_top(rows(m.stock_shared), search_limit).withColumn("position", place)
                             for rows in (search_by_fund, search_by_asset))
    return {
        "dashboard_summary": summary.where("scope = 'ALL'").drop("fund_count", "as_of_date"),
        "dashboard_summary_thai": summary.where("scope = 'TH'"),
        "dashboard_summary_global": summary.where("scope = 'FOREIGN'"),
        "top_thai_holdings_top10": top_thai.where(F.col("rank_no") <= m.n),
        "top_thai_holdings_all": top_thai,
        "top_global_traceability_top10": agg_top_holdings_topn(m.stock_shared, m.n),
        "top_global_traceability_all": m.star.top_global_traceability(),
        "sector_allocation_thai": thai("sector"),
        "sector_allocation_global": alloc(m.sector_agg, "sector_name"),
        "country_allocation_thai": thai("country"),
        "country_allocation_global": alloc(m.country_agg.withColumnRenamed("region_name", "country_name"), "country_name"),
        "search_by_fund": by_fund,
        "search_by_asset": by_asset,
    }


# section -> columns that hold position, name, value and weight
_ITEM_COLS = {
    **{s: ("1", "top_sector_name", "total_value_thb", "top_sector_weight_pct")
       for s in ("dashboard_summary", "dashboard_summary_thai", "dashboard_summary_global")},
    **{s: ("rank_no", "symbol", "total_thai_fund_value", "total_weight_pct")
       for s in ("top_thai_holdings_top10", "top_thai_holdings_all")},
    "top_global_traceability_top10": ("rank_no", "holding_name", "total_true_value_thb", "total_true_weight_pct"),
    "top_global_traceability_all": ("rank_no", "holding_name", "global_fund_value", "total_weight_pct"),
    **{f"{kind}_allocation_{scope}": ("position", f"{kind}_name", "total_true_value_thb", "total_true_weight_pct")
       for kind in ("sector", "country") for scope in ("thai", "global")},
    "search_by_fund": ("position", "fund_code", "total_true_value_thb", "total_true_weight_pct"),
    "search_by_asset": ("position", "holding_name", "total_true_value_thb", "total_true_weight_pct"),
}


def payload_items(m, search_limit: int | None = config.SEARCH_PAYLOAD_LIMIT) -> DataFrame:
    """The payload as a long table, one row per list item: (section,
    position, name, value_thb, weight_pct). ``search_limit`` as above."""
    parts = []
    for section, df in payload_sections(m, search_limit).items():
        position, name, value, weight = _ITEM_COLS[section]
        parts.append(df.select(
            F.lit(section).alias("section"), F.expr(position).cast("long").alias("position"), F.col(name).alias("name"),
            F.col(value).alias("value_thb"), F.col(weight).alias("weight_pct")))
    return reduce(DataFrame.unionByName, parts)


def section_order(sections: dict[str, DataFrame]) -> dict[str, str]:
    """The column that orders each list; summaries are single records."""
    return {s: "rank_no" if "rank_no" in df.columns else "position" for s, df in sections.items()
            if not s.startswith("dashboard_summary")}


def write_payload(sections: dict[str, DataFrame], path: str) -> None:
    """S9 sink: JSON lines, a folder for each section (parallel writers)."""
    for name, df in sections.items():
        norm_rows(df).write.mode("overwrite").json(f"{path.rstrip('/')}/{name}")


def round_summary(cards: DataFrame) -> DataFrame:
    """M9: summary rounding (2 and 4 digits) and display units (billions,
    one-digit percent)."""
    return cards.select(
        "mapped_fund_count", "mapped_master_count",
        F.round("total_holdings_value_thb", 2).alias("total_holdings_value_thb"),
        "top_sector_name", F.round(F.coalesce("top_sector_weight_pct", F.lit(0.0)), 4).alias("top_sector_weight_pct"),
        "top_country_name", F.round(F.coalesce("top_country_weight_pct", F.lit(0.0)), 4).alias("top_country_weight_pct"),
        F.round(F.col("total_holdings_value_thb") / 1e9, 0).alias("total_billions"),
        F.round("top_sector_weight_pct", 1).alias("top_sector_pct_1dp"),
    )
