"""Look-through exposure facts and mart aggregates.

Scale notes: per-fund totals are partial aggregates joined back (no
whole-fund windows); master holdings are de-duplicated before the
look-through join; NAV joins the bridge (few rows) before holdings fan it out, so
the wide facts are never shuffled for it; skewed masters are split by AQE
skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.numeric import clip_range, exact_sum, pct_product, safe_ratio, share_pct, to_float, to_float0
from ..functions.strings import holding_key, is_country_label, norm_code
from ..operators.distribution import attach_scalars, combine_rows, global_row_number, top_n

STOCK_COLS = [
    "fund_code",
    "ft_ticker",
    "ticker",
    "map_method",
    "feeder_name",
    "feeder_weight_pct",
    "feeder_weight_pct_norm",
    "holding_name",
    "holding_ticker",
    "holding_type",
    "portfolio_weight_pct",
    "true_weight_pct",
    "aum",
    "aum_native",
    "fund_currency",
    "fx_rate_to_thb",
    "fx_rate_date",
    "fx_rate_status",
    "true_value_thb",
    "nav_as_of_date",
    "date_scraper",
]
ALLOC_COLS = [
    "fund_code",
    "ft_ticker",
    "ticker",
    "map_method",
    "category_name",
    "weight_pct",
    "feeder_weight_pct",
    "feeder_weight_pct_norm",
    "true_weight_pct",
    "aum",
    "aum_native",
    "fund_currency",
    "fx_rate_to_thb",
    "fx_rate_date",
    "fx_rate_status",
    "true_value_thb",
]

# what the facts take from the bridge
BRIDGE_FACT_COLS = STOCK_COLS[:7]


def bridge_mapped(bridge: DataFrame) -> DataFrame:
    """Bridge rows with a master and a positive weight."""
    b = bridge.where(F.col("ft_ticker").isNotNull()).withColumn("feeder_weight_pct", to_float0("feeder_weight_pct"))
    return b.where(F.col("feeder_weight_pct") > 0)


def normalize_weights(bridge_pos: DataFrame) -> DataFrame:
    """W / sum(w per fund) * min(sum, 100): scaled down only, never up.
    The per-fund sum is a partial aggregate joined back."""
    sums = bridge_pos.groupBy("fund_code").agg(exact_sum("feeder_weight_pct").alias("_sum_w"))
    j = bridge_pos.join(sums, "fund_code", "left")
    norm = (F.col("feeder_weight_pct") / F.nullif(F.col("_sum_w"), F.lit(0.0))) * F.least(F.col("_sum_w"), F.lit(100.0))
    return j.withColumn("feeder_weight_pct_norm", F.coalesce(norm, F.lit(0.0))).drop("_sum_w")


def bridge_ok(bridge: DataFrame) -> DataFrame:
    return normalize_weights(bridge_mapped(bridge))


def dedupe_max(df: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """A1/A2: drop rows with a null key, then max weight per key."""
    w = df.withColumn(weight, to_float0(weight)).dropna(subset=keys)
    return w.groupBy(*keys).agg(F.max(weight).alias(weight))


def with_nav(bok: DataFrame, nav: DataFrame) -> DataFrame:
    """LEFT join NAV; missing AUM -> 0."""
    return bok.join(nav, "fund_code", "left").withColumn("aum", to_float0("aum"))


def value_thb():
    """Aum * true weight / 100."""
    return F.coalesce(pct_product("aum", "true_weight_pct"), F.lit(0.0))


def fact_exposure_stock(bridge_nav: DataFrame, ft_holdings: DataFrame) -> DataFrame:
    """A1 -> J10 -> J7 -> C1/C8."""
    keys = ["ticker", "holding_name", "holding_ticker", "holding_type", "date_scraper"]
    h = dedupe_max(ft_holdings, keys, "portfolio_weight_pct")
    j = bridge_nav.where(F.col("ticker").isNotNull()).join(h.where(F.col("ticker").isNotNull()), "ticker", "inner")
    j = j.withColumn("true_weight_pct", pct_product("feeder_weight_pct_norm", "portfolio_weight_pct"))
    j = j.withColumn("true_value_thb", value_thb()).select(*STOCK_COLS)
    j = j.withColumn("holding_ticker_norm", norm_code("holding_ticker"))
    j = j.withColumn("holding_name_norm", norm_code("holding_name"))
    return j.withColumn("holding_key", holding_key("holding_ticker_norm", "holding_name_norm"))


def _fact_alloc(bridge_nav: DataFrame, alloc: DataFrame) -> DataFrame:
    a = dedupe_max(alloc, ["ticker", "category_name", "date_scraper"], "weight_pct")
    j = bridge_nav.where(F.col("ticker").isNotNull()).join(a.where(F.col("ticker").isNotNull()), "ticker", "inner")
    j = j.withColumn("true_weight_pct", pct_product("feeder_weight_pct_norm", "weight_pct"))
    return j.withColumn("true_value_thb", value_thb())


def fact_exposure_sector(bridge_nav: DataFrame, ft_sector: DataFrame) -> DataFrame:
    """A2 -> J10 -> J8 -> P1 -> P2."""
    j = _fact_alloc(bridge_nav, ft_sector).select(*ALLOC_COLS, "nav_as_of_date", "date_scraper")
    return j.withColumnsRenamed({"category_name": "sector_name", "weight_pct": "sector_weight_pct"})


def fact_exposure_region(bridge_nav: DataFrame, ft_region: DataFrame) -> DataFrame:
    """A2 -> J10 -> J9 -> C10 -> P1 -> P2."""
    j = _fact_alloc(bridge_nav, ft_region).withColumn("is_country_like", is_country_label("category_name"))
    j = j.select(*ALLOC_COLS, "is_country_like", "nav_as_of_date", "date_scraper")
    return j.withColumnsRenamed({"category_name": "region_name", "weight_pct": "region_weight_pct"})


def fund_coverage(thai_feeder: DataFrame, bok: DataFrame, nav: DataFrame) -> DataFrame:
    """Feeder totals (raw, clipped at 100), mapped totals, ratio in
    [0, 1] (null when the total is 0), plus NAV columns."""
    ft = thai_feeder.withColumn("w", to_float0("feeder_weight_pct")).dropna(subset=["fund_code"])
    ft = ft.groupBy("fund_code").agg(exact_sum("w").alias("raw_total_fund_holdings_pct"))
    ft = ft.withColumn("total_fund_holdings_pct", F.least(F.col("raw_total_fund_holdings_pct"), F.lit(100.0)))
    mapped = bok.groupBy("fund_code").agg(exact_sum("feeder_weight_pct_norm").alias("mapped_holdings_pct"))
    cov = ft.join(mapped, "fund_code", "left").withColumn(
        "mapped_holdings_pct", F.coalesce(F.col("mapped_holdings_pct"), F.lit(0.0))
    )
    cov = cov.withColumn(
        "coverage_ratio", clip_range(safe_ratio("mapped_holdings_pct", "total_fund_holdings_pct"), 0.0, 1.0)
    )
    return cov.join(nav, "fund_code", "left")


def fund_returns(bok: DataFrame, ft_return: DataFrame, nav: DataFrame) -> DataFrame:
    """J15 (+A28): distinct (fund, master) pairs with their master's returns
    (ticker compared null-safe) and the fund's THB AUM."""
    pairs = bok.select("fund_code", "ft_ticker", "ticker").distinct()
    r = ft_return.select(
        F.col("ft_ticker").alias("_r_ft"),
        F.col("ticker").alias("_r_t"),
        to_float("avg_fund_return_1y").alias("avg_fund_return_1y"),
        to_float("avg_fund_return_3y").alias("avg_fund_return_3y"),
    )
    j = pairs.join(r, (pairs["ft_ticker"] == r["_r_ft"]) & pairs["ticker"].eqNullSafe(r["_r_t"]), "left")
    j = j.drop("_r_ft", "_r_t")
    return j.join(nav.select("fund_code", "aum"), "fund_code", "left")


def weighted_avg(col: str, weight: str = "aum"):
    """A10: AUM-weighted mean over rows with a value and AUM > 0; null if none
    (an aggregate Column with exact sums)."""
    ok = F.col(col).isNotNull() & F.col(weight).isNotNull() & (F.col(weight) > 0)
    num = exact_sum(F.when(ok, F.col(col) * F.col(weight)))
    den = exact_sum(F.when(ok, F.col(weight)))
    return F.try_divide(num, F.nullif(den, F.lit(0.0))).alias(col)


def avg_fund_return(bok: DataFrame, ft_return: DataFrame, nav: DataFrame) -> DataFrame:
    """One row with both weighted returns (one aggregate)."""
    fr = fund_returns(bok, ft_return, nav)
    return fr.agg(weighted_avg("avg_fund_return_1y"), weighted_avg("avg_fund_return_3y"))


def holding_order() -> list:
    return [
        F.col("total_true_value_thb").desc_nulls_last(),
        F.col("total_true_weight_pct").desc_nulls_last(),
        F.col("holding_key").asc_nulls_last(),
        F.col("holding_ticker").asc_nulls_last(),
        F.col("holding_type").asc_nulls_last(),
    ]


def top_holdings_unranked(stock: DataFrame) -> DataFrame:
    """Per (holding_key, ticker, type): sums and the first name in bridge
    order (fund, master, name)."""
    s = stock.dropna(subset=["holding_key", "holding_ticker_norm", "holding_type"])
    g = s.groupBy("holding_key", "holding_ticker_norm", "holding_type").agg(
        exact_sum("true_weight_pct").alias("total_true_weight_pct"),
        exact_sum("true_value_thb").alias("total_true_value_thb"),
        F.min_by("holding_name", F.struct("fund_code", "ft_ticker", "holding_name")).alias("holding_name"),
    )
    return g.select(
        "holding_key",
        F.nullif(F.col("holding_ticker_norm"), F.lit("")).alias("holding_ticker"),
        "holding_type",
        "total_true_weight_pct",
        "total_true_value_thb",
        "holding_name",
    )


def agg_top_holdings(stock: DataFrame) -> DataFrame:
    """A6 + W6: ranked 1..n by value, then weight (distributed ranking)."""
    return global_row_number(top_holdings_unranked(stock), holding_order(), "rank_no")


def agg_top_holdings_topn(stock: DataFrame, n: int = config.TOP_N) -> DataFrame:
    """The first n ranks without ranking everything."""
    t = top_n(top_holdings_unranked(stock), holding_order(), n)
    # n rows at most: a small, bounded window
    return t.withColumn("rank_no", F.row_number().over(Window.orderBy(*holding_order())).cast("long"))


def _with_share(agg: DataFrame) -> DataFrame:
    total = agg.agg(exact_sum("total_true_value_thb").alias("_total"))
    out = attach_scalars(agg, total)
    return out.withColumn("allocation_share_pct", share_pct("total_true_value_thb", "_total")).drop("_total")


def agg_sector_exposure(sector: DataFrame) -> DataFrame:
    """A7 + W5."""
    g = sector.dropna(subset=["sector_name"]).groupBy("sector_name").agg(
        exact_sum("true_weight_pct").alias("total_true_weight_pct"),
        exact_sum("true_value_thb").alias("total_true_value_thb"),
    )
    return _with_share(g)


def agg_region_exposure(region: DataFrame) -> DataFrame:
    """A8."""
    return (
        region.dropna(subset=["region_name", "is_country_like"])
        .groupBy("region_name", "is_country_like")
        .agg(
            exact_sum("true_weight_pct").alias("total_true_weight_pct"),
            exact_sum("true_value_thb").alias("total_true_value_thb"),
        )
    )


def agg_country_exposure(region_agg: DataFrame) -> DataFrame:
    """A9 + P14 + W5."""
    return _with_share(region_agg.where(F.col("is_country_like")))


def alloc_order(name_col: str) -> list:
    return [F.col("total_true_value_thb").desc_nulls_last(), F.col(name_col).asc_nulls_last()]


def dashboard_cards(
    stock: DataFrame, sector_agg: DataFrame, country_agg: DataFrame, returns: DataFrame, bok: DataFrame
) -> DataFrame:
    """One row; every part is a one-row aggregate, merged without
    joins."""
    total = stock.agg(exact_sum("true_value_thb").alias("total_holdings_value_thb"))
    # Ties on value: the alphabetically first name wins (min name among max value).
    top_sector = sector_agg.orderBy(*alloc_order("sector_name")).limit(1).select(
        F.col("sector_name").alias("top_sector_name"), F.col("allocation_share_pct").alias("top_sector_weight_pct")
    )
    top_country = country_agg.orderBy(*alloc_order("region_name")).limit(1).select(
        F.col("region_name").alias("top_country_name"), F.col("allocation_share_pct").alias("top_country_weight_pct")
    )
    counts = bok.agg(
        F.countDistinct("fund_code").cast("long").alias("mapped_fund_count"),
        F.countDistinct("ft_ticker").cast("long").alias("mapped_master_count"),
    )
    row = combine_rows([total, top_sector, top_country, returns, counts])
    return row.select(
        F.coalesce(F.col("total_holdings_value_thb"), F.lit(0.0)).alias("total_holdings_value_thb"),
        "top_sector_name",
        "top_sector_weight_pct",
        "top_country_name",
        "top_country_weight_pct",
        "avg_fund_return_1y",
        "avg_fund_return_3y",
        F.coalesce(F.col("mapped_fund_count"), F.lit(0)).cast("long").alias("mapped_fund_count"),
        F.coalesce(F.col("mapped_master_count"), F.lit(0)).cast("long").alias("mapped_master_count"),
    )
