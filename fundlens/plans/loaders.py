"""Source loading: latest snapshots and latest rows per entity.

``src`` is any mapping name -> DataFrame (the test-data adapter, or a dict of
catalog / parquet / JDBC frames). Each loader returns exactly the columns the
later stages read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.strings import non_blank, upper_trim
from ..operators.snapshots import asc, at_newest, desc, first_per_key, newest_dates, newest_rows, newest_rows_near
from ..sources.readers import FX_TABLE_SCHEMA, resolve_columns, table_or_empty


class Dataset:
    """The ten loaded sources, each built on first use. ``keep`` shares those
    that several plans read; they hold the newest rows only."""

    def __init__(self, spark: SparkSession, src: Mapping[str, DataFrame], keep: Callable[[DataFrame], DataFrame] = lambda df: df):
        self.spark = spark
        self.src = src
        self.keep = keep

    @cached_property
    def thai_funds(self) -> DataFrame:
        return load_thai_funds(self.src)

    @cached_property
    def thai_isin(self) -> DataFrame:
        return load_thai_isin(self.src)

    @cached_property
    def thai_nav_aum(self) -> DataFrame:
        return self.keep(load_thai_nav_aum(self.src))

    @cached_property
    def holding_dates(self) -> DataFrame:
        return self.keep(load_holding_dates(self.src))

    @cached_property
    def thai_feeder(self) -> DataFrame:
        return self.keep(load_thai_feeder(self.src, self.holding_dates))

    @cached_property
    def ft_static(self) -> DataFrame:
        return self.keep(load_ft_static(self.src, self.keep))

    @cached_property
    def ft_holdings(self) -> DataFrame:
        return self.keep(load_ft_holdings(self.src, self.keep))

    @cached_property
    def ft_sector(self) -> DataFrame:
        return self.keep(load_allocation(self.src, "sector", self.keep, self.sector_dates))

    @cached_property
    def sector_dates(self) -> DataFrame:
        return self.keep(load_allocation_dates(self.src, "sector"))

    @cached_property
    def ft_region(self) -> DataFrame:
        # a master's allocations are scraped together
        near = self.sector_dates if "ft_sector_allocation" in self.src else None
        return self.keep(load_allocation(self.src, "region", self.keep, near=near))

    @cached_property
    def ft_return(self) -> DataFrame:
        return self.keep(load_ft_return(self.src))

    @cached_property
    def fx_rates(self) -> DataFrame:
        return self.keep(load_fx_rates(self.spark, self.src))


def load_thai_funds(src: Mapping[str, DataFrame]) -> DataFrame:
    return src["funds_master_info"].select(
        "fund_code", "full_name_th", "full_name_en", "amc", "category", "currency", "country"
    )


def load_thai_isin(src: Mapping[str, DataFrame]) -> DataFrame:
    """P4 + P5 + C1: ISIN codes per fund (type compared case-blind)."""
    c = src["funds_codes"]
    return c.where((F.upper(F.col("type")) == "ISIN") & non_blank("code")).select(
        "fund_code", upper_trim("code").alias("isin_code")
    )


def load_thai_nav_aum(src: Mapping[str, DataFrame]) -> DataFrame:
    """Per fund the newest row with an AUM, else the newest row."""
    d = src["funds_daily"].select("fund_code", "nav_date", "aum", "daily_id")
    first = first_per_key(
        d, ["fund_code"], [asc(F.col("aum").isNull()), desc("nav_date"), desc("daily_id")]
    )
    return first.select("fund_code", F.col("nav_date").alias("nav_as_of_date"), "aum")


def load_holding_dates(src: Mapping[str, DataFrame]) -> DataFrame:
    """Date of the newest holdings snapshot of each fund, over all types."""
    return newest_dates(src["funds_holding"], ["fund_code"], "as_of_date")


def load_thai_feeder(src: Mapping[str, DataFrame], dates: DataFrame | None = None) -> DataFrame:
    """J1 + J3: newest holdings snapshot per fund, then only 'Fund' rows.
    ``dates``: shared ``load_holding_dates``."""
    h = src["funds_holding"].select("fund_code", "name", "percent", "as_of_date", "type")
    dates = load_holding_dates(src) if dates is None else dates
    snap = at_newest(h, ["fund_code"], "as_of_date", dates).where(F.upper(F.col("type")) == "FUND")
    return snap.select(
        "fund_code",
        F.col("name").alias("feeder_name"),
        F.col("percent").alias("feeder_weight_pct"),
        "as_of_date",
    )


def load_ft_static(src: Mapping[str, DataFrame], keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Newest static record per master (date, then creation time). Only
    rows at a master's newest date can be it: ``keep`` writes those dates (one
    small row per master), and the semi join with them goes below an aggregate
    by master and date, as daily records are derived."""
    s = src["ft_static_detail"].where(F.col("ft_ticker").isNotNull())
    s = s.select(
        "ft_ticker",
        "ticker",
        "name",
        "ticker_type",
        upper_trim("isin_number").alias("isin_number"),
        "date_scraper",
        "assets_aum_full_value",
        "created_at",
    )
    # a master without any date has a record too
    dates = keep(s.groupBy("ft_ticker").agg(F.max("date_scraper").alias("date_scraper")))
    dates = dates.select(F.col("ft_ticker").alias("_m"), F.col("date_scraper").alias("_d"))
    s = s.join(dates, (s["ft_ticker"] == dates["_m"]) & s["date_scraper"].eqNullSafe(dates["_d"]), "left_semi")
    first = first_per_key(s, ["ft_ticker"], [desc("date_scraper"), desc("created_at")])
    return first.drop("created_at")


def load_ft_holdings(src: Mapping[str, DataFrame], keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """J1 + J3: newest holdings snapshot per master, top-10 rows only. ``keep``
    writes the masters' newest dates, as in ``load_ft_static``."""
    h = src["ft_holdings"].select(
        "ticker", "holding_name", "holding_ticker", "holding_type", "portfolio_weight_pct", "date_scraper",
        "allocation_type",
    )
    dates = keep(newest_dates(h, ["ticker"], "date_scraper"))
    snap = at_newest(h, ["ticker"], "date_scraper", dates).where(F.lower(F.col("allocation_type")) == "top_10_holdings")
    return snap.select(*[c for c in h.columns if c != "allocation_type"])


ALLOC_SPEC = {
    "sector": {
        "ticker": ["ticker"],
        "category_name": ["category_name", "sector_name"],
        "weight_pct": ["weight_pct", "sector_weight_pct"],
        "date_scraper": ["date_scraper"],
    },
    "region": {
        "ticker": ["ticker"],
        "category_name": ["category_name", "region_name"],
        "weight_pct": ["weight_pct", "region_weight_pct"],
        "date_scraper": ["date_scraper"],
    },
}


def _allocation(src: Mapping[str, DataFrame], kind: str) -> DataFrame:
    """An allocation table; column names are probed (old and new names)."""
    table = "ft_sector_allocation" if kind == "sector" else "ft_region_allocation"
    return resolve_columns(src[table], ALLOC_SPEC[kind])


def load_allocation_dates(src: Mapping[str, DataFrame], kind: str) -> DataFrame:
    """Date of each master's newest sector / region allocation."""
    return newest_dates(_allocation(src, kind), ["ticker"], "date_scraper")


def load_allocation(
    src: Mapping[str, DataFrame],
    kind: str,
    keep: Callable[[DataFrame], DataFrame] | None = None,
    dates: DataFrame | None = None,
    near: DataFrame | None = None,
) -> DataFrame:
    """S2 + J1: newest sector / region allocation per master. With ``keep`` the
    masters' newest dates (``dates``: shared ``load_allocation_dates``) are written
    first and the old rows drop without a sort, before the joins that derive the
    table; without it the table is read once and ranked. ``near``: newest dates of
    the other table, where rows are looked for first."""
    a = _allocation(src, kind)
    if keep is None:
        return newest_rows(a, ["ticker"], "date_scraper")
    if near is not None:
        return newest_rows_near(a, ["ticker"], "date_scraper", near, keep).select(*a.columns)
    dates = keep(load_allocation_dates(src, kind)) if dates is None else dates
    return at_newest(a, ["ticker"], "date_scraper", dates).select(*a.columns)


RETURN_SPEC = {
    "ft_ticker": ["ft_ticker", "ticker"],
    "ticker": ["ticker"],
    "avg_fund_return_1y": ["avg_fund_return_1y", "avg_return_1y_pct"],
    "avg_fund_return_3y": ["avg_fund_return_3y"],
    "date_scraper": ["date_scraper", "as_of_date"],
    "created_at": ["created_at", "date_scraper", "as_of_date"],
}
RETURN_TYPES = {"avg_fund_return_3y": T.DoubleType(), "avg_fund_return_1y": T.DoubleType()}


def load_ft_return(src: Mapping[str, DataFrame]) -> DataFrame:
    """S2 + W3: newest return record per key (null key = one group)."""
    r = resolve_columns(src["ft_avg_fund_return"], RETURN_SPEC, RETURN_TYPES)
    first = first_per_key(r, ["ft_ticker"], [desc("date_scraper"), desc("created_at")])
    return first.select("ft_ticker", "ticker", "avg_fund_return_1y", "avg_fund_return_3y", "date_scraper")


def load_fx_rates(spark: SparkSession, src: Mapping[str, DataFrame], table: str = "daily_fx_rates") -> DataFrame:
    """S3 + P4: FX rows to THB; an absent table gives an empty frame."""
    fx = table_or_empty(spark, src, table, FX_TABLE_SCHEMA)
    return fx.where(F.upper(F.trim(F.col("to_ccy"))) == "THB").select(
        "date_rate",
        upper_trim("from_ccy").alias("from_ccy"),
        upper_trim("to_ccy").alias("to_ccy"),
        "rate_to_thb",
        "source_system",
    )


def load_dataset(
    spark: SparkSession, src: Mapping[str, DataFrame], keep: Callable[[DataFrame], DataFrame] = lambda df: df
) -> Dataset:
    return Dataset(spark, src, keep)
