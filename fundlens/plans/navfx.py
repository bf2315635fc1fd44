"""NAV with FX: X2 (fact conversion), X3 (stg_nav_aum_native), X9 (view).

FX tables are tiny next to the NAV rows (days x currencies) and a currency
key is extremely skewed (most funds share a handful of currencies). Every FX
join reads an aggregate of one row per (currency, day), so AQE sees its size in
bytes and broadcasts it, or splits the skewed side of a sort-merge join. The
as-of join is an equi-join on a day-dense rate calendar, not a range join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import to_date_lenient
from ..functions.numeric import to_float, to_float0
from ..functions.strings import upper_strip
from ..operators.distribution import attach_scalars
from ..operators.snapshots import first_per_key, latest_per_group_value
from .loaders import Dataset

NAV_COLS = [
    "fund_code",
    "nav_as_of_date",
    "aum",
    "aum_native",
    "fund_currency",
    "fx_rate_to_thb",
    "fx_rate_date",
    "fx_rate_status",
]


def fund_currency(thai_funds: DataFrame, base_ccy: str = config.BASE_CCY) -> DataFrame:
    """J11 + A13: one currency per fund, null -> base, stripped, upper."""
    f = first_per_key(thai_funds.select("fund_code", "currency"), ["fund_code"], [])
    return f.select("fund_code", upper_strip(F.coalesce(F.col("currency"), F.lit(base_ccy))).alias("fund_currency"))


def clean_fx(fx_rates: DataFrame) -> DataFrame:
    """Parsable date, non-blank currency, numeric rate."""
    fx = fx_rates.select(
        to_date_lenient("date_rate").alias("date_rate"),
        upper_strip(F.coalesce(F.col("from_ccy"), F.lit(""))).alias("from_ccy"),
        to_float("rate_to_thb").alias("rate_to_thb"),
    )
    return fx.where(F.col("date_rate").isNotNull() & (F.col("from_ccy") != "") & F.col("rate_to_thb").isNotNull())


def fx_latest_per_ccy(fx: DataFrame) -> DataFrame:
    """Newest (date, rate) per currency."""
    return latest_per_group_value(fx, "from_ccy", "date_rate", ["rate_to_thb"])


def nav_with_fx(ds: Dataset, base_ccy: str = config.BASE_CCY) -> DataFrame:
    """NAV in native currency converted with exact-date FX, else the
    newest rate overall, else 1.0 (with a status label)."""
    nav = ds.thai_nav_aum.select(
        "fund_code",
        to_date_lenient("nav_as_of_date").alias("nav_as_of_date"),
        to_float0("aum").alias("aum_native"),
    )
    nav = nav.join(fund_currency(ds.thai_funds, base_ccy), "fund_code", "left").withColumn(
        "fund_currency", F.coalesce(F.col("fund_currency"), F.lit(base_ccy))
    )
    fx_rows = ds.fx_rates.agg(F.count(F.lit(1)).alias("_fx_rows"))
    fx = clean_fx(ds.fx_rates)
    exact = one_rate_per_day(fx).select(
        F.col("from_ccy").alias("_x_ccy"),
        F.col("date_rate").alias("fx_rate_date_exact"),
        F.col("rate_to_thb").alias("fx_rate_exact"),
    )
    nav = nav.join(
        exact,
        (nav["fund_currency"] == exact["_x_ccy"]) & (nav["nav_as_of_date"] == exact["fx_rate_date_exact"]),
        "left",
    ).drop("_x_ccy")
    latest = fx_latest_per_ccy(fx).select(
        F.col("from_ccy").alias("_l_ccy"),
        F.col("date_rate").alias("fx_rate_date_latest"),
        F.col("rate_to_thb").alias("fx_rate_latest"),
    )
    nav = nav.join(latest, nav["fund_currency"] == latest["_l_ccy"], "left").drop("_l_ccy")
    nav = attach_scalars(nav, fx_rows)
    empty = F.col("_fx_rows") == 0
    is_base = F.col("fund_currency") == base_ccy
    rate = F.when(empty, F.lit(1.0)).otherwise(F.coalesce("fx_rate_exact", "fx_rate_latest", F.lit(1.0)))
    rate_date = F.when(empty, F.col("nav_as_of_date")).otherwise(
        F.coalesce(
            F.when(F.col("fx_rate_exact").isNotNull(), F.col("fx_rate_date_exact")).otherwise(
                F.col("fx_rate_date_latest")
            ),
            F.col("nav_as_of_date"),
        )
    )
    status = (
        F.when(empty, F.lit(config.FX_STATUS_NO_TABLE))
        .when(is_base, F.lit(config.FX_STATUS_BASE))
        .when(
            F.col("fx_rate_exact").isNull() & F.col("fx_rate_latest").isNull(), F.lit(config.FX_STATUS_MISSING)
        )
        .otherwise(F.lit(config.FX_STATUS_EXACT_OR_LATEST))
    )
    nav = nav.withColumn("fx_rate_to_thb", F.when(is_base, F.lit(1.0)).otherwise(rate))
    nav = nav.withColumn("fx_rate_date", rate_date).withColumn("fx_rate_status", status)
    nav = nav.withColumn("aum", F.coalesce(F.col("aum_native") * F.col("fx_rate_to_thb"), F.lit(0.0)))
    return nav.select(*NAV_COLS)


def stg_nav_aum_native(nav: DataFrame) -> DataFrame:
    """Native NAV per fund (first row per fund)."""
    n = nav.select("fund_code", "nav_as_of_date", "aum_native", "fund_currency")
    return first_per_key(n, ["fund_code"], [])


def one_rate_per_day(fx: DataFrame) -> DataFrame:
    """One row per (from_ccy, date_rate): the tables' key. Where a feed breaks
    it (say ``usd`` and ``USD`` on one day) the largest rate stands."""
    return fx.groupBy(F.upper(F.trim("from_ccy")).alias("from_ccy"), "date_rate").agg(F.max("rate_to_thb").alias("rate_to_thb"))


def asof_calendar(fx: DataFrame) -> DataFrame:
    """Day-dense validity calendar: for each currency and each day between
    its first and last rate date, the newest rate dated on or before that day.
    Size = currencies x days spanned; independent of the NAV rows."""
    w = Window.partitionBy("from_ccy").orderBy("date_rate")
    r = one_rate_per_day(fx).withColumn("_next", F.lead("date_rate").over(w))
    until = F.coalesce(F.date_sub(F.col("_next"), 1), F.col("date_rate"))
    return r.withColumn("_until", until).where(F.col("_until") >= F.col("date_rate")).select(
        "from_ccy",
        F.explode(F.sequence(F.col("date_rate"), F.col("_until"))).alias("day"),
        F.col("date_rate").alias("asof_date"),
        F.col("rate_to_thb").alias("asof_rate"),
    )


def asof_join(left: DataFrame, ccy_col: str, date_col: str, fx: DataFrame) -> DataFrame:
    """As-of LEFT join: newest FX rate dated on or before ``date_col``.
    Adds asof_date / asof_rate. Days after a currency's last rate take that
    last rate; days before its first rate get nulls."""
    cal = asof_calendar(fx)
    cal = cal.select(F.col("from_ccy").alias("_c_ccy"), F.col("day").alias("_c_day"), "asof_date", "asof_rate")
    last = latest_per_group_value(one_rate_per_day(fx), "from_ccy", "date_rate", ["rate_to_thb"]).select(
        F.col("from_ccy").alias("_t_ccy"), F.col("date_rate").alias("_t_date"), F.col("rate_to_thb").alias("_t_rate")
    )
    j = left.join(
        cal,
        (left[ccy_col] == cal["_c_ccy"]) & (left[date_col] == cal["_c_day"]),
        "left",
    )
    j = j.join(last, j[ccy_col] == last["_t_ccy"], "left")
    after = F.col(date_col) > F.col("_t_date")
    j = j.withColumn("asof_rate", F.coalesce(F.col("asof_rate"), F.when(after, F.col("_t_rate"))))
    j = j.withColumn("asof_date", F.coalesce(F.col("asof_date"), F.when(after, F.col("_t_date"))))
    return j.drop("_c_ccy", "_c_day", "_t_ccy", "_t_date", "_t_rate")


def fx_exact_join(left: DataFrame, ccy_col: str, date_col: str, fx: DataFrame) -> DataFrame:
    """Exact (currency, date) LEFT join; adds exact_rate."""
    x = one_rate_per_day(fx).select(F.col("from_ccy").alias("_e_ccy"), F.col("date_rate").alias("_e_date"), F.col("rate_to_thb").alias("exact_rate"))
    j = left.join(
        x, (left[ccy_col] == x["_e_ccy"]) & (left[date_col] == x["_e_date"]), "left"
    )
    return j.drop("_e_ccy", "_e_date")


def vw_nav_aum_thb(stg_nav: DataFrame, fx_rates: DataFrame, base_ccy: str = config.BASE_CCY) -> DataFrame:
    """Serving view: exact-date rate, else the newest rate on or before
    the NAV date, else 1.0; base currency is always 1.0."""
    fx = fx_rates.where(F.col("to_ccy") == "THB").select("from_ccy", "date_rate", "rate_to_thb")
    j = fx_exact_join(stg_nav, "fund_currency", "nav_as_of_date", fx)
    j = asof_join(j, "fund_currency", "nav_as_of_date", fx)
    is_base = F.col("fund_currency") == base_ccy
    rate = F.when(is_base, F.lit(1.0)).otherwise(F.coalesce("exact_rate", "asof_rate", F.lit(1.0)))
    status = (
        F.when(is_base, F.lit(config.FX_STATUS_BASE))
        .when(F.col("exact_rate").isNotNull(), F.lit(config.FX_STATUS_EXACT))
        .when(F.col("asof_rate").isNotNull(), F.lit(config.FX_STATUS_LATEST))
        .otherwise(F.lit(config.FX_STATUS_MISSING))
    )
    return j.select(
        "fund_code",
        "nav_as_of_date",
        "fund_currency",
        "aum_native",
        rate.alias("fx_rate_to_thb"),
        (F.col("aum_native") * rate).alias("aum_thb"),
        status.alias("fx_rate_status"),
    )
