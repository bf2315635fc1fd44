"""FX refresh: payload -> rows -> cross rates -> keyed upsert -> staleness.

The provider payload is a JSON document per day (units of each currency per
USD). Test payloads are derived from ``daily_fx_rates`` by Spark itself
(``payloads_from_rates``), so the job's size follows the FX table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import date_age_days, unix_to_date
from ..operators.snapshots import desc, first_per_key

PAYLOAD_SCHEMA = "rates map<string,double>, time_last_update_unix bigint, provider string, documentation string"


def payloads_from_rates(fx: DataFrame) -> DataFrame:
    """One JSON payload per rate date: USD-based rates (THB = THB per USD).
    Days without a USD rate produce a payload without THB (invalid)."""
    usd = fx.where(F.col("from_ccy") == "USD").select("date_rate", F.col("rate_to_thb").alias("_usd"))
    j = fx.join(usd, "date_rate", "left")
    entries = j.where(F.col("_usd").isNotNull() & (F.col("from_ccy") != "THB")).select(
        "date_rate", F.col("from_ccy").alias("k"), (F.col("_usd") / F.col("rate_to_thb")).alias("v"))
    thb = usd.select("date_rate", F.lit("THB").alias("k"), F.col("_usd").alias("v"))
    rates = entries.unionByName(thb).groupBy("date_rate").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "v")))).alias("rates"))
    days = fx.select("date_rate").distinct().join(rates, "date_rate", "left")
    doc = F.struct(
        F.coalesce(F.col("rates"), F.create_map().cast("map<string,double>")).alias("rates"),
        (F.unix_timestamp(F.col("date_rate").cast("timestamp")) + 43200).alias("time_last_update_unix"),
        F.when(F.dayofmonth("date_rate") % 2 == 1, F.lit("events-feed")).alias("provider"),
        F.lit("events-doc").alias("documentation"),
    )
    return days.select(F.to_json(doc).alias("payload"))


def parse_payloads(payloads: DataFrame, now: Column | None = None) -> DataFrame:
    """S4 + K2 + K6: parse JSON, upper-case the rate keys, resolve source and
    as-of date (unix seconds in UTC, else ``now``)."""
    p = payloads.select(F.from_json("payload", PAYLOAD_SCHEMA).alias("p")).select("p.*")
    now = now if now is not None else F.current_timestamp()
    return p.select(
        F.transform_keys(F.coalesce("rates", F.create_map().cast("map<string,double>")), lambda k, v: F.upper(k))
        .alias("rates"),
        F.coalesce(unix_to_date("time_last_update_unix"), F.to_date(now)).alias("date_rate"),
        F.coalesce(F.timestamp_seconds("time_last_update_unix"), now.cast("timestamp")).cast("timestamp_ntz")
        .alias("updated_at"),
        F.coalesce(F.nullif(F.col("provider"), F.lit("")), F.nullif(F.col("documentation"), F.lit("")),
                   F.lit(config.FX_DEFAULT_SOURCE)).alias("source_system"),
    )


def payload_valid(parsed: DataFrame) -> DataFrame:
    """Payload has rates containing a positive THB rate."""
    thb = F.element_at("rates", F.lit("THB"))
    return parsed.withColumn("is_valid", F.coalesce(thb > 0, F.lit(False)))


def explode_rates(parsed: DataFrame) -> DataFrame:
    """Valid payloads -> (date_rate, ccy, rate_per_usd, source_system)."""
    v = payload_valid(parsed).where("is_valid")
    return v.select("date_rate", "source_system", F.explode("rates").alias("ccy", "rate_per_usd")).select(
        "date_rate", "ccy", "rate_per_usd", "source_system")


def currency_list(symbols: str = config.FX_DEFAULT_SYMBOLS) -> Column:
    """K7: "THB,USD,..." -> trimmed upper-case array with THB ensured."""
    parts = F.filter(F.transform(F.split(F.lit(symbols), ","), lambda s: F.upper(F.trim(s))), lambda s: s != "")
    return F.array_union(parts, F.array(F.lit("THB")))


def cross_rates(parsed: DataFrame, symbols: str = config.FX_DEFAULT_SYMBOLS) -> DataFrame:
    """M6: THB per unit = THB-per-USD / ccy-per-USD; THB = 1.0; skip missing
    or non-positive rates. Rows carry the payload's source and timestamp."""
    v = payload_valid(parsed).where("is_valid")
    e = v.select("date_rate", "updated_at", "source_system", "rates",
                 F.explode(currency_list(symbols)).alias("from_ccy"))
    per_usd = F.element_at("rates", F.col("from_ccy"))
    thb = F.element_at("rates", F.lit("THB"))
    rate = F.when(F.col("from_ccy") == "THB", F.lit(1.0)).otherwise(thb / per_usd)
    ok = (F.col("from_ccy") == "THB") | (per_usd.isNotNull() & (per_usd > 0))
    return e.where(ok).select("date_rate", "from_ccy", F.lit("THB").alias("to_ccy"), rate.alias("rate_to_thb"),
                              "source_system", "updated_at")


def upsert(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Keyed upsert on (date_rate, from_ccy, to_ccy): an incoming row
    replaces the stored one (rate, source, updated_at). Partial aggregate per
    key, no whole-table sort."""
    cols = ["date_rate", "from_ccy", "to_ccy", "rate_to_thb", "source_system", "updated_at"]
    old = existing.select(*cols).withColumn("_new", F.lit(0))
    new = incoming.select(*cols).withColumn("_new", F.lit(1))
    merged = first_per_key(old.unionByName(new), ["date_rate", "from_ccy", "to_ccy"],
                           [desc("_new"), desc("updated_at")])
    return merged.drop("_new")


def staleness(fx: DataFrame, as_of: DataFrame, max_days: int = config.FX_STALE_MAX_DAYS) -> DataFrame:
    """D9 + A20 + K3: newest FX date, its age at the one-row ``as_of`` date
    (column ``as_of``) and PASS/FAIL (no FX data fails)."""
    from ..operators.distribution import attach_scalars

    g = attach_scalars(fx.agg(F.max("date_rate").alias("latest_date_rate")), as_of.select(F.col("as_of").cast("date")))
    g = g.withColumn("age_days", date_age_days("latest_date_rate", "as_of"))
    return g.withColumn("status", F.when(F.col("age_days") <= max_days, "PASS").otherwise("FAIL")).withColumn(
        "max_age_days", F.lit(max_days))


def typed_fx(df: DataFrame) -> DataFrame:
    """Typed FX sink contract: DECIMAL(20,8) rate, to_ccy default THB."""
    return df.select(
        F.col("date_rate").cast("date"),
        F.col("from_ccy").cast("string"),
        F.coalesce(F.col("to_ccy"), F.lit(config.BASE_CCY)).alias("to_ccy"),
        F.col("rate_to_thb").cast("decimal(20,8)").alias("rate_to_thb"),
        F.col("source_system").cast("string"),
        F.col("updated_at").cast("timestamp"),
    )
