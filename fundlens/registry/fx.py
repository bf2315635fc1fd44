"""FX refresh keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..oracle import stages  # noqa: F401
from ..oracle.ctes import define
from ..plans import fx_refresh as fr
from .common import mart
from .core import alias

SYMBOLS = ("THB", "USD", "EUR", "JPY", "GBP", "CHF", "AUD", "CAD", "CNY", "HKD", "SGD")

define("o_payload_days", """
SELECT d.date_rate, u.usd,
       coalesce(u.usd > 0, false) AS is_valid,
       CASE WHEN dayofmonth(d.date_rate) % 2 = 1 THEN 'events-feed' ELSE 'events-doc' END AS source_system,
       CAST(CAST(d.date_rate AS TIMESTAMP) + INTERVAL 12 HOUR AS TIMESTAMP) AS updated_at
FROM (SELECT DISTINCT date_rate FROM daily_fx_rates) d
LEFT JOIN (SELECT date_rate, rate_to_thb AS usd FROM daily_fx_rates WHERE from_ccy = 'USD') u ON d.date_rate = u.date_rate""")

define("o_payload_rows", """
SELECT p.date_rate, f.from_ccy AS ccy, p.usd / f.rate_to_thb AS rate_per_usd, p.source_system
FROM o_payload_days p JOIN daily_fx_rates f ON p.date_rate = f.date_rate
WHERE p.is_valid AND f.from_ccy <> 'THB'
UNION ALL
SELECT date_rate, 'THB', usd, source_system FROM o_payload_days WHERE is_valid""")

SYM_SQL = " UNION ALL ".join(f"SELECT '{s}' AS from_ccy" for s in SYMBOLS)
define("o_cross_rates", f"""
SELECT p.date_rate, s.from_ccy, 'THB' AS to_ccy,
       CASE WHEN s.from_ccy = 'THB' THEN 1.0::DOUBLE ELSE p.usd / r.rate_per_usd END AS rate_to_thb,
       p.source_system, p.updated_at
FROM o_payload_days p CROSS JOIN ({SYM_SQL}) s
LEFT JOIN o_payload_rows r ON r.date_rate = p.date_rate AND r.ccy = s.from_ccy
WHERE p.is_valid AND (s.from_ccy = 'THB' OR (r.rate_per_usd IS NOT NULL AND r.rate_per_usd > 0))""")

define("o_fx_upserted", """
SELECT date_rate, from_ccy, to_ccy, rate_to_thb, source_system, updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY date_rate, from_ccy, to_ccy
                               ORDER BY _new DESC, updated_at DESC NULLS LAST, rate_to_thb NULLS FIRST,
                                        source_system NULLS FIRST) AS rn
  FROM (SELECT date_rate, from_ccy, to_ccy, rate_to_thb, source_system, CAST(updated_at AS TIMESTAMP) AS updated_at,
               0 AS _new FROM daily_fx_rates
        UNION ALL
        SELECT date_rate, from_ccy, to_ccy, rate_to_thb, source_system, updated_at, 1 FROM o_cross_rates))
WHERE rn = 1""")


def _staleness_sql(src: str) -> str:
    return f"""
SELECT latest_date_rate, as_of, age_days, CASE WHEN age_days <= 3 THEN 'PASS' ELSE 'FAIL' END AS status,
       3 AS max_age_days
FROM (SELECT l.latest_date_rate, a.as_of, date_diff('day', l.latest_date_rate, a.as_of) AS age_days
      FROM (SELECT max(date_rate) AS latest_date_rate FROM {src}) l,
           (SELECT max(nav_date) AS as_of FROM funds_daily) a)"""


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    fx = mart(spark, sf).src["daily_fx_rates"]
    return fr.parse_payloads(fr.payloads_from_rates(fx))


def _as_of(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).src["funds_daily"].agg(F.max("nav_date").alias("as_of"))


@alias(["fx_payload_explode", "json_map_access", "unix_to_date"], "SELECT * FROM o_payload_rows")
def q_payload_rows(spark: SparkSession, sf: str) -> DataFrame:
    return fr.explode_rates(_parsed(spark, sf))


@alias(["dq_payload_valid"], "SELECT date_rate, is_valid FROM o_payload_days")
def q_payload_valid(spark: SparkSession, sf: str) -> DataFrame:
    return fr.payload_valid(_parsed(spark, sf)).select("date_rate", "is_valid")


@alias(["fx_cross_rate", "currency_list_parse"], "SELECT * FROM o_cross_rates")
def q_cross(spark: SparkSession, sf: str) -> DataFrame:
    return fr.cross_rates(_parsed(spark, sf))


def _upserted(spark: SparkSession, sf: str) -> DataFrame:
    fx = mart(spark, sf).src["daily_fx_rates"]
    return fr.upsert(fx, fr.cross_rates(_parsed(spark, sf)))


@alias(["fx_upsert"], "SELECT * FROM o_fx_upserted")
def q_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf)


@alias(["fx_refresh"], _staleness_sql("o_fx_upserted"))
def q_refresh(spark: SparkSession, sf: str) -> DataFrame:
    return fr.staleness(_upserted(spark, sf), _as_of(spark, sf))


@alias(["dq_fx_staleness", "date_age_days"], _staleness_sql("daily_fx_rates"))
def q_staleness(spark: SparkSession, sf: str) -> DataFrame:
    return fr.staleness(mart(spark, sf).src["daily_fx_rates"], _as_of(spark, sf))


@alias(["agg_max_date"], "SELECT max(date_rate) AS latest_date_rate FROM daily_fx_rates")
def q_max_date(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf).src["daily_fx_rates"].agg(F.max("date_rate").alias("latest_date_rate"))


@alias(["typed_sink_schema"], """
SELECT date_rate, from_ccy, coalesce(to_ccy, 'THB') AS to_ccy, CAST(rate_to_thb AS DECIMAL(20,8)) AS rate_to_thb,
       source_system, updated_at FROM o_fx_upserted""")
def q_typed(spark: SparkSession, sf: str) -> DataFrame:
    return fr.typed_fx(_upserted(spark, sf)).withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


@alias(["fx_alias_view"], "SELECT date_rate, from_ccy, to_ccy, rate_to_thb, source_system, updated_at FROM daily_fx_rates")
def q_alias_view(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources.sinks import fx_alias_view

    fx_alias_view(mart(spark, sf).src["daily_fx_rates"])
    return spark.table("dim_fx_rates")
