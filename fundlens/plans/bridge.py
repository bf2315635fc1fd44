"""Feeder fund -> master fund bridge by ISIN."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.numeric import map_to_priority, to_float0
from ..functions.strings import extract_token, token_isin, upper_strip
from ..operators.snapshots import asc, desc, first_per_key
from .loaders import Dataset

BRIDGE_COLS = [
    "fund_code",
    "feeder_name",
    "feeder_weight_pct",
    "as_of_date",
    "token",
    "token_isin",
    "ft_ticker",
    "ticker",
    "name",
    "ticker_type",
    "map_method",
]


def feeder_with_tokens(thai_feeder: DataFrame) -> DataFrame:
    """C2 + C3 on feeder names."""
    return thai_feeder.withColumn("token", extract_token("feeder_name")).withColumn(
        "token_isin", token_isin("token")
    )


def static_isin_ready(ft_static: DataFrame) -> DataFrame:
    return ft_static.withColumn("isin_number", upper_strip(F.coalesce(F.col("isin_number"), F.lit(""))))


def bridge_feeder(feeder: DataFrame, static: DataFrame) -> DataFrame:
    """Every feeder row, left-joined to every master sharing its ISIN."""
    s = static.select("ft_ticker", "ticker", "isin_number", "name", "ticker_type")
    # feeders without an ISIN match nothing; keys that no ISIN equals spread them over the tasks
    spread = F.concat(F.lit("~"), F.xxhash64("fund_code", "feeder_name").cast("string"))
    keyed = feeder.withColumn("_key", F.coalesce("token_isin", spread))
    j = keyed.join(s, keyed["_key"] == s["isin_number"], "left")
    return j.withColumn("map_method", F.lit(config.MAP_FEEDER)).select(*BRIDGE_COLS)


def mapped_funds(bridge_f: DataFrame) -> DataFrame:
    """Distinct funds mapped through any feeder."""
    return bridge_f.where(F.col("ft_ticker").isNotNull()).select("fund_code").distinct()


def bridge_fallback(thai_isin: DataFrame, static: DataFrame, already_mapped: DataFrame) -> DataFrame:
    """J5 + J6 + A15 + P3: one master per unmapped fund through the fund's
    own ISIN (Fund before ETF before others, then the largest AUM)."""
    order = [asc("pref"), desc("aum"), asc("ft_ticker")]
    s = static.select(
        "isin_number", "ft_ticker", "ticker", "name", "ticker_type",
        to_float0("assets_aum_full_value").alias("aum"),
        map_to_priority("ticker_type", config.TICKER_TYPE_PREF, config.DEFAULT_PRIORITY).alias("pref"),
    )
    # one master per ISIN can be chosen before funds are joined, so the join does not fan out
    s = first_per_key(s, ["isin_number"], order)
    funds = thai_isin.select("fund_code", "isin_code").join(already_mapped, "fund_code", "left_anti")
    m = funds.join(s, funds["isin_code"] == s["isin_number"], "inner").select(
        "fund_code", "isin_code", "ft_ticker", "ticker", "name", "ticker_type", "aum", "pref"
    )
    best = first_per_key(m, ["fund_code"], order)
    return best.select(
        "fund_code",
        F.col("name").alias("feeder_name"),
        F.lit(100.0).alias("feeder_weight_pct"),
        F.lit(None).cast("date").alias("as_of_date"),
        F.lit(None).cast("string").alias("token"),
        F.col("isin_code").alias("token_isin"),
        "ft_ticker",
        "ticker",
        "name",
        "ticker_type",
        F.lit(config.MAP_FALLBACK).alias("map_method"),
    )


def build_bridge(ds: Dataset, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """U1 + M2 + A14: union, weights to numbers, one row per (fund, master)
    preferring the feeder mapping; unmapped feeders collapse to one row. The
    feeder rows are read twice; ``keep`` shares them."""
    feeder = feeder_with_tokens(ds.thai_feeder)
    static = static_isin_ready(ds.ft_static)
    bf = keep(bridge_feeder(feeder, static))
    fb = bridge_fallback(ds.thai_isin, static, mapped_funds(bf))
    u = bf.unionByName(fb).withColumn("feeder_weight_pct", to_float0("feeder_weight_pct"))
    u = u.withColumn("priority", map_to_priority("map_method", config.MAP_PRIORITY, config.DEFAULT_PRIORITY))
    best = first_per_key(u, ["fund_code", "ft_ticker"], [asc("priority")])
    return best.select(*BRIDGE_COLS)
