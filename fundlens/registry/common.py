"""Shared helpers for registry modules.

Adapter views and mart plans are immutable lazy DataFrames, so one instance
per (session, data folder) is shared by all queries: the parquet footers are
read and the plans analysed once.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..plans.mart import Mart
from ..sources.testdata import TestData

_TD: dict[tuple, TestData] = {}
_MART: dict[tuple, Mart] = {}


def _key(spark: SparkSession, sf_dir: str, extra: tuple = ()) -> tuple:
    return (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"), extra)


MATERIALIZE_SOURCES = True


def test_data(spark: SparkSession, sf_dir: str, missing: tuple[str, ...] = ()) -> TestData:
    k = _key(spark, sf_dir, missing)
    if k not in _TD:
        _TD[k] = TestData(spark, sf_dir, missing, materialize=MATERIALIZE_SOURCES)
    return _TD[k]


def mart(spark: SparkSession, sf_dir: str, **kw) -> Mart:
    k = _key(spark, sf_dir, tuple(sorted(kw.items())))
    if k not in _MART:
        _MART[k] = Mart(spark, test_data(spark, sf_dir), **kw)
    return _MART[k]


def reset_marts() -> None:
    """Forget cached mart plans (their persisted frames are re-created on the
    next use); materialised source tables stay."""
    _MART.clear()
