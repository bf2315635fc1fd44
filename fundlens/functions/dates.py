"""Date Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import col_


def to_date_lenient(c: Column | str) -> Column:
    """K1: parse to date, bad -> null."""
    return col_(c).try_cast("date")


def unix_to_date(c: Column | str) -> Column:
    """K2: unix seconds -> UTC date (session time zone is UTC)."""
    return F.to_date(F.timestamp_seconds(col_(c)))


def date_age_days(latest: Column | str, as_of: Column | str) -> Column:
    """K3: as_of - latest in days."""
    return F.datediff(col_(as_of), col_(latest))


def iso_format(c: Column | str, with_time: bool = False) -> Column:
    """K4: date / timestamp -> ISO text."""
    return F.date_format(col_(c), "yyyy-MM-dd'T'HH:mm:ss" if with_time else "yyyy-MM-dd")
