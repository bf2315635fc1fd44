"""Numeric Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import col_

# Money and weight sums do not depend on the order in which partial aggregates
# merge: the whole part of each value (x - x % 1, exact for doubles) and its
# fraction in units of 1e-12 are summed as DECIMAL(38,0) and added at the end.
# No value is clipped; every run (and every engine) gets the same bits.
FRACTION_SCALE = 1_000_000_000_000.0
SUM_SCALE = 1_000_000.0


def to_float(c: Column | str) -> Column:
    """M1: coerce to double, unparsable -> null."""
    return col_(c).try_cast("double")


def null_to_zero(c: Column | str) -> Column:
    """M2: missing -> 0.0."""
    return F.coalesce(col_(c).cast("double"), F.lit(0.0))


def to_float0(c: Column | str) -> Column:
    """M1 + M2."""
    return F.coalesce(to_float(c), F.lit(0.0))


def clip_upper(c: Column | str, hi: float) -> Column:
    """M3 upper clip that keeps null."""
    x = col_(c)
    return F.when(x.isNotNull(), F.least(x, F.lit(hi)))


def clip_range(c: Column | str, lo: float, hi: float) -> Column:
    """M3 [lo, hi] clip that keeps null (least/greatest alone skip nulls)."""
    x = col_(c)
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """M4: num / den with den = 0 -> null (ANSI-safe)."""
    return F.try_divide(col_(num), F.nullif(col_(den), F.lit(0)))


def pct_product(a: Column | str, b: Column | str) -> Column:
    """M5: a * b / 100."""
    return (col_(a) * col_(b)) / 100.0


def exact_sum(c: Column | str) -> Column:
    """Order-independent sum of doubles (decimal accumulator), as double."""
    x = col_(c).cast("double")
    whole = (x - x % F.lit(1.0)).try_cast("decimal(38,0)")
    units = F.floor((x % F.lit(1.0)) * FRACTION_SCALE + 0.5).try_cast("decimal(38,0)")
    return F.sum(whole).cast("double") + F.sum(units).cast("double") / FRACTION_SCALE


def share_pct(value: Column | str, total: Column | str) -> Column:
    """Value / total * 100, 0 when the total is 0."""
    return F.when(col_(total) != 0, col_(value) / col_(total) * 100.0).otherwise(F.lit(0.0))


def map_to_priority(c: Column | str, mapping: dict[str, int], default: int = 9) -> Column:
    """Category -> integer preference with a default."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col_(c) == k, F.lit(v)) if expr is None else expr.when(col_(c) == k, F.lit(v)))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def abs_diff(a: Column | str, b: Column | str) -> Column:
    """M8."""
    return F.abs(col_(a) - col_(b))
