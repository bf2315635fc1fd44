"""Latest-row and latest-snapshot selection.

All of them are aggregates, not windows: ``min(struct(order..., row...))``
per key is a partial (map-side) aggregate, so a key that holds a third of
all rows is reduced inside every map task before the shuffle instead of
landing whole in one reducer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class By:
    """One ordering term: column, direction, null placement."""

    col: str | Column
    desc: bool = False
    nulls_last: bool = True


def asc(c: str | Column, nulls_last: bool = True) -> By:
    return By(c, False, nulls_last)


def desc(c: str | Column, nulls_last: bool = True) -> By:
    return By(c, True, nulls_last)


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sort_key(types: dict[str, T.DataType], term: By, i: int) -> list[Column]:
    """Encode one term as ascending struct fields: (null flag, value)."""
    c = _as_col(term.col)
    flag = c.isNull() if term.nulls_last else c.isNotNull()
    if not term.desc:
        return [flag.alias(f"n{i}"), c.alias(f"v{i}")]
    if not isinstance(term.col, str):
        raise TypeError("descending terms must name a column")
    dtype = types[term.col]
    if isinstance(dtype, T.BooleanType):
        v = ~c
    elif isinstance(dtype, T.DateType):
        v = -F.unix_date(c)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        v = -F.unix_micros(c.cast("timestamp"))
    elif isinstance(dtype, T.NumericType):
        v = -c
    else:
        raise TypeError(f"descending order on {dtype} is not supported by first_per_key")
    return [flag.alias(f"n{i}"), v.alias(f"v{i}")]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[By]) -> DataFrame:
    """First row per key under ``order`` (pandas sort + drop_duplicates /
    SQL ROW_NUMBER() = 1). Null keys form one group. Remaining ties are
    broken by the other columns ascending (nulls first), so the result is
    deterministic.

    Planned as ``row_number() = 1``, which Spark turns into a partial
    WindowGroupLimit before the shuffle: every map task keeps one row per
    key, so a key holding a third of all rows is reduced map-side (like a
    partial aggregate) and the final window sorts at most one row per map
    task and key."""
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    sort = []
    for term in order:
        c = _as_col(term.col)
        if term.desc:
            sort.append(c.desc_nulls_last() if term.nulls_last else c.desc_nulls_first())
        else:
            sort.append(c.asc_nulls_last() if term.nulls_last else c.asc_nulls_first())
    sort.extend(F.col(c).asc_nulls_first() for c in payload)
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*sort)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _dated(df: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    cond = F.col(date_col).isNotNull()
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond)


def newest_dates(df: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """(keys, maximum date) of every key: a partial aggregate."""
    keys = list(keys)
    return _dated(df, keys, date_col).groupBy(*keys).agg(F.max(date_col).alias(date_col))


def at_newest(df: DataFrame, keys: Sequence[str], date_col: str, dates: DataFrame) -> DataFrame:
    """Rows of ``df`` at the date that ``dates`` (``newest_dates``) gives for their
    key. A filter on the result sinks below the join; if ``dates`` is a small
    written frame it is broadcast, and ``df`` is neither sorted nor shuffled. As a
    predicate (key, date) IN dates it sinks through the expressions and joins that
    ``df`` is derived by, to the one table that key and date come from; a left-semi
    join would stay above them."""
    cols = [*keys, date_col]
    return _dated(df, list(keys), date_col).where(F.struct(*cols).isin(dates.select(*cols)))


def latest_snapshot(df: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """Rows dated at their key's maximum date. Null keys and null dates
    drop (SQL join semantics). The max is a partial aggregate; the rows come
    back through a left-semi join, which AQE splits when a key is skewed. The
    frame is read twice and a filter on the result sinks below the join."""
    return at_newest(df, keys, date_col, newest_dates(df, keys, date_col))


def newest_rows(df: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """The rows of ``latest_snapshot`` in one pass, for keys with many rows: as
    ``rank() = 1`` every map task keeps only the rows at the newest date that it
    saw for a key (WindowGroupLimit), so old snapshots are never shuffled."""
    keys = list(keys)
    cond = F.col(date_col).isNotNull()
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    w = Window.partitionBy(*keys).orderBy(F.col(date_col).desc())
    return df.where(cond).withColumn("_rank", F.rank().over(w)).where(F.col("_rank") == 1).drop("_rank")


def newest_rows_near(
    df: DataFrame, keys: Sequence[str], date_col: str, near: DataFrame, keep: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The rows of ``latest_snapshot``, looked for near the dates that ``near`` (keys,
    date) gives first: the newest dates of a table that is filled together with ``df``.
    Where a key has rows at that date or later, its newest rows are among them; the
    other keys are read whole. ``near`` decides how much is read, not what is found. Both
    conditions are predicates, so they sink below the joins that ``df`` is derived by
    (see ``at_newest``), and those join few rows. ``keep`` writes what is found."""
    keys = list(keys)
    # names of their own: a name that ``near`` has too would mean its column
    row = df.columns
    dated = _dated(df, keys, date_col).withColumns({f"_row_{c}": F.col(c) for c in [*keys, date_col]})

    def same(c: str) -> Column:
        return F.col(c) == F.col(f"_row_{c}").outer()

    def held(dates: DataFrame, *conds: Column) -> Column:
        for cond in [same(k) for k in keys] + list(conds):
            dates = dates.where(cond)
        return dates.exists()

    recent = dated.where(held(near, F.col(date_col) <= F.col(f"_row_{date_col}").outer())).select(*row)
    recent = keep(recent)
    dates = keep(newest_dates(recent, keys, date_col))
    rest = dated.where(~held(dates)).select(*row)
    return at_newest(recent, keys, date_col, dates).unionByName(newest_rows(rest, keys, date_col))


def latest_snapshot_filtered(df: DataFrame, keys: Sequence[str], date_col: str, row_filter: Column) -> DataFrame:
    """The latest date is fixed over all rows of the key, then the filter
    applies; a key whose newest snapshot has no matching row yields nothing."""
    return latest_snapshot(df, keys, date_col).where(row_filter)


def latest_per_group_value(df: DataFrame, key: str, date_col: str, value_cols: Sequence[str]) -> DataFrame:
    """Newest (date, values) per key as one aggregate row."""
    packed = F.struct(F.col(date_col).alias("d"), *[F.col(c) for c in value_cols])
    g = df.where(F.col(date_col).isNotNull()).groupBy(key).agg(F.max(packed).alias("_m"))
    return g.select(F.col(key), F.col("_m.d").alias(date_col), *[F.col("_m." + c).alias(c) for c in value_cols])
