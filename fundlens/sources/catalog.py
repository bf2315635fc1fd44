"""What a set of tables holds, column by column, and their first rows.

``profile`` makes one pass over each table: a single aggregate of all columns
gives rows, nulls, smallest and largest value and a HyperLogLog++ estimate of
the different values, and is then turned into one row per column. ``samples``
takes the first rows in key order (a top-n in each partition, then a merge).
Values are shown in the type-neutral text of ``publish.column_text``. Columns of
complex type have no smallest and largest value; maps have no estimate either.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .publish import column_text

_COMPLEX = (T.ArrayType, T.MapType, T.StructType)


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _has_map(t.elementType)
    if isinstance(t, T.StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return isinstance(t, T.MapType)


def profile(tables: Mapping[str, DataFrame], rsd: float = 0.02) -> DataFrame:
    """One row per table and column; an empty table has a row per column too."""
    return reduce(DataFrame.unionByName, [_profile(name, df, rsd) for name, df in tables.items()])


def _profile(table: str, df: DataFrame, rsd: float) -> DataFrame:
    aggs, cols = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(df.schema.fields):
        c, dtype, plain = F.col(f"`{f.name}`"), f.dataType.simpleString(), not isinstance(f.dataType, _COMPLEX)
        estimate = F.lit(None).cast("long") if _has_map(f.dataType) else F.approx_count_distinct(c, rsd)
        aggs += [F.count(c).alias(f"n{i}"), estimate.alias(f"d{i}")]
        if plain:
            aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
        none = F.lit(None).cast("string")
        cols.append(F.struct(
            F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"), F.lit(dtype).alias("data_type"),
            F.lit(f.nullable).alias("nullable"), F.col("rows").alias("row_count"),
            (F.col("rows") - F.col(f"n{i}")).alias("null_count"),
            F.try_divide(F.col("rows") - F.col(f"n{i}"), F.col("rows")).alias("null_share"),
            F.col(f"d{i}").alias("distinct_estimate"),
            (column_text(f"lo{i}", dtype) if plain else none).alias("smallest"),
            (column_text(f"hi{i}", dtype) if plain else none).alias("largest"),
        ))
    return df.agg(*aggs).select(F.lit(table).alias("table_name"), F.inline(F.array(*cols)))


def samples(tables: Mapping[str, DataFrame], keys: Mapping[str, list[str]], n: int = 3) -> DataFrame:
    """(table_name, position, row_text): the first ``n`` rows of each table
    by its key columns, which should be unique."""
    parts = []
    for name, df in tables.items():
        order = [F.col(f"`{k}`").asc_nulls_last() for k in keys[name]]
        text = F.concat_ws("|", *(column_text(c, t) for c, t in df.dtypes))
        first = df.orderBy(*order).limit(n)  # n rows: the window below is bounded
        parts.append(first.select(
            F.lit(name).alias("table_name"), F.row_number().over(Window.orderBy(*order)).alias("position"), text.alias("row_text")))
    return reduce(DataFrame.unionByName, parts)
