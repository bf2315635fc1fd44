"""Sinks (S5-S8): mart writes, FX upsert write, views."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_tables(tables: dict[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, str]:
    """Full refresh; each named frame replaces its table folder."""
    paths = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").format(fmt).save(path)
        paths[name] = path
    return paths


def write_fx_partitions(df: DataFrame, path: str) -> None:
    """S5 sink on plain parquet: dynamic overwrite of the touched
    date_rate partitions only. ``df`` must not be lazily read from ``path``
    (checkpoint it first)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date_rate")
     .parquet(path))


def fx_alias_view(fx: DataFrame, name: str = "dim_fx_rates") -> None:
    """Compatibility view over the FX table."""
    fx.select("date_rate", "from_ccy", "to_ccy", "rate_to_thb", "source_system", "updated_at").createOrReplaceTempView(name)
