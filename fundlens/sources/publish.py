"""S6 as an atomic publish: many tables become visible together.

Each table of a build is written into the folder of a new version, and while it
is written ``DataFrame.observe`` counts its rows and adds up a digest over all
columns. When every table is there, one row per table goes into the manifest as
a single file. Readers resolve the newest version of the manifest, so they see
the old build whole until the new one is whole, and a build that fails leaves
only a folder that nothing names. Old versions stay until they are dropped.

The digest is the sum of 60 bits of MD5 over a row's columns (sorted by name,
with a fixed text for each type), so it does not depend on the order of rows;
``registry/contracts.py`` has the same in SQL. Fractions enter in units of 1e-6,
numbers of 2^62 and more in units of 2^42.

Writers of one root must take turns: two that publish at once get the same
version number, and readers then see the one whose id sorts last, whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version long, build string, table_name string, path string, row_count long, digest string"
UNITS = 1_000_000.0


def column_text(name: str, dtype: str) -> Column:
    """A value as text, the same in every engine; null is its own text."""
    c = F.col(f"`{name}`")
    if dtype in ("double", "float") or dtype.startswith("decimal"):
        x = c.cast("double")
        part = x % F.lit(1.0)
        whole = F.concat((x - part).try_cast("long").cast("string"), F.lit(":"), F.floor(part * UNITS + 0.5).cast("string"))
        large = F.concat(F.lit("B"), F.floor(x / F.lit(2.0**42)).cast("string"))
        c = F.when(F.abs(x) < 2.0**62, whole).when(F.abs(x) < 2.0**104, large).when(x.isNotNull(), "big")
    elif dtype == "date":
        c = F.date_format(c, "yyyy-MM-dd")
    elif dtype.startswith("timestamp"):
        c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))


def row_digest(df: DataFrame) -> Column:
    """60 bits of a row's MD5 as a decimal."""
    text = F.concat_ws("\x1f", *(column_text(c, t) for c, t in sorted(df.dtypes)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("decimal(20,0)")


def digest_columns(df: DataFrame) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(row_digest(df)).cast("string"), F.lit("0")).alias("digest"),
    ]


def digests(tables: Mapping[str, DataFrame], label: str = "table_name") -> DataFrame:
    """One row per table: its rows and the digest over all its columns."""
    out = None
    for name, df in tables.items():
        row = df.agg(*digest_columns(df)).select(F.lit(name).alias(label), "row_count", "digest")
        out = row if out is None else out.unionByName(row)
    return out


def _manifest(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        found = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
        found.take(1)  # the folder is listed here
        return found
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def manifest(spark: SparkSession, root: str, version: int | None = None) -> list:
    """The manifest rows (one per table) of the newest or a given version."""
    rows = _manifest(spark, root.rstrip("/"))
    if rows is None:
        return []
    if version is None:
        version = rows.agg(F.max("version")).first()[0]
    mine = rows.where(F.col("version") == F.lit(version)).collect()
    last = max((r["build"] for r in mine), default=None)
    return sorted((r for r in mine if r["build"] == last), key=lambda r: r["table_name"])


def publish(tables: Mapping[str, DataFrame], root: str) -> int:
    """Write all tables and make them visible at once; returns the version."""
    root = root.rstrip("/")
    spark = next(iter(tables.values())).sparkSession
    newest = manifest(spark, root)
    version, build = (newest[0]["version"] if newest else 0) + 1, uuid.uuid4().hex
    rows = []
    for name, df in tables.items():
        path, seen = f"{root}/v{version:06d}-{build}/{name}", Observation(name)
        df.observe(seen, *digest_columns(df)).write.option("compression", "zstd").parquet(path)
        rows.append((version, build, name, path, seen.get["row_count"], seen.get["digest"]))
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return version


def published(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of the newest or a given version, by name."""
    return {r["table_name"]: spark.read.parquet(r["path"]) for r in manifest(spark, root, version)}


def damaged(spark: SparkSession, root: str, version: int | None = None) -> list[str]:
    """Names of published tables whose files no longer give their digest."""
    want = {r["table_name"]: (r["row_count"], r["digest"]) for r in manifest(spark, root, version)}
    if not want:
        return []
    got = {r["table_name"]: (r["row_count"], r["digest"]) for r in digests(published(spark, root, version)).collect()}
    return sorted(t for t in want if got[t] != want[t])
