"""Source readers (S1-S3): projected scans, schema drift, optional tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_projected(spark: SparkSession, path: str, columns: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Read a table with only the needed columns (pruned at the scan)."""
    return spark.read.format(fmt).load(path).select(*columns)


def jdbc_options(
    url: str,
    query: str,
    properties: Mapping[str, str] | None = None,
    split: tuple[str, object, object, int] | None = None,
) -> dict[str, str]:
    """Reader options of ``scan_jdbc``."""
    opts = {"url": url, **(properties or {})}
    if split is None:
        return opts | {"query": query}
    column, low, high, partitions = split
    # a partitioned read takes a table expression, not ``query``
    return opts | {
        "dbtable": f"({query}) fundlens_scan", "partitionColumn": column, "lowerBound": str(low),
        "upperBound": str(high), "numPartitions": str(partitions),
    }


def scan_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str] | None = None,
    split: tuple[str, object, object, int] | None = None,
) -> DataFrame:
    """S1 over JDBC: the database runs ``query``; Spark reads the result.
    ``split`` = (numeric or date column, lower bound, upper bound, partitions)
    reads it over several connections; the bounds only place the cuts, rows
    outside them are read too. Without it one task reads the whole result."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query, properties, split)).load()


def resolve_columns(
    df: DataFrame,
    spec: Mapping[str, Sequence[str]],
    types: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """For every canonical name take the first present candidate column
    (case-blind); when none is present use a typed null. Other columns are
    dropped."""
    by_lower = {c.lower(): c for c in df.columns}
    out = []
    for canonical, candidates in spec.items():
        found = next((by_lower[c.lower()] for c in candidates if c.lower() in by_lower), None)
        if found is not None:
            out.append(F.col(found).alias(canonical))
        else:
            dtype = (types or {}).get(canonical, T.StringType())
            out.append(F.lit(None).cast(dtype).alias(canonical))
    return df.select(*out)


def table_or_empty(
    spark: SparkSession, source: Mapping[str, DataFrame] | None, name: str, schema: T.StructType
) -> DataFrame:
    """S3: the source table if it exists, else an empty frame of ``schema``."""
    if source is not None:
        try:
            if name in source:
                return source[name]
        except TypeError:
            pass
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


FX_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("date_rate", T.DateType(), False),
        T.StructField("from_ccy", T.StringType(), False),
        T.StructField("to_ccy", T.StringType(), False),
        T.StructField("rate_to_thb", T.DoubleType(), False),
        T.StructField("source_system", T.StringType(), True),
        T.StructField("updated_at", T.TimestampType(), True),
    ]
)
