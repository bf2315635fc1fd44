"""A trigram posting table for substring search.

The different values of a searched column are few against the rows that carry
them. Each value, in lower case, is posted under every three characters that it
holds; postings are files partitioned by a bucket of the trigram, so a search
reads only the buckets of its own trigrams. Values posted under all of them are
then tested with ``contains``, as trigrams may lie apart from each other. A query
of under three characters reads the values instead.

Defined cases. A null value matches like an empty one: only the empty query
finds it, which finds every value. Values of under three characters are found by
short queries only, as they cannot hold a longer one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3


def grams(text: Column) -> Column:
    """The different trigrams of a text; none if it is shorter."""
    at = F.when(F.length(text) >= GRAM, F.sequence(F.lit(1), F.length(text) - GRAM + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.substring(text, i, GRAM)))


def _bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")


def write_index(values: DataFrame, column: str, path: str, buckets: int = 64) -> None:
    """Write the different values of ``column`` and their postings. Rows of a
    bucket are rebalanced, so a frequent trigram becomes several files."""
    path = path.rstrip("/")
    different = values.select(F.coalesce(F.col(column), F.lit("")).alias("value")).distinct()
    different.withColumn("low", F.lower("value")).write.parquet(f"{path}/values")
    saved = values.sparkSession.read.parquet(f"{path}/values")
    posted = saved.select("value", "low", F.explode(grams(F.col("low"))).alias("gram")).withColumn(
        "bucket", _bucket(F.col("gram"), buckets)
    )
    posted.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(f"{path}/postings")


def find(spark: SparkSession, path: str, query: str, buckets: int = 64) -> DataFrame:
    """(value): every value that holds ``query``, case-blind."""
    path = path.rstrip("/")
    low = F.lower(F.lit(query))
    text, wanted, where = spark.range(1).select(  # constants of the query
        low, grams(low), F.array_distinct(F.transform(grams(low), lambda g: _bucket(g, buckets)))
    ).first()
    if not wanted:
        return spark.read.schema("value string, low string").parquet(f"{path}/values").where(
            F.contains("low", F.lit(text))).select("value")
    posted = spark.read.schema("value string, low string, gram string, bucket int").parquet(f"{path}/postings")
    return (
        posted.where(F.col("bucket").isin(where) & F.col("gram").isin(wanted))
        .groupBy("value", "low").agg(F.count(F.lit(1)).alias("n"))
        .where((F.col("n") == len(wanted)) & F.contains("low", F.lit(text))).select("value")
    )


def search(rows: DataFrame, query: str, indexes: dict[str, str], buckets: int = 64) -> DataFrame:
    """Rows whose value in any of the columns holds ``query``; ``indexes`` names
    the index of each column."""
    out, hit = rows, F.lit(False)
    for i, (column, path) in enumerate(indexes.items()):
        found = find(rows.sparkSession, path, query, buckets).select(F.col("value").alias(f"__v{i}"))
        out = out.join(found, F.coalesce(F.col(column), F.lit("")) == F.col(f"__v{i}"), "left")
        hit = hit | F.col(f"__v{i}").isNotNull()
    return out.where(hit).select(*rows.columns)
