"""Incremental FX ingestion with Structured Streaming.

New provider payload files (one JSON document per line) land in a folder; a
file-source stream picks them up and every micro-batch is upserted into the
FX table (parquet, partitioned by date_rate):

    payload files -> readStream.text -> foreachBatch(parse -> cross rates ->
    keyed upsert of the touched dates -> dynamic partition overwrite)

The batch writer is idempotent (re-running an epoch rewrites the same
partitions) and the merged batch is checkpointed to the shared checkpoint
folder before it overwrites the partitions it read, so a lost executor never
leaves a half-read source behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..plans.fx_refresh import cross_rates, parse_payloads, upsert
from ..session import ensure_checkpoint_dir
from ..sources.readers import FX_TABLE_SCHEMA
from ..sources.sinks import write_fx_partitions


def _existing(spark: SparkSession, table_path: str) -> DataFrame:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(table_path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        return spark.read.parquet(table_path)
    return spark.createDataFrame([], FX_TABLE_SCHEMA)


def upsert_batch(batch: DataFrame, table_path: str, symbols: str = config.FX_DEFAULT_SYMBOLS) -> None:
    spark = batch.sparkSession
    ensure_checkpoint_dir(spark)
    incoming = cross_rates(parse_payloads(batch), symbols)
    touched = incoming.select("date_rate").distinct()
    existing = _existing(spark, table_path)
    current = existing.join(touched, "date_rate", "left_semi")
    merged = upsert(current, incoming).select(*[f.name for f in FX_TABLE_SCHEMA.fields])
    merged = merged.withColumn("updated_at", F.col("updated_at").cast("timestamp")).checkpoint(eager=True)
    write_fx_partitions(merged, table_path)


def start_fx_payload_stream(
    spark: SparkSession,
    payload_dir: str,
    table_path: str,
    checkpoint_location: str,
    symbols: str = config.FX_DEFAULT_SYMBOLS,
    available_now: bool = True,
):
    """Start the stream; returns the StreamingQuery."""
    stream = spark.readStream.format("text").load(payload_dir).withColumnRenamed("value", "payload")
    writer = (
        stream.writeStream.foreachBatch(lambda df, _epoch: upsert_batch(df, table_path, symbols))
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
