"""One ordered JSON document from many writers.

A document is an object of sections; a section is one record or an ordered list
of records. Every record is a line, lines are range-partitioned by (section,
position), and each task writes its part of a section as a file of its own, so
a long list takes many writers and no list is ever in one row. The files of
``parts/section_no=…`` in the order of the manifest, one after another, are the
document. The manifest has one row per file (lines, bytes).

Positions count from 1 and are unique in a section. A section without records
becomes an empty list; a single record is expected to be there.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINES = "section_no int, position long, line string"
_LAST = 2**63 - 1


def _frame(spark: SparkSession, names: list[str], lists: set[str]) -> DataFrame:
    """The lines around the records: a few for each section."""
    rows = [(0, -1, "{"), (len(names) - 1, _LAST, "}")]
    for i, name in enumerate(names):
        rows.append((i, 0, ("," if i else "") + f'"{name}":' + ("[" if name in lists else "")))
        if name in lists:
            rows.append((i, _LAST - 1, "]"))
    return spark.createDataFrame(rows, LINES)


def write_document(sections: Mapping[str, DataFrame], position: Mapping[str, str], path: str) -> None:
    """Write the sections in their order. ``position`` names the column that
    orders a list; sections that are not in it hold one record."""
    path, names = path.rstrip("/"), list(sections)
    spark = sections[names[0]].sparkSession
    lines = [_frame(spark, names, set(position))]
    for i, (name, df) in enumerate(sections.items()):
        at = F.col(position[name]).cast("long") if name in position else F.lit(1).cast("long")
        record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
        lines.append(df.select(
            F.lit(i).alias("section_no"), at.alias("position"),
            F.when(at == 1, record).otherwise(F.concat(F.lit(","), record)).alias("line")))
    all_lines = reduce(DataFrame.unionByName, lines).repartitionByRange("section_no", "position")
    all_lines.sortWithinPartitions("section_no", "position").select("section_no", "line").write.partitionBy(
        "section_no").text(f"{path}/parts")
    parts = spark.read.schema("line string, section_no int").text(f"{path}/parts")
    files = parts.groupBy("section_no", F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length("line") + 1).alias("bytes"))
    # names count tasks with at least five digits, so longer names come later
    files.orderBy("section_no", F.length("file"), "file").coalesce(1).write.json(f"{path}/manifest")  # a row per file


def read_sections(spark: SparkSession, path: str, schemas: Mapping[str, T.StructType]) -> dict[str, DataFrame]:
    """The records as they were written, section by section; ``schemas`` are
    in the order of the document."""
    parts = spark.read.schema("line string, section_no int").text(f"{path.rstrip('/')}/parts")
    records = parts.where(F.col("line").rlike('^,?\\{"'))
    out = {}
    for i, (name, schema) in enumerate(schemas.items()):
        record = F.from_json(F.ltrim(F.col("line"), F.lit(",")), schema)
        out[name] = records.where(F.col("section_no") == i).select(record.alias("r")).select("r.*")
    return out
