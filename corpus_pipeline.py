"""A corpus pipeline of the llm operators.

Stages, in order: toxicity (toxic documents go), language ID (documents
without a known language go), exact dedup (of equal texts the largest doc_id
stays), n-gram Jaccard join (one document of each near-duplicate class
stays) and packing into sequences of 2048 ids. Every stage takes the documents
that its predecessor kept, as written Parquet, and all but the last return the
columns of documents; labels are read from ``sf_dir`` and join by doc_id.

Defined cases. Nulls, empty and long texts, ties, repeated rows and extra
columns: as each operator defines them; a row is kept or dropped as a whole.
Documents with an empty text have no language and go in stage 2. Empty tables
pass through and give no sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fundlens.llm import exact_dedup, language_id, ngram_join, packing, toxicity
from fundlens.llm._shared import ROW, numbered, shared_path, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.known_language(docs)


def _keep(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows of ``docs`` (numbered) that ``decided`` keeps."""
    return docs.join(decided.where("kept").select(ROW), ROW, "left_semi").drop(ROW)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = numbered(docs)
    return _keep(docs, exact_dedup.grouped(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = numbered(docs)
    return _keep(docs, ngram_join.ngram_links(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pieces(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language", known_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# LSH, trained models and a tokenizer are beyond SQL: see tests/llm/test_pipeline.py
ORACLE_SQL = None
