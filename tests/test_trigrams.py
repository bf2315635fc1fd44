"""The trigram index finds what a scan finds."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F

from fundlens.operators import trigrams

VALUES = ["Ring Energy", "SPRING", "rin-ing", "ring", "ri", "", None, "String Theory", "aaaa", "aaa", "Äpfel RING", "n g", "ring"]


@pytest.fixture(scope="module")
def index(spark):
    path = tempfile.mkdtemp(prefix="fundlens-trigrams-") + "/v"
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "k int, v string")
    trigrams.write_index(rows, "v", path, buckets=8)
    return rows, path


@pytest.mark.parametrize("query", ["ring", "RING", "ri", "", "rin-ing", "aaa", "aaaa", "aaaaa", "äpf", "ring e", "none", "g"])
def test_rows_equal_the_scan(spark, index, query):
    rows, path = index
    got = sorted(r.k for r in trigrams.search(rows, query, {"v": path}, buckets=8).collect())
    assert got == [i for i, v in enumerate(VALUES) if query.lower() in (v or "").lower()]


def test_two_columns_give_a_row_once(spark, index):
    rows, path = index
    both = rows.withColumn("w", F.col("v"))
    got = sorted(r.k for r in trigrams.search(both, "ring", {"v": path, "w": path}, buckets=8).collect())
    assert got == [i for i, v in enumerate(VALUES) if "ring" in (v or "").lower()]


def test_only_buckets_of_the_query_are_read(spark, index):
    _, path = index
    plan = trigrams.find(spark, path, "ring", buckets=8)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#", plan)
