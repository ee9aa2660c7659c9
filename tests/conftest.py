import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkrank.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("sparkrank-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "checkpoints"))
    )
    session = configure(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    """Tables of the smallest scale."""
    return "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    rows = [("d1", "a b a"), ("d2", "b c"), ("d3", "a"), ("d4", "D d"), ("d5", "")]
    return spark.createDataFrame(rows, "doc_id string, text string").repartition(3)


@pytest.fixture
def questions(spark):
    rows = [("q1", "a b"), ("q2", "a a"), ("q3", "d"), ("q4", "zzz")]
    return spark.createDataFrame(rows, "query_id string, text string")


def ranked_lists(df):
    """{query: [(doc, score), ...]} in rank order, checking that ranks run from 1."""
    out = {}
    for row in df.orderBy("query_id", "rank").collect():
        items = out.setdefault(row["query_id"], [])
        items.append((row["doc_id"], row["score"]))
        assert row["rank"] == len(items)
    return out
