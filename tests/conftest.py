from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from folio.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]")
         .appName("folio-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s


@pytest.fixture
def catalog(spark):
    """FIXTURES edge catalog: seq is the row order."""
    rows = [(0, "X", "c1"), (1, "X", "c2"), (2, None, "cn1"), (3, None, "cn2"), (4, "Z", None)]
    df = spark.createDataFrame(rows, "seq long, title string, categories string")
    return (df.withColumn("authors", df.title.substr(1, 1))
              .withColumn("publisher", df.categories))


@pytest.fixture
def reviews(spark):
    rows = [("a", "X", 5.0, 0), ("b", "Y", None, 86400), ("c", None, 3.0, -1),
            ("d", "X", 1.0, 172800), ("e", None, 2.0, 259200), ("f", "Z", None, None)]
    df = spark.createDataFrame(rows, "id string, title string, review_score double, review_time long")
    return (df.withColumn("user_id", df.id)
              .withColumn("review_summary", df.id)
              .withColumn("review_text", df.id))


@pytest.fixture
def tmp_out(tmp_path):
    return str(tmp_path)
