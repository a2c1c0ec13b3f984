"""Catalog and review views derived from the driver's TPC-H-style tables.

The test data has no book tables, so ``part`` plays the catalog and
``lineitem`` the reviews.  Deterministic rules give the views the traits
the pipeline has to handle: NULL and duplicated titles, NULL categories,
NULL and out-of-range scores, NULL times and orphan titles.  Every column
is computed from the source row, so the views grow with the tables.

The same rules are written as SQL in ``sql_views`` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Derivation parameters (shared with the SQL text below).
CATALOG_NULL_EVERY = 37     # p_partkey % 37 = 0 -> NULL title
CATALOG_TITLES = 600        # titles T0..T599, so keys repeat
REVIEW_NULL_EVERY = 41      # l_partkey % 41 = 0 -> NULL title
REVIEW_TITLES = 700         # T600..T699 never appear in the catalog
NULL_SCORE_DISCOUNT = 0.095
NULL_TIME_TAX = 0.075

# Total order over review rows (l_orderkey, l_linenumber alone repeat).
REVIEW_ORDER = ("id", "line_no", "part_key", "user_id", "price")


def _title(key: F.Column, null_every: int, modulus: int) -> F.Column:
    return F.when(key % null_every != 0, F.concat(F.lit("T"), (key % modulus).cast("string")))


def catalog_view(part: DataFrame) -> DataFrame:
    """seq, title, description, authors, categories, publisher, ratings_count."""
    return part.select(
        F.col("p_partkey").alias("seq"),
        _title(F.col("p_partkey"), CATALOG_NULL_EVERY, CATALOG_TITLES).alias("title"),
        F.col("p_name").alias("description"),
        F.col("p_brand").alias("authors"),
        F.when(F.col("p_type") != "ECONOMY", F.col("p_type")).alias("categories"),
        F.concat(F.lit("Pub"), F.col("p_size").cast("string")).alias("publisher"),
        F.col("p_size").cast("double").alias("ratings_count"),
    )


def review_view(lineitem: DataFrame, with_part_key: bool = False) -> DataFrame:
    """id, line_no, title, price, user_id, review_score, review_time, review_summary, review_text."""
    epoch_seconds = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"),
                                     F.col("l_shipdate"))
    cols = [
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line_no"),
        _title(F.col("l_partkey"), REVIEW_NULL_EVERY, REVIEW_TITLES).alias("title"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_suppkey").cast("string").alias("user_id"),
        F.when(F.col("l_discount") < NULL_SCORE_DISCOUNT,
               (F.col("l_linenumber") - 1).cast("double")).alias("review_score"),
        F.when(F.col("l_tax") < NULL_TIME_TAX, epoch_seconds).alias("review_time"),
        F.col("l_returnflag").alias("review_summary"),
        F.col("l_linestatus").alias("review_text"),
    ]
    if with_part_key:
        cols.append(F.col("l_partkey").alias("part_key"))
    return lineitem.select(*cols)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_view(load(spark, sf_dir, "part"))


def reviews(spark: SparkSession, sf_dir: str, with_part_key: bool = False) -> DataFrame:
    return review_view(load(spark, sf_dir, "lineitem"), with_part_key)


def sql_views(string_type: str = "VARCHAR",
              epoch_expr: str = "CAST(epoch(l_shipdate) AS BIGINT)") -> str:
    """The views as SQL common table expressions (DuckDB dialect by default).

    ``books_v`` and ``ratings_v`` mirror ``catalog`` and ``reviews``;
    ``ratings_k`` adds ``part_key`` like ``reviews(with_part_key=True)``.
    """
    s = string_type
    review_cols = f"""l_orderkey AS id, l_linenumber AS line_no,
         CASE WHEN l_partkey % {REVIEW_NULL_EVERY} = 0 THEN NULL
              ELSE concat('T', CAST(l_partkey % {REVIEW_TITLES} AS {s})) END AS title,
         l_extendedprice AS price, CAST(l_suppkey AS {s}) AS user_id,
         CASE WHEN l_discount >= {NULL_SCORE_DISCOUNT} THEN NULL
              ELSE CAST(l_linenumber - 1 AS DOUBLE) END AS review_score,
         CASE WHEN l_tax >= {NULL_TIME_TAX} THEN NULL ELSE {epoch_expr} END AS review_time,
         l_returnflag AS review_summary, l_linestatus AS review_text"""
    return f"""books_v AS (
  SELECT p_partkey AS seq,
         CASE WHEN p_partkey % {CATALOG_NULL_EVERY} = 0 THEN NULL
              ELSE concat('T', CAST(p_partkey % {CATALOG_TITLES} AS {s})) END AS title,
         p_name AS description, p_brand AS authors,
         CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE p_type END AS categories,
         concat('Pub', CAST(p_size AS {s})) AS publisher,
         CAST(p_size AS DOUBLE) AS ratings_count
  FROM part),
ratings_v AS (
  SELECT {review_cols}
  FROM lineitem),
ratings_k AS (
  SELECT {review_cols},
         l_partkey AS part_key
  FROM lineitem)"""


# Reference-style CSV headers for the review export (one spelling per column).
RAW_REVIEW_HEADERS = {
    "id": "Id", "title": "Title", "price": "Price", "user_id": "User_id",
    "review_score": "review/score", "review_time": "review/time",
    "review_summary": "review/summary", "review_text": "review/text",
}
# Reference-style headers for the catalog, with an unmapped extra column.
RAW_CATALOG_HEADERS = {
    "seq": "seq", "title": "Title", "description": "description", "authors": "Authors",
    "categories": "Categories", "publisher": "publisher", "ratings_count": "ratingsCount",
}
# Suffix that exercises CSV quoting: comma, doubled quote, newline, backslash.
TRICKY_SUFFIX = ' "q", y\n\\'
# Near-misses of NA tokens that must stay text (case and whitespace differ).
NEAR_MISSES = ("none", "Null", " NA")


def tricky_text(col: F.Column) -> F.Column:
    """A leading space, the value, then ``TRICKY_SUFFIX``."""
    return F.concat(F.lit(" "), col, F.lit(TRICKY_SUFFIX))


def raw_review_export(ratings: DataFrame) -> DataFrame:
    """Reviews as a raw CSV would carry them: source headers, awkward text."""
    return ratings.select(*[
        (tricky_text(F.col(c)) if c == "review_text" else F.col(c)).alias(h)
        for c, h in RAW_REVIEW_HEADERS.items()
    ])
