"""Connected components by alternating stars, on tables only.

Every round rewrites the edges so that all of a node's larger neighbours
(large star), then all its smaller ones (small star), point to the smallest
node known; the number of rounds grows with the logarithm of the longest
path.  Rounds end when all edges are stars: no node has two smaller neighbours,
or a smaller and a larger one.  Edges are written to shared storage after each
round, which cuts the lineage; the driver sees one number a round.  The joins carry plain
exchanges on both sides, so a hub's rows are split at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.session import scratch_path

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(low, "u").where("v <> m")
            .select(F.col("m").alias("a"), F.col("v").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(low, "b")
    return (moved.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
            .union(low.select(F.col("m").alias("a"), "b")).distinct())


def _settled(edges: DataFrame) -> bool:
    """Whether the edges (a < b, each once) are stars around their smallest nodes."""
    ends = edges.select(F.col("a").alias("node"), F.lit(0).alias("under")).union(edges.select("b", F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("under").alias("under"), F.count("*").alias("n"))
    return nodes.where("under > 1 OR (under = 1 AND n > 1)").count() == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is named by its smallest node."""
    spark = edges.sparkSession
    path = scratch_path(spark, "components")
    (edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
     .write.parquet(f"{path}/0"))
    now = spark.read.parquet(f"{path}/0")
    for turn in range(1, MAX_ROUNDS):
        if _settled(now):
            break
        _small_star(_large_star(now)).write.parquet(f"{path}/{turn}")
        now = spark.read.parquet(f"{path}/{turn}")
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
