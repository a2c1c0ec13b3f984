"""The Z-order layout: rows stay the same, and lookups by each column skip row groups."""

from __future__ import annotations

import bisect
import glob
import math

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from folio.sinks.layout import _bucketed, _common_prefix, z_ordered
from folio.sinks.writers import write_table

COLUMNS = ["title", "user_id", "review_score"]


@pytest.fixture(scope="module")
def rows(spark):
    h = lambda n: F.pmod(F.xxhash64("id", F.lit(n)), F.lit(10 ** 9))
    return spark.range(60_000).select(
        "id", F.when(h(1) % 10 < 3, F.lit("book hot")).when(h(1) % 50 != 49, F.format_string("book %05d", h(2) % 3000)).alias("title"),
        F.format_string("u%06d", h(3) % 5000).alias("user_id"),
        F.when(h(4) % 20 != 0, (h(5) % 400 / 80)).alias("review_score")).repartition(4).cache()


def admitted(path, name, value):
    """Row groups whose minimum and maximum leave room for a value; and all of them."""
    hit = total = 0
    for file in glob.glob(f"{path}/part-*"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.to_arrow_schema().get_field_index(name)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            hit += stats is None or not stats.has_min_max or stats.min <= value <= stats.max
    return hit, total


def test_lookups_by_each_column_skip_row_groups(spark, rows, tmp_path):
    plain, laid = f"{tmp_path}/plain", f"{tmp_path}/z"
    write_table(rows, path=plain, cluster_by=["title"], row_group_bytes=1 << 16)
    assert write_table(rows, path=laid, z_order_by=COLUMNS, bloom_distinct=1000, row_group_bytes=1 << 16) == rows.count()
    assert spark.read.parquet(laid).exceptAll(rows).count() == 0
    for name, value in (("title", "book 01234"), ("user_id", "u002500"), ("review_score", 2.0)):
        hit, total = admitted(laid, name, value)
        assert total >= 16 and hit <= 0.6 * total, (name, hit, total)
        if name != "title":
            assert hit / total < 0.7 * admitted(plain, name, value)[0] / admitted(plain, name, value)[1]
    file = pq.ParquetFile(glob.glob(f"{laid}/part-*")[0])
    assert file.metadata.num_row_groups >= 1


def test_a_hot_value_is_split_by_the_other_columns(spark, rows):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = z_ordered(rows, COLUMNS).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r.n for r in parts]
    assert max(sizes) < 0.35 * sum(sizes)


def test_nulls_ties_empty_tables_and_odd_columns(spark, tmp_path):
    odd = spark.createDataFrame([(None, None, 1), ("a", 1.0, 2), ("a", 1.0, 2), ("é", float("nan"), 3)], "`a.b` string, x double, __y int")
    assert z_ordered(odd, ["a.b", "x"]).exceptAll(odd).count() == 0
    assert z_ordered(odd.limit(0), ["a.b", "x"]).count() == 0
    assert z_ordered(odd.where("x IS NULL"), ["a.b"]).count() == 1
    for bad in ([], ["x"] * 11):
        with pytest.raises(ValueError):
            z_ordered(odd, bad)
    with pytest.raises(ValueError):
        write_table(odd, path=f"{tmp_path}/t", z_order_by=["x"], cluster_by=["x"])
    assert _common_prefix(b"abc", b"abd") == 2 and _common_prefix(b"", b"x") == 0


def test_buckets_are_found_by_halving_in_small_steps(spark, rows):
    plan = z_ordered(rows, COLUMNS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("if (") < 40
    cuts = [[1.0, 2.0, 2.0, 5.5, float("inf")], [], [float(i) for i in range(63)]]
    values = [None, float("nan"), float("-inf"), float("inf"), -1.0, 0.0, 1.0, 1.5, 2.0, 5.5, 61.5, 62.0, 70.0]
    frame = spark.createDataFrame([(v, v, v) for v in values], "__n0 double, __n1 double, __n2 double")
    for r in _bucketed(frame, cuts, 6).collect():
        for i, own in enumerate(([1.0, 2.0, 5.5], [], cuts[2])):
            n = 0 if r[0] is None else len(own) if math.isnan(r[0]) else bisect.bisect_right(own, r[0])
            assert r[f"__b{i}"] == n << (6 - len(own).bit_length()), (r, i)
