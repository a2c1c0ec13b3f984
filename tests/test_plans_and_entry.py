"""Plan-shape checks and the driver contract, on the driver's sf0.001 tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from folio import config as C
from folio.plans import oracle as O
from folio.plans import queries as Q
from folio.plans.inspect import count_nodes, forbidden_nodes, plan_text

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_returns_curated_rows(spark):
    df = E.entry(spark)
    assert df.columns == list(C.CURATED_COLUMNS)
    assert df.count() == 5855


def test_every_query_has_an_oracle():
    assert set(Q.QUERIES) == set(O.ORACLE_SQL)
    assert set(Q.QUERIES) <= set(E.queries()) and set(O.ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", ["curated_reviews", "curated_drop_null_keys", "curated_salted",
                                  "fill_defaults", "orphan_reviews", "audit_report"])
def test_no_nested_loop_cartesian_or_python(spark, name):
    assert forbidden_nodes(Q.QUERIES[name](spark, SF)) == []


def test_dedupe_limits_rows_before_the_shuffle(spark):
    text = plan_text(Q.dedupe_catalog(spark, SF))
    tree = text.split("\n\n", 1)[0]
    assert "WindowGroupLimit" in tree
    partial = text.index("Partial")
    assert "Exchange" in tree and partial > 0


def test_null_safe_join_without_broadcast_is_sort_merge(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = Q.curated_reviews(spark, SF)
        assert count_nodes(df, "SortMergeJoin") == 1
        assert forbidden_nodes(df) == []
        assert df.count() == 5855
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_catalog_columns_pruned_at_scan(spark):
    text = plan_text(Q.curated_reviews(spark, SF))
    part_schema = [ln for ln in text.splitlines() if "ReadSchema: struct<p_" in ln][0]
    assert "p_name" not in part_schema and "p_retailprice" not in part_schema


def test_null_profile_one_scan_per_table(spark):
    assert count_nodes(Q.null_profile(spark, SF), "Scan parquet") == 2


SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                   "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


def _norm(v):
    return (v is None, repr(v) if isinstance(v, float) else str(v))


def test_all_queries_match_oracle_at_smallest_scale(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sql = E.oracle_sql()
    bad = []
    for name, fn in Q.QUERIES.items():
        df = fn(spark, SF)
        cols = sorted(df.columns)
        idx = [df.columns.index(c) for c in cols]
        got = sorted(tuple(_norm(r[i]) for i in idx) for r in df.collect())
        rel = con.sql(sql[name])
        ocols, otypes = rel.columns, [str(t) for t in rel.types]
        oidx = [ocols.index(c) for c in cols] if sorted(ocols) == cols else None
        if oidx is None:
            bad.append((name, "columns", cols, sorted(ocols)))
            continue
        stypes = {f.name: SPARK_TO_DUCKDB.get(f.dataType.simpleString()) for f in df.schema}
        if any(stypes[c] != t for c, t in zip(ocols, otypes)):
            bad.append((name, "types", stypes, dict(zip(ocols, otypes))))
        want = sorted(tuple(_norm(r[i]) for i in oidx) for r in rel.fetchall())
        if got != want:
            bad.append((name, len(got), len(want)))
    assert bad == []


def test_hot_null_key_is_split_by_aqe_skew_join(spark):
    """A third of the reviews with a NULL title: the sort-merge join splits that partition."""
    from pyspark.sql import functions as F

    from folio.operators.curate import curate
    from folio.sources import adapters as A
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.shuffle.partitions": "32"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        sf = "/root/testdata/sf0.01"
        books = A.catalog(spark, sf)
        # many input splits, as a large table has; a third of titles NULL
        rv = (A.reviews(spark, sf).repartition(8)
              .withColumn("title", F.when(F.col("id") % 3 != 0, F.col("title"))))
        df = curate(books, rv, catalog_order=["seq"])
        rows = df.count()
        df.collect()
        assert "SortMergeJoin(skew=true)" in plan_text(df, "simple")
        assert rows == curate(books, rv, catalog_order=["seq"], null_keys="drop").count() + \
            rv.filter(F.col("title").isNull()).count()
    finally:
        for k in conf:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_split_nulls_reuses_title_partitioning(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = Q.curated_split_nulls(spark, SF)
        tree = plan_text(df).split("\n\n", 1)[0]
        # keyed branch: sort-merge join fed by the dedupe's title partitioning;
        # NULL branch: broadcast of the single NULL-title catalog row
        assert "SortMergeJoin" in tree and "BroadcastHashJoin" in tree
        assert tree.count("Exchange") == 4   # reviews, catalog, NULL-title catalog, broadcast
        assert df.count() == 5855
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    from folio.operators.curate import curate
    from folio.sinks.writers import write_table
    from folio.sources import adapters as A
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS folio_bk LOCATION '{tmp_path}'")
        write_table(A.catalog(spark, SF), table="folio_bk.books", bucket_by=(8, ["title"]))
        write_table(A.reviews(spark, SF), table="folio_bk.ratings", bucket_by=(8, ["title"]))
        b, r = spark.table("folio_bk.books"), spark.table("folio_bk.ratings")
        df = curate(b, r, catalog_order=["seq"], split_nulls=True)
        tree = plan_text(df).split("\n\n", 1)[0]
        keyed = tree.split("BroadcastHashJoin", 1)[0]
        assert "SortMergeJoin" in keyed and "Exchange" not in keyed
        assert df.count() == 5855
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE IF EXISTS folio_bk CASCADE")
