from __future__ import annotations

import os

import pytest

from folio import config as C
from folio.sinks.writers import EmptyOutputError, write_csv, write_table
from folio.sources.csv import read_csv_table
from folio.sources.tables import hash_sample, read_table, top_n
from folio.streaming.ingest import stream_csv_to_table


def test_zero_column_overwrite_refused(spark, tmp_out):
    with pytest.raises(EmptyOutputError):
        write_table(spark.range(3).select(), path=f"{tmp_out}/t")
    with pytest.raises(EmptyOutputError):
        write_csv(spark.range(3).select(), f"{tmp_out}/c")


def test_write_counts_without_second_scan(spark, tmp_out):
    df = spark.range(1000).withColumnRenamed("id", "title")
    assert write_table(df, path=f"{tmp_out}/t") == 1000
    assert write_table(df, path=f"{tmp_out}/t", mode="append") == 1000
    assert spark.read.parquet(f"{tmp_out}/t").count() == 2000
    assert write_table(df, path=f"{tmp_out}/t", mode="overwrite") == 1000
    assert spark.read.parquet(f"{tmp_out}/t").count() == 1000


def test_cluster_by_sorts_each_file(spark, tmp_out):
    df = spark.range(200).selectExpr("CAST(199 - id AS STRING) AS title").repartition(2)
    write_table(df, path=f"{tmp_out}/t", cluster_by=["title"], count_rows=False)
    for name in sorted(os.listdir(f"{tmp_out}/t")):
        if name.endswith(".parquet"):
            vals = [r.title for r in spark.read.parquet(f"{tmp_out}/t/{name}").collect()]
            assert vals == sorted(vals)


def test_bucketed_table_requires_catalog(spark, tmp_out):
    with pytest.raises(ValueError):
        write_table(spark.range(3), path=f"{tmp_out}/b", bucket_by=(4, ["id"]))


def test_curated_csv_roundtrip(spark, catalog, reviews, tmp_out):
    from folio.operators.curate import curate
    cur = curate(catalog, reviews, catalog_order=["seq"])
    write_csv(cur, f"{tmp_out}/csv")
    back = read_csv_table(spark, f"{tmp_out}/csv", C.CURATED_SCHEMA).frame
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(back.collect(), key=key) == sorted(cur.collect(), key=key)


def test_read_table_missing_skip(spark, tmp_out):
    df = read_table(spark, path=f"{tmp_out}/nothing", schema=C.CATALOG_SCHEMA, on_missing="skip")
    assert df.count() == 0
    with pytest.raises(Exception):
        read_table(spark, path=f"{tmp_out}/nothing")


def test_top_n_is_deterministic(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS k").repartition(5)
    got = [r.id for r in top_n(df, 5, ["k", "id"]).collect()]
    assert sorted(got) == [0, 7, 14, 21, 28]


def test_hash_sample_partitions_rows(spark):
    df = spark.range(1000)
    parts = [hash_sample(df, ["id"], 4, b).count() for b in range(4)]
    assert sum(parts) == 1000 and all(p > 0 for p in parts)
    assert hash_sample(df, ["id"], 4, 1).collect() == hash_sample(df, ["id"], 4, 1).collect()


HEADER = ["Id", "Title", "review/score", "review/time"]


def _landing_file(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
        fh.write(",".join(HEADER) + "\n")
        for r in rows:
            fh.write(",".join(r) + "\n")


def test_stream_ingest_is_incremental_and_exactly_once(spark, tmp_out):
    landing, out, ckpt = f"{tmp_out}/landing", f"{tmp_out}/table", f"{tmp_out}/ckpt"
    _landing_file(landing, "a.csv", [("1", "T1", "5", "0"), ("2", "NA", "x", "86400")])
    _landing_file(landing, "b.csv", [("3", '"multi\nline"', "4", "")])
    done = stream_csv_to_table(spark, landing, out, ckpt, C.REVIEW_SCHEMA, header=HEADER, files_per_trigger=1)
    assert (done.batches, done.rows) == (2, 3)
    first = {r.id: r for r in spark.read.parquet(out).collect()}
    assert set(first) == {"1", "2", "3"}
    assert first["2"].title is None and first["2"].review_score is None
    assert first["3"].title == "multi\nline" and first["3"].review_time is None
    # a rerun over the same folder adds only the new file
    _landing_file(landing, "c.csv", [("4", "T4", "3", "1")])
    done = stream_csv_to_table(spark, landing, out, ckpt, C.REVIEW_SCHEMA)   # header from the files
    assert (done.batches, done.rows) == (1, 1)
    # more batches than the query's recent progress keeps
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for i in range(5):
            _landing_file(landing, f"d{i}.csv", [(str(10 + i), "T", "1", "1")])
        done = stream_csv_to_table(spark, landing, out, ckpt, C.REVIEW_SCHEMA, header=HEADER, files_per_trigger=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert (done.batches, done.rows) == (5, 5)
    with pytest.raises(Exception):
        _landing_file(landing, "wide.csv", [("9", "T", "1", "1", "extra")])
        stream_csv_to_table(spark, landing, out, ckpt, C.REVIEW_SCHEMA, header=HEADER)
    os.remove(os.path.join(landing, "wide.csv"))
    ids = sorted(r.id for r in spark.read.parquet(out).collect())
    assert ids == sorted(["1", "2", "3", "4", *(str(10 + i) for i in range(5))])


def test_large_top_n_is_exact_and_stays_parallel(spark):
    from folio.plans.inspect import plan_text
    n = 12000
    df = spark.range(40000).selectExpr("id", "(id * 7919) % 1000 AS k").repartition(9)
    before = dict(spark.conf.getAll)
    got = top_n(df, n, ["k", "id"])
    assert "TakeOrderedAndProject" not in plan_text(got)
    assert got.rdd.getNumPartitions() > 1
    assert dict(spark.conf.getAll) == before
    expected = sorted(((r.k, r.id) for r in df.collect()))[:n]
    assert sorted((r.k, r.id) for r in got.collect()) == expected


@pytest.mark.parametrize("n, kind", [(0, "int"), (3, "double"), (4, "string"), (5, "date"), (6, "timestamp_ntz"), (99, "int")])
def test_top_n_of_other_types_and_sizes(spark, n, kind):
    values = {"int": ["3", "1", None, "2", "2", "1", "7"], "string": ["b", "", None, "é", "a", "a", "z"],
              "double": ["1.5", "NaN", None, "-inf", "-0.0", "0.0", "2"],
              "date": ["2024-01-02", "1969-05-05", None, "2024-01-01", "2024-01-01", "2025-01-01", "2024-01-02"],
              "timestamp_ntz": ["2024-01-02 03:04:05", "1969-05-05 00:00:01", None, "2024-01-01 00:00:00",
                                "2024-01-01 00:00:00", "2025-01-01 00:00:00", "2024-01-02 03:04:05.000001"]}[kind]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "t string, i int").selectExpr(
        f"CAST(t AS {kind}) AS v", "i").repartition(3)
    want = [r.i for r in df.orderBy("v", "i").limit(n).collect()]
    assert sorted(r.i for r in top_n(df, n, ["v", "i"]).collect()) == sorted(want)


def test_top_n_of_full_ties(spark):
    df = spark.createDataFrame([(1, "a")] * 6 + [(0, "b")], "k int, t string")
    assert sorted(r.k for r in top_n(df, 4, ["k"]).collect()) == [0, 1, 1, 1]


def test_max_records_per_file(spark, tmp_out):
    df = spark.range(100).coalesce(1).withColumnRenamed("id", "title")
    assert write_table(df, path=f"{tmp_out}/m", max_records_per_file=30) == 100
    assert len([f for f in os.listdir(f"{tmp_out}/m") if f.endswith(".parquet")]) == 4
    write_csv(df, f"{tmp_out}/mc", max_records_per_file=50)
    assert len([f for f in os.listdir(f"{tmp_out}/mc") if f.endswith(".csv")]) == 2


def test_etl_job_file_options(spark, catalog, reviews, tmp_out):
    from folio.plans.jobs import etl_job
    rows = etl_job(spark, catalog, reviews, table_path=f"{tmp_out}/e", catalog_order=["seq"],
                   cluster_by=["title"], compression="zstd", max_records_per_file=2)
    files = [f for f in os.listdir(f"{tmp_out}/e") if f.endswith(".parquet")]
    assert rows == 5 and len(files) >= 3 and all(".zstd." in f for f in files)
    assert spark.read.parquet(f"{tmp_out}/e").count() == 5


def test_write_jdbc_refuses_empty_frame(spark):
    from folio.sinks.writers import write_jdbc
    with pytest.raises(EmptyOutputError):
        write_jdbc(spark.range(1).select(), "jdbc:none", "t", properties={})


def test_stream_ingest_long_running(spark, tmp_out):
    landing, out, ckpt = f"{tmp_out}/land2", f"{tmp_out}/tab2", f"{tmp_out}/ck2"
    _landing_file(landing, "a.csv", [("1", "T1", "5", "0")])
    q = stream_csv_to_table(spark, landing, out, ckpt, C.REVIEW_SCHEMA, header=HEADER,
                            trigger_interval="1 second")
    try:
        q.processAllAvailable()
        _landing_file(landing, "b.csv", [("2", "T2", "4", "1")])
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["1", "2"]


def test_partitioned_write_and_table_read(spark, tmp_out, reviews):
    from folio.sinks.writers import ensure_database
    n = write_table(reviews, path=f"{tmp_out}/p", partition_by=["review_summary"])
    assert n == 6
    assert {d.split("=")[0] for d in os.listdir(f"{tmp_out}/p") if "=" in d} == {"review_summary"}
    back = spark.read.parquet(f"{tmp_out}/p")
    assert back.filter("review_summary = 'a'").count() == 1       # partition pruning path
    ensure_database(spark, "folio_rt", f"{tmp_out}/wh")
    try:
        write_table(reviews, table="folio_rt.reviews")
        assert read_table(spark, table="folio_rt.reviews").count() == 6
        with pytest.raises(ValueError):
            read_table(spark, table="folio_rt.reviews", path=f"{tmp_out}/p")
    finally:
        spark.sql("DROP DATABASE IF EXISTS folio_rt CASCADE")


def test_scratch_needs_a_shared_folder_off_local_mode():
    from types import SimpleNamespace

    from folio.session import checkpoint_root, is_local

    def session(master):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, default=None: default))

    for master in ("yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]"):
        assert not is_local(master)
        with pytest.raises(RuntimeError):
            checkpoint_root(session(master))
    assert is_local("local") and is_local("local[8]") and is_local("local[4,4]")


def test_scratch_is_cleaned(spark):
    from folio.session import clean_scratch, scratch_path
    path = scratch_path(spark, "cleaned")
    spark.range(3).write.parquet(path)
    from folio.sources.tables import table_exists
    assert table_exists(spark, path=path) and clean_scratch(spark) >= 1
    assert not table_exists(spark, path=path)
