from __future__ import annotations

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import types as T

from folio import config as C
from folio.operators.shaping import (DuplicateHeaderError, normalize_na, project_existing_report,
                                     rename_columns, typed_cast)
from folio.plans.jobs import ingest_job
from folio.sources.csv import read_csv_table

# Headers out of order, one unknown header, every quoting case.
RAW_REVIEWS = (
    'review/text,Id,review/score,Title,bogus,review/time,Price\n'
    '"x ""q"", y",0001,5,T1,zz,1234567890.0,10.5\n'
    '"line one\nline two",B02,notnum,T2,zz,86400,\n'
    'back\\slash,0003,,"",zz,NA, 7\n'
    ' leading,0004,4.5,None,zz,-1,notnum\n'
)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_csv_fidelity_and_typing(spark, tmp_out):
    path = _write(f"{tmp_out}/reviews.csv", RAW_REVIEWS)
    obs = Observation("rejects")
    proj = read_csv_table(spark, path, C.REVIEW_SCHEMA, observation=obs)
    assert proj.missing == ["user_id", "profile_name", "helpfulness", "review_summary"]
    assert proj.dropped == ["bogus"]
    rows = {r.id: r for r in proj.frame.collect()}
    assert set(rows) == {"0001", "B02", "0003", "0004"}
    assert rows["0001"].review_text == 'x "q", y'
    assert rows["0001"].review_time == 1234567890
    assert rows["0001"].review_score == 5.0 and rows["0001"].price == 10.5
    assert rows["B02"].review_text == "line one\nline two"
    assert rows["B02"].review_score is None and rows["B02"].price is None
    assert rows["0003"].review_text == "back\\slash"
    assert rows["0003"].title is None            # empty quoted field
    assert rows["0003"].review_time is None      # NA token
    assert rows["0003"].price == 7.0             # numeric text is trimmed before parsing
    assert rows["0004"].review_text == " leading"
    assert rows["0004"].title is None            # "None" is an NA token
    assert rows["0004"].review_time == -1
    rejects = obs.get
    assert rejects["rejected_review_score"] == 1
    assert rejects["rejected_price"] == 1
    assert proj.frame.schema == T.StructType(
        [f for f in C.REVIEW_SCHEMA.fields if f.name not in proj.missing])


def test_case_duplicate_headers_raise(spark, tmp_out):
    path = _write(f"{tmp_out}/dup.csv", "Title,title\na,b\n")
    with pytest.raises(DuplicateHeaderError):
        read_csv_table(spark, path, C.CATALOG_SCHEMA)


def test_two_spellings_mapping_to_one_name_raise(spark):
    df = spark.createDataFrame([("a", "b")], "`review/text` string, Review_text string")
    with pytest.raises(DuplicateHeaderError):
        rename_columns(df)


def test_unmapped_headers_unchanged(spark):
    df = spark.createDataFrame([("a", "b", "c")], "Title string, extra string, `review/helpfulness` string")
    assert rename_columns(df).columns == ["title", "extra", "helpfulness"]


def test_na_tokens_exact(spark):
    values = list(C.NA_TOKENS) + ["none", "Null", " NA", "ok"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    out = [r.v for r in normalize_na(df).collect()]
    assert out == [None] * len(C.NA_TOKENS) + ["none", "Null", " NA", "ok"]
    assert len(C.NA_TOKENS) == 19
    kept = [r.v for r in normalize_na(df, tokens=()).collect()]
    assert kept == values


def test_typed_cast_integral_text(spark):
    df = spark.createDataFrame([("1234567890.0",), ("12",), ("1.5",), ("x",), (None,)], "review_time string")
    out = [r.review_time for r in typed_cast(df, C.REVIEW_SCHEMA).collect()]
    assert out == [1234567890, 12, None, None, None]


def test_project_existing_report(spark):
    df = spark.createDataFrame([(1, 2, 3)], "title int, zzz int, price int")
    proj = project_existing_report(df, ["id", "title", "price"])
    assert proj.frame.columns == ["title", "price"]
    assert proj.missing == ["id"] and proj.dropped == ["zzz"]


def test_missing_input(spark, tmp_out):
    proj = read_csv_table(spark, f"{tmp_out}/nope.csv", C.CATALOG_SCHEMA, on_missing="skip")
    assert proj.frame.count() == 0 and proj.frame.schema == C.CATALOG_SCHEMA
    with pytest.raises(Exception):
        read_csv_table(spark, f"{tmp_out}/nope.csv", C.CATALOG_SCHEMA)


def test_ingest_job_truncate_and_append(spark, tmp_out):
    path = _write(f"{tmp_out}/in/reviews.csv", RAW_REVIEWS)
    src = {"books_rating": (path, C.REVIEW_SCHEMA)}
    res = ingest_job(spark, src, f"{tmp_out}/out")
    assert res.counts == {"books_rating": 4} and res.total == 4
    assert res.dropped_headers["books_rating"] == ["bogus"]
    assert res.rejected_values["books_rating"]["rejected_price"] == 1
    res = ingest_job(spark, src, f"{tmp_out}/out", truncate_first=False)
    assert res.counts == {"books_rating": 8}
    res = ingest_job(spark, src, f"{tmp_out}/out", truncate_first=True)
    assert res.counts == {"books_rating": 4}


def test_ingest_job_skips_missing_file(spark, tmp_out):
    res = ingest_job(spark, {"books_data": (f"{tmp_out}/none.csv", C.CATALOG_SCHEMA)},
                     f"{tmp_out}/out2", on_missing="skip")
    assert res.counts == {"books_data": 0}


RAW_BOOKS = (
    'Title,description,authors,image,previewLink,publisher,publishedDate,infoLink,categories,ratingsCount\n'
    'T1,d,"A, B",i,p,P,2001,l,Fiction,3\n'
    'T2,d,NULL,i,p,P,2001,l,,\n'
)


def test_ingest_and_audit_fail_fast(spark, tmp_out):
    from folio.plans.jobs import VolumeGateError, ingest_and_audit
    books = _write(f"{tmp_out}/raw/books_data.csv", RAW_BOOKS)
    revs = _write(f"{tmp_out}/raw/Books_rating.csv", RAW_REVIEWS)
    with pytest.raises(VolumeGateError):
        ingest_and_audit(spark, books, revs, f"{tmp_out}/db")
    loaded, audited = ingest_and_audit(spark, books, revs, f"{tmp_out}/db",
                                       report_dir=f"{tmp_out}/reports", raise_on_fail=False,
                                       thresholds={C.CATALOG_LABEL: 2, C.REVIEWS_LABEL: 4})
    assert loaded.counts == {"books_data": 2, "books_rating": 4}
    assert audited.passed is True
    (folder,) = os.listdir(f"{tmp_out}/reports")
    assert folder.startswith(C.REPORT_PREFIX) and len(folder) == len(C.REPORT_PREFIX) + 15
    back = spark.read.parquet(f"{tmp_out}/db/books_data").collect()
    assert {r.title: (r.authors, r.categories, r.ratings_count) for r in back} == {
        "T1": ("A, B", "Fiction", 3.0), "T2": (None, None, None)}


def test_ensure_database(spark, tmp_out):
    from folio.sinks.writers import ensure_database, write_table
    ensure_database(spark, "folio_db_test", f"{tmp_out}/wh")
    ensure_database(spark, "folio_db_test", f"{tmp_out}/wh")   # idempotent
    try:
        assert write_table(spark.range(5), table="folio_db_test.t") == 5
        assert spark.table("folio_db_test.t").count() == 5
    finally:
        spark.sql("DROP DATABASE IF EXISTS folio_db_test CASCADE")


def test_ingest_job_out_partitions(spark, tmp_out):
    path = _write(f"{tmp_out}/in3/reviews.csv", RAW_REVIEWS)
    res = ingest_job(spark, {"books_rating": (path, C.REVIEW_SCHEMA)}, f"{tmp_out}/out3",
                     out_partitions=3)
    assert res.counts == {"books_rating": 4}
    files = [f for f in os.listdir(f"{tmp_out}/out3/books_rating") if f.endswith(".parquet")]
    assert 1 <= len(files) <= 3
    back = spark.read.parquet(f"{tmp_out}/out3/books_rating")
    assert back.columns == [*C.REVIEW_COLUMNS, C.ROW_ORDER, C.LOAD_SEQ] and back.count() == 4


def test_header_ending_in_its_position_is_not_a_duplicate(spark, tmp_out):
    path = _write(f"{tmp_out}/t2.csv", "id,x,Title2\n1,a,b\n")
    proj = read_csv_table(spark, path, C.REVIEW_SCHEMA)
    assert proj.dropped == ["x", "Title2"]
    path = _write(f"{tmp_out}/t3.csv", "id,Title,TITLE\n1,a,b\n")
    with pytest.raises(DuplicateHeaderError):
        read_csv_table(spark, path, C.REVIEW_SCHEMA)


def test_row_order_keeps_first_row_as_loaded(spark, tmp_out):
    from folio.operators.curate import curate
    books = _write(f"{tmp_out}/ro/books.csv",
                   "Title,authors,categories\nB,z1,c\nA,first,c\nA,second,c\nB,z2,c\n")
    revs = _write(f"{tmp_out}/ro/revs.csv", "Id,Title,review/score\n1,A,5\n2,B,4\n")
    res = ingest_job(spark, {"books_data": (books, C.CATALOG_SCHEMA),
                             "books_rating": (revs, C.REVIEW_SCHEMA)},
                     f"{tmp_out}/ro_out")
    assert res.counts == {"books_data": 4, "books_rating": 2}
    cat = spark.read.parquet(f"{tmp_out}/ro_out/books_data")
    assert cat.columns == [*C.CATALOG_COLUMNS, "_row_order", "_load_seq"]
    assert [r.authors for r in cat.orderBy("_row_order").collect()] == ["z1", "first", "second", "z2"]
    out = curate(cat, spark.read.parquet(f"{tmp_out}/ro_out/books_rating"))
    assert {r.title: r.authors for r in out.collect()} == {"A": "first", "B": "z1"}


def test_ingest_preflight_writes_nothing_when_an_input_is_missing(spark, tmp_out):
    books = _write(f"{tmp_out}/pf/books.csv", RAW_BOOKS)
    with pytest.raises(Exception):
        ingest_job(spark, {"books_data": (books, C.CATALOG_SCHEMA),
                           "books_rating": (f"{tmp_out}/pf/absent.csv", C.REVIEW_SCHEMA)},
                   f"{tmp_out}/pf_out")
    assert not os.path.exists(f"{tmp_out}/pf_out/books_data")


def test_odd_header_characters(spark, tmp_out):
    path = _write(f"{tmp_out}/odd.csv", 'Id,"we`ird",a.b,Title\n1,x,y,T\n')
    proj = read_csv_table(spark, path, C.REVIEW_SCHEMA)
    assert proj.dropped == ["we`ird", "a.b"]
    assert [(r.id, r.title) for r in proj.frame.collect()] == [("1", "T")]


def test_utf8_bom_header(spark, tmp_out):
    path = f"{tmp_out}/bom.csv"
    with open(path, "w", encoding="utf-8-sig") as fh:
        fh.write("Title,authors\nT1,A\n")
    proj = read_csv_table(spark, path, C.CATALOG_SCHEMA)
    assert proj.dropped == [] and [(r.title, r.authors) for r in proj.frame.collect()] == [("T1", "A")]


def test_crlf_line_endings(spark, tmp_out):
    path = f"{tmp_out}/crlf.csv"
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write('Title,authors\r\nT1,A\r\n"T\r\n2",B\r\n')
    rows = {r.authors: r.title for r in read_csv_table(spark, path, C.CATALOG_SCHEMA).frame.collect()}
    # no stray carriage return at line ends; Spark's parser reads a CRLF inside
    # a quoted field as LF (documented limitation)
    assert rows == {"A": "T1", "B": "T\n2"}


def test_malformed_rows(spark, tmp_out):
    wide = _write(f"{tmp_out}/wide.csv", 'Title,authors\nT1,"A, ""x"",\nb"\nT2,B,extra\n')
    short = _write(f"{tmp_out}/short.csv", "Title,authors\nT1\nT2,B\n")
    source = {"books_data": (wide, C.CATALOG_SCHEMA)}
    for mode in ("fail", "strict"):
        with pytest.raises(Exception):
            read_csv_table(spark, wide, C.CATALOG_SCHEMA, malformed=mode).frame.collect()
    with pytest.raises(Exception):
        ingest_job(spark, source, f"{tmp_out}/bad_out")
    res = ingest_job(spark, source, f"{tmp_out}/cut_out", malformed="permissive")
    assert (res.counts, res.wide_rows, res.short_rows) == ({"books_data": 2}, {"books_data": 1}, {"books_data": 0})
    res = ingest_job(spark, {"books_data": (short, C.CATALOG_SCHEMA)}, f"{tmp_out}/short_out")
    assert (res.wide_rows, res.short_rows) == ({"books_data": 0}, {"books_data": 1})
    rows = spark.read.parquet(f"{tmp_out}/short_out/books_data").collect()
    assert {(r.title, r.authors) for r in rows} == {("T1", None), ("T2", "B")}
    with pytest.raises(Exception):
        ingest_job(spark, {"books_data": (short, C.CATALOG_SCHEMA)}, f"{tmp_out}/s2", malformed="strict")


def test_skipped_input_leaves_the_table_alone(spark, tmp_out):
    books = _write(f"{tmp_out}/sk/books.csv", "Title,authors\nT1,A\nT2,B\n")
    ingest_job(spark, {"books_data": (books, C.CATALOG_SCHEMA)}, f"{tmp_out}/sk_out")
    res = ingest_job(spark, {"books_data": (f"{tmp_out}/absent.csv", C.CATALOG_SCHEMA)}, f"{tmp_out}/sk_out",
                     on_missing="skip")
    assert res.counts == {"books_data": 0}
    assert spark.read.parquet(f"{tmp_out}/sk_out/books_data").count() == 2


def test_failed_load_keeps_every_old_table(spark, tmp_out):
    good = _write(f"{tmp_out}/fl/books.csv", "Title,authors\nT1,A\nT2,B\n")
    revs = _write(f"{tmp_out}/fl/revs.csv", "Id,Title\n1,T1\n")
    out = f"{tmp_out}/fl_out"
    ingest_job(spark, {"books_data": (good, C.CATALOG_SCHEMA), "books_rating": (revs, C.REVIEW_SCHEMA)}, out)
    new = _write(f"{tmp_out}/fl/new.csv", "Title,authors\nT9,Z\n")
    bad = _write(f"{tmp_out}/fl/bad.csv", "Id,Title\n1,T1\n2,T2,extra\n")
    for append in (True, False):
        with pytest.raises(Exception):
            ingest_job(spark, {"books_data": (new, C.CATALOG_SCHEMA), "books_rating": (bad, C.REVIEW_SCHEMA)}, out,
                       truncate_first=not append)
        assert sorted(r.title for r in spark.read.parquet(f"{out}/books_data").collect()) == ["T1", "T2"]
        assert spark.read.parquet(f"{out}/books_rating").count() == 1
    assert sorted(os.listdir(out)) == ["books_data", "books_rating"]


def test_failed_etl_keeps_the_old_outputs(spark, tmp_out, catalog, reviews):
    from pyspark.sql import functions as F

    from folio.plans.jobs import etl_job
    table, csv = f"{tmp_out}/etl_t", f"{tmp_out}/etl_c"
    etl_job(spark, catalog, reviews, table_path=table, csv_path=csv, catalog_order=["seq"])
    broken = reviews.withColumn("review_text", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        etl_job(spark, catalog, broken, table_path=table, csv_path=csv, catalog_order=["seq"])
    assert spark.read.parquet(table).count() == 5
    assert spark.read.option("header", "true").csv(csv).count() == 5


def test_appended_loads_keep_their_order(spark, tmp_out):
    from folio.operators.curate import curate
    out = f"{tmp_out}/ap_out"
    for n, text in enumerate(("A,z\nB,first\n", "A,first\nB,later\nC,only\n")):
        path = _write(f"{tmp_out}/ap/{n}.csv", "Title,authors\n" + text)
        res = ingest_job(spark, {"books_data": (path, C.CATALOG_SCHEMA)}, out, truncate_first=n == 0)
    assert res.counts == {"books_data": 5}
    cat = spark.read.parquet(f"{out}/books_data")
    assert cat.select(C.LOAD_SEQ, C.ROW_ORDER).distinct().count() == 5
    revs = spark.createDataFrame([("1", t) for t in "ABC"], "id string, title string")
    assert {r.title: r.authors for r in curate(cat, revs).collect()} == {"A": "z", "B": "first", "C": "only"}
    with pytest.raises(ValueError):
        ingest_job(spark, {"books_data": (path, C.CATALOG_SCHEMA)}, out, truncate_first=False, load_order=False)


def test_catalog_targets_and_missing_tables(spark, tmp_out):
    from folio.plans.jobs import ingest_and_audit
    from folio.sources.tables import read_table
    books = _write(f"{tmp_out}/ct/books.csv", "Title,authors\nT1,A\n")
    spark.sql(f"CREATE DATABASE folio_jobs LOCATION '{tmp_out}/folio_jobs'")
    try:
        for _ in range(2):
            loaded, audit = ingest_and_audit(spark, books, f"{tmp_out}/ct/absent.csv", database="folio_jobs",
                                             on_missing="skip", raise_on_fail=False)
        assert loaded.counts == {"books_data": 1, "books_rating": 0} and not audit.passed
        assert [t.name for t in spark.catalog.listTables("folio_jobs")] == ["books_data"]
        with pytest.raises(ValueError):
            ingest_job(spark, {"books_data": (books, C.CATALOG_SCHEMA)})
    finally:
        spark.sql("DROP DATABASE IF EXISTS folio_jobs CASCADE")
    os.makedirs(f"{tmp_out}/empty")
    with pytest.raises(Exception):   # an existing folder without a table is an error, not a missing input
        read_table(spark, path=f"{tmp_out}/empty", schema=C.CATALOG_SCHEMA, on_missing="skip")


def test_files_without_line_breaks_may_be_split(spark, tmp_out):
    path = _write(f"{tmp_out}/nb.csv", "Id,Title\n" + "".join(f"{i},T{i}\n" for i in range(50)))
    proj = read_csv_table(spark, path, C.REVIEW_SCHEMA, multi_line=False)
    assert proj.frame.count() == 50


def test_number_text(spark):
    from pyspark.sql import types as T

    from folio.functions.exprs import safe_cast
    texts = ["1d", "1f", "0x1p3", "1.5", " 2 ", "1e3", "-inf", "nan", "x", "5.0", "5.5", "1e2"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", safe_cast("t", T.DoubleType()).alias("d"), safe_cast("t", T.LongType()).alias("n")).orderBy("i").collect()
    assert [str(r.d) for r in rows] == ["None", "None", "None", "1.5", "2.0", "1000.0", "-inf", "nan", "None", "5.0",
                                        "5.5", "100.0"]
    assert [r.n for r in rows] == [None, None, None, None, 2, 1000, None, None, None, 5, None, 100]
