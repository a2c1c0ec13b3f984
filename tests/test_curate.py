from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from folio import config as C
from folio.operators.curate import curate, fill_defaults, with_review_date
from folio.operators.dedupe import dedupe_first
from folio.operators.joins import find_hot_keys, lookup_join


def _by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_dedupe_keeps_first_row_and_null_is_one_key(catalog):
    out = dedupe_first(catalog, ["title"], ["seq"])
    assert sorted(r.seq for r in out.collect()) == [0, 2, 4]


def test_dedupe_is_idempotent(catalog):
    once = dedupe_first(catalog, ["title"], ["seq"])
    twice = dedupe_first(once, ["title"], ["seq"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_dedupe_default_order_is_content_based(catalog):
    data = catalog.drop("seq")
    picked = {r.title: r.categories for r in dedupe_first(data, ["title"]).collect()}
    shuffled = data.orderBy(F.desc("categories")).repartition(3)
    again = {r.title: r.categories for r in dedupe_first(shuffled, ["title"]).collect()}
    assert picked == again
    assert picked["Z"] is None and picked["X"] in ("c1", "c2") and picked[None] in ("cn1", "cn2")


def test_join_null_keys_match(catalog, reviews):
    books = dedupe_first(catalog, ["title"], ["seq"])
    out = fill_defaults(lookup_join(reviews, books, "title"))
    got = _by_id(out)
    assert sorted(got) == ["a", "c", "d", "e", "f"]
    assert [got[i].categories for i in "acdef"] == ["c1", "cn1", "c1", "cn1", "Unknown"]


def test_join_null_keys_drop(catalog, reviews):
    books = dedupe_first(catalog, ["title"], ["seq"])
    out = lookup_join(reviews, books, "title", null_keys="drop")
    assert sorted(_by_id(out)) == ["a", "d", "f"]


def test_join_rejects_unknown_null_mode(catalog, reviews):
    with pytest.raises(ValueError):
        lookup_join(reviews, catalog, "title", null_keys="maybe")


@pytest.mark.parametrize("hot", [[None], ["X"], [None, "X", "Z"]])
def test_salted_join_equals_plain_join(catalog, reviews, hot):
    books = dedupe_first(catalog, ["title"], ["seq"])
    plain = lookup_join(reviews, books, "title")
    salted = lookup_join(reviews, books, "title", hot_keys=hot, salt_buckets=4)
    assert salted.columns == plain.columns
    assert sorted(salted.collect()) == sorted(plain.collect())


def test_find_hot_keys_is_exact(reviews):
    assert set(find_hot_keys(reviews, "title", min_share=0.3)) == {"X", None}
    assert find_hot_keys(reviews.limit(0), "title") == []


def test_review_date_epoch_conversion(reviews):
    got = _by_id(with_review_date(reviews))
    assert got["a"].review_date == dt.datetime(1970, 1, 1, 0, 0, 0)
    assert got["c"].review_date == dt.datetime(1969, 12, 31, 23, 59, 59)
    assert got["f"].review_date is None


def test_review_date_only_when_source_column_exists(reviews):
    out = with_review_date(reviews.drop("review_time"))
    assert "review_date" not in out.columns


def test_review_date_ignores_session_time_zone(spark, reviews):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = _by_id(with_review_date(reviews))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got["a"].review_date == dt.datetime(1970, 1, 1)


def test_fill_defaults(reviews, catalog):
    books = dedupe_first(catalog, ["title"], ["seq"])
    got = _by_id(fill_defaults(lookup_join(reviews, books, "title")))
    assert got["f"].review_score == 0.0 and got["f"].categories == "Unknown"
    # configurable: no score fill keeps NULL
    got = _by_id(fill_defaults(lookup_join(reviews, books, "title"), {"review_score": None}))
    assert got["f"].review_score is None


def test_fill_keeps_empty_string(spark):
    df = spark.createDataFrame([("",), (None,)], "categories string")
    assert sorted(r[0] for r in fill_defaults(df).collect()) == ["", "Unknown"]


def test_curate_schema_and_rows(catalog, reviews):
    out = curate(catalog, reviews, catalog_order=["seq"])
    assert [(f.name, f.dataType) for f in out.schema] == \
        [(f.name, f.dataType) for f in C.CURATED_SCHEMA]
    assert out.count() == 5
    assert curate(catalog, reviews, catalog_order=["seq"], null_keys="drop").count() == 3


def test_curate_without_time_column_drops_review_date(catalog, reviews):
    out = curate(catalog, reviews.drop("review_time"), catalog_order=["seq"])
    assert "review_date" not in out.columns
    assert out.columns == [c for c in C.CURATED_COLUMNS if c != "review_date"]


def test_curated_rows_equal_matched_reviews(catalog, reviews):
    # invariant: curated rows = reviews whose title has a catalog row (NULL-safe)
    titles = {r.title for r in catalog.select("title").collect()}
    expected = sum(1 for r in reviews.collect() if r.title in titles)
    assert curate(catalog, reviews, catalog_order=["seq"]).count() == expected


def test_join_never_multiplies_reviews(spark, catalog, reviews):
    many = catalog.unionByName(catalog.withColumn("seq", F.col("seq") + 10))
    assert curate(many, reviews, catalog_order=["seq"]).count() == 5


def test_curate_auto_hot_keys(catalog, reviews):
    plain = curate(catalog, reviews, catalog_order=["seq"])
    auto = curate(catalog, reviews, catalog_order=["seq"], hot_keys="auto", hot_share=0.3)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(auto.collect(), key=key) == sorted(plain.collect(), key=key)


def test_split_nulls_equals_null_safe_join(catalog, reviews):
    plain = curate(catalog, reviews, catalog_order=["seq"])
    split = curate(catalog, reviews, catalog_order=["seq"], split_nulls=True)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert split.columns == plain.columns
    assert sorted(split.collect(), key=key) == sorted(plain.collect(), key=key)
    with pytest.raises(ValueError):
        lookup_join(reviews, catalog, "title", split_nulls=True, hot_keys=[None])


def test_out_of_range_epoch_is_null_not_an_error(spark):
    from folio.functions.exprs import MAX_EPOCH_SECONDS, MIN_EPOCH_SECONDS
    from folio.operators.quality import date_range
    vals = [MIN_EPOCH_SECONDS, MAX_EPOCH_SECONDS, MAX_EPOCH_SECONDS + 1, 10**15, -2**63, 0]
    df = spark.createDataFrame([(v,) for v in vals], "review_time long")
    got = [r.review_date for r in with_review_date(df).collect()]
    assert got[0] == dt.datetime(1, 1, 1) and got[1] == dt.datetime(9999, 12, 31, 23, 59, 59)
    assert got[2:5] == [None, None, None] and got[5] == dt.datetime(1970, 1, 1)
    row = date_range(df).first()
    assert row.primera_resena == dt.date(1, 1, 1) and row.ultima_resena == dt.date(9999, 12, 31)
    assert row.total_resenas == 6


@pytest.mark.parametrize("split", [False, True])
def test_empty_title_is_not_null_title(spark, split):
    cat = spark.createDataFrame([(0, "", "empty"), (1, None, "null")],
                                "seq long, title string, categories string")
    rev = spark.createDataFrame([("a", ""), ("b", None)], "id string, title string")
    got = {r.id: r.categories for r in
           lookup_join(rev, dedupe_first(cat, ["title"], ["seq"]), "title", split_nulls=split).collect()}
    assert got == {"a": "empty", "b": "null"}


def test_find_hot_keys_matches_brute_force(spark):
    rows = [("h",)] * 40 + [(None,)] * 25 + [(f"k{i}",) for i in range(35)]
    df = spark.createDataFrame(rows, "title string")
    assert set(find_hot_keys(df, "title", min_share=0.25)) == {"h", None}
    assert set(find_hot_keys(df, "title", min_share=0.3)) == {"h"}
    assert len(find_hot_keys(df, "title", min_share=0.01)) == 37


def test_dedupe_key_only_frame(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "title string")
    assert sorted(dedupe_first(df, ["title"]).collect(), key=lambda r: (r.title is None, r.title)) \
        == [("a",), ("b",), (None,)]


def test_default_order_reads_only_output_columns(spark, tmp_out, catalog, reviews):
    from folio.plans.inspect import plan_text
    catalog.withColumn("description", F.lit("long text")).write.parquet(f"{tmp_out}/cat")
    cat = spark.read.parquet(f"{tmp_out}/cat")
    out = curate(cat, reviews)
    schema_line = [ln for ln in plan_text(out).splitlines() if "ReadSchema" in ln][0]
    assert "description" not in schema_line and "seq" not in schema_line
    assert out.count() == 5
