"""Registered queries: ``(spark, sf_dir) -> DataFrame``, one per operator.

Every query reads the driver tables through the adapter views, so its work
grows with the data.  ``folio.plans.oracle`` holds the matching SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio import config as C
from folio.operators import quality as QA
from folio.operators.curate import curate, fill_defaults, with_review_date
from folio.operators.dedupe import dedupe_first
from folio.operators.joins import lookup_join, orphan_keys
from folio.operators.shaping import align_to_schema, normalize_na, project_existing, rename_columns, typed_cast
from folio.plans.jobs import audit_job, etl_job, incremental_audit_job, ingest_job, report_path_for
from folio.session import configure, scratch_path
from folio.sinks.staging import StagedLoad, recover
from folio.sinks.writers import ensure_database, write_csv, write_table
from folio.sources import adapters as A
from folio.sources.csv import CSV_READ_OPTIONS, read_csv_table
from folio.sources.tables import top_n as _top_n
from folio.streaming.ingest import stream_csv_to_table

CATALOG_ORDER = ("seq",)


def _views(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    configure(spark)
    return A.catalog(spark, sf_dir), A.reviews(spark, sf_dir)


# -- curation -----------------------------------------------------------------

def curated_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    books, ratings = _views(spark, sf_dir)
    return curate(books, ratings, catalog_order=CATALOG_ORDER)


def curated_drop_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    books, ratings = _views(spark, sf_dir)
    return curate(books, ratings, catalog_order=CATALOG_ORDER, null_keys="drop")


def curated_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated reviews with the NULL title salted as a declared hot key."""
    books, ratings = _views(spark, sf_dir)
    return curate(books, ratings, catalog_order=CATALOG_ORDER, hot_keys=[None])


def curated_split_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated reviews joining NULL titles by a bounded broadcast, the rest by equality."""
    books, ratings = _views(spark, sf_dir)
    return curate(books, ratings, catalog_order=CATALOG_ORDER, split_nulls=True)


def curated_keep_null_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated reviews with the score fill switched off (NULL scores stay NULL)."""
    books, ratings = _views(spark, sf_dir)
    return curate(books, ratings, catalog_order=CATALOG_ORDER,
                  fills={**C.DEFAULT_FILLS, "review_score": None})


def curated_auto_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated reviews salting every title that holds at least 1% of the reviews."""
    books, ratings = _views(spark, sf_dir)
    return curate(books, ratings, catalog_order=CATALOG_ORDER, hot_keys="auto", hot_share=0.01)


def dedupe_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    books, _ = _views(spark, sf_dir)
    return dedupe_first(books, ["title"], CATALOG_ORDER)


def review_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, ratings = _views(spark, sf_dir)
    return with_review_date(ratings)


def fill_defaults_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unprojected merge (all review and catalog columns) with the fills."""
    books, ratings = _views(spark, sf_dir)
    deduped = dedupe_first(books, ["title"], CATALOG_ORDER)
    return fill_defaults(lookup_join(with_review_date(ratings), deduped, "title"))


# -- audits -------------------------------------------------------------------

def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    books, ratings = _views(spark, sf_dir)
    return QA.table_counts({C.CATALOG_LABEL: books, C.REVIEWS_LABEL: ratings})


def score_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, ratings = _views(spark, sf_dir)
    return QA.score_distribution(ratings)


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    books, ratings = _views(spark, sf_dir)
    return QA.null_profile({"catalog": books, "reviews": ratings}, C.NULL_METRICS)


def score_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, ratings = _views(spark, sf_dir)
    return QA.score_range(ratings)


def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, ratings = _views(spark, sf_dir)
    return QA.date_range(ratings)


def volume_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table_counts(spark, sf_dir)
    return QA.volume_gate(counts, QA.thresholds_frame(spark))


def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four-section report, one scan per table (sections share one aggregate)."""
    books, ratings = _views(spark, sf_dir)
    return QA.fused_audit_report(books, ratings)


def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    books, _ = _views(spark, sf_dir)
    return QA.key_violations(books, "title")


def orphan_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    books, ratings = _views(spark, sf_dir)
    return orphan_keys(ratings, books, "title")


# -- scans --------------------------------------------------------------------

def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, ratings = _views(spark, sf_dir)
    return ratings


def _top_tenth(spark: SparkSession, sf_dir: str, order: tuple[str, ...]) -> DataFrame:
    """The extract's review cap as a deterministic top-n: a tenth of the reviews."""
    configure(spark)
    ratings = A.reviews(spark, sf_dir, with_part_key=True)
    return _top_n(ratings, max(1, ratings.count() // 10), order)


def top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top_tenth(spark, sf_dir, A.REVIEW_ORDER)


def top_n_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the cut inside a large group of ties: few lines, then prices."""
    return _top_tenth(spark, sf_dir, ("line_no", "price", "id", "part_key", "user_id"))


def top_n_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With text (and NULLs) leading the order."""
    return _top_tenth(spark, sf_dir, ("title", "review_score", "id", "line_no", "part_key", "user_id", "price"))


# -- load shaping -------------------------------------------------------------

def rename_columns_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    books, _ = _views(spark, sf_dir)
    raw = books.select(*[F.col(c).alias(h) for c, h in A.RAW_CATALOG_HEADERS.items()])
    return rename_columns(raw)


def project_existing_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, ratings = _views(spark, sf_dir)
    return project_existing(ratings, C.REVIEW_COLUMNS)


def na_tokens_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every NA token and near-miss, spread over the catalog rows by key."""
    configure(spark)
    part = A.load(spark, sf_dir, "part")
    probes = [F.lit(t) for t in C.NA_TOKENS + A.NEAR_MISSES]
    width = len(probes) + 3
    probes += [F.col("p_name")] * 3
    raw = part.select(F.col("p_partkey"),
                      F.element_at(F.array(*probes), (F.col("p_partkey") % width + 1).cast("int"))
                      .alias("raw_value"))
    return raw.withColumn("value", F.col("raw_value")).transform(
        lambda df: normalize_na(df, C.NA_TOKENS, columns=["value"]))


def _typed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    li = A.load(spark, sf_dir, "lineitem")
    epoch = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"),
                             F.col("l_shipdate")).cast("string")
    return li.select(
        F.lpad(F.col("l_orderkey").cast("string"), 8, "0").alias("id"),
        F.col("l_linenumber").cast("string").alias("line_no"),
        F.when(F.col("l_linenumber") == 7, F.lit("notnum"))
         .otherwise(F.col("l_extendedprice").cast("string")).alias("price"),
        F.col("l_discount").cast("string").alias("review_score"),
        F.when(F.col("l_linenumber") == 3, F.concat(epoch, F.lit(".0")))
         .when(F.col("l_linenumber") == 5, F.concat(epoch, F.lit(".5")))
         .otherwise(epoch).alias("review_time"),
    )


def typed_cast_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty text -> table types: zero-padded ids stay text, junk -> NULL."""
    schema = T.StructType(C.REVIEW_SCHEMA.fields + [T.StructField("line_no", T.IntegerType())])
    return typed_cast(_typed_text(spark, sf_dir), schema)


# -- sources and sinks (write to the shared checkpoint folder, read back) ------

#: Rows in a landed CSV file (a quoted-newline file is parsed by one task).
LANDED_ROWS = 100_000
#: Files of each load whose order counts.
LOAD_FILES = 9


def _export_reviews_csv(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Land the reviews as raw CSV in files of bounded size, as a landing zone holds them."""
    _, ratings = _views(spark, sf_dir)
    path = scratch_path(spark, name)
    write_csv(A.raw_review_export(ratings), path, max_records_per_file=LANDED_ROWS)
    return path


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export reviews as raw CSV, then ingest them back into the raw schema."""
    path = _export_reviews_csv(spark, sf_dir, "csv_roundtrip")
    return read_csv_table(spark, path, C.REVIEW_SCHEMA).frame


def split_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported reviews, with line breaks in their texts, read with the files split over tasks."""
    path = _export_reviews_csv(spark, sf_dir, "split_csv")
    return read_csv_table(spark, path, C.REVIEW_SCHEMA, multi_line="split").frame


def header_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load over files with three orders of headers, one of them without the price and with a header of its own."""
    _, ratings = _views(spark, sf_dir)
    path = scratch_path(spark, "header_orders")
    raw = A.raw_review_export(ratings).withColumn("extra", F.lit("x,\n"))
    heads = list(A.RAW_REVIEW_HEADERS.values())
    for n, columns in enumerate((heads, heads[::-1], ["extra", *(h for h in heads[2:] + heads[:2] if h != "Price")])):
        write_csv(raw.where(F.col("Id") % 3 == n).select(*columns), f"{path}/group={n}",
                  max_records_per_file=LANDED_ROWS)
    out = scratch_path(spark, "header_orders_out")
    ingest_job(spark, {"books_rating": (f"{path}/*", C.REVIEW_SCHEMA)}, out, load_order=False, multi_line="split")
    return spark.read.parquet(f"{out}/books_rating")


def ingest_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw-ingest job (CSV -> typed Parquet table), read back."""
    path = _export_reviews_csv(spark, sf_dir, "ingest_src")
    out = scratch_path(spark, "ingest_out")
    ingest_job(spark, {"books_rating": (path, C.REVIEW_SCHEMA)}, out, load_order=False)
    return spark.read.parquet(f"{out}/books_rating")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental ingest of the exported CSV files."""
    path = _export_reviews_csv(spark, sf_dir, "stream_src")
    out, ckpt = scratch_path(spark, "stream_out"), scratch_path(spark, "stream_ckpt")
    stream_csv_to_table(spark, path, out, ckpt, C.REVIEW_SCHEMA,
                        header=list(A.RAW_REVIEW_HEADERS.values()))
    return spark.read.parquet(out)


def malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with too many and too few fields, as a permissive ingest counts them."""
    books, _ = _views(spark, sf_dir)
    fields = F.when(F.col("seq") % 11 == 0, F.array("title", "authors", "publisher", F.lit('x,"y')))
    fields = fields.when(F.col("seq") % 7 == 0, F.array("title")).otherwise(F.array("title", "authors", "publisher"))
    quoted = F.transform(fields, lambda x: F.concat(
        F.lit('"'), F.replace(F.coalesce(x, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')))
    path, out = scratch_path(spark, "malformed_src"), scratch_path(spark, "malformed_out")
    # whole lines under the header, as one column that needs no quoting of its own
    (books.select(F.array_join(quoted, ",").alias("title,authors,publisher"))
     .write.options(header="true", sep="\u0001", quote="\u0002").csv(path))
    found = ingest_job(spark, {"books_data": (path, C.CATALOG_SCHEMA)}, out, malformed="permissive")
    table = spark.read.parquet(f"{out}/books_data")
    return table.agg(F.count("*").alias("rows"), F.count("title").alias("titles"), F.count("authors").alias("authors"),
                     F.count("publisher").alias("publishers")).select(
        "*", F.lit(found.wide_rows["books_data"]).cast("long").alias("wide_rows"),
        F.lit(found.short_rows["books_data"]).cast("long").alias("short_rows"))


def first_as_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of many files of a catalog with repeated titles, then the first row of each title as loaded."""
    books, _ = _views(spark, sf_dir)
    out = scratch_path(spark, "loads")
    columns = {v: A.RAW_CATALOG_HEADERS[v] for v in ("title", "description", "authors", "categories", "publisher")}
    for n, part in enumerate((F.col("seq") % 2 == 1, F.col("seq") % 2 == 0)):
        path = scratch_path(spark, f"load{n}")
        # files in ascending order of their names hold the rows in descending order
        rows = books.where(part).repartitionByRange(LOAD_FILES, F.desc("seq")).sortWithinPartitions(F.desc("seq"))
        write_csv(rows.select(*[F.col(c).alias(h) for c, h in columns.items()]), path)
        ingest_job(spark, {"books_data": (path, C.CATALOG_SCHEMA)}, out, truncate_first=n == 0, multi_line="split")
    loaded = spark.read.parquet(f"{out}/books_data")
    return dedupe_first(loaded, ["title"], [C.LOAD_SEQ, C.ROW_ORDER]).select(*columns)


class _DriverLost(BaseException):
    """Nothing catches it, and nothing is undone."""


class _CutOff(StagedLoad):
    """A load that stops for good after a few renames."""

    def _done(self, step: str) -> None:
        self.steps = getattr(self, "steps", 0) + 1
        if self.steps >= 3:
            raise _DriverLost(step)


def recovered_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group load cut off halfway through its renames, recovered, and its tables read: titles by table."""
    books, ratings = _views(spark, sf_dir)
    out = scratch_path(spark, "recovered")
    frames = {"books_data": books, "books_rating": ratings}
    with StagedLoad(spark) as load:  # the old tables
        for name, frame in frames.items():
            load.stage(frame.where("title IS NULL"), path=f"{out}/{name}")
    try:
        with _CutOff(spark) as load:
            for name, frame in frames.items():
                load.stage(frame, path=f"{out}/{name}")
    except _DriverLost:
        recover(spark, out)
    counts = [spark.read.parquet(f"{out}/{name}").groupBy("title").agg(F.count("*").alias("registros"))
              .select(F.lit(name).alias("tabla"), "title", "registros") for name in frames]
    return counts[0].unionByName(counts[1])


def append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to a catalog table, the second with its columns in another order."""
    books, _ = _views(spark, sf_dir)
    where = scratch_path(spark, "appended")
    name = "folio_" + where.rsplit("-", 1)[-1]
    ensure_database(spark, name, where)
    for n, columns in enumerate((books.columns, books.columns[::-1], sorted(books.columns))):
        with StagedLoad(spark) as load:
            load.stage(books.where(F.col("seq") % 3 == n).select(*columns), table=f"{name}.books", mode="append")
    return spark.table(f"{name}.books")


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest into catalog tables, curate from them into another, and read that."""
    _, ratings = _views(spark, sf_dir)
    where = scratch_path(spark, "database")
    name = "folio_" + where.rsplit("-", 1)[-1]
    ensure_database(spark, name, where)
    books = A.catalog(spark, sf_dir)
    csv = scratch_path(spark, "catalog_src")
    write_csv(books.select(*[F.col(c).alias(h) for c, h in A.RAW_CATALOG_HEADERS.items()]), f"{csv}/books")
    write_csv(A.raw_review_export(ratings).withColumn("review/text", F.lit("t")), f"{csv}/ratings",
              max_records_per_file=LANDED_ROWS)
    ingest_job(spark, {"books_data": (f"{csv}/books", C.CATALOG_SCHEMA),
                       "books_rating": (f"{csv}/ratings", C.REVIEW_SCHEMA)}, database=name)
    etl_job(spark, spark.table(f"{name}.books_data"), spark.table(f"{name}.books_rating"),
            table=f"{name}.curated", catalog_order=["title", "description", "authors", "categories", "publisher"])
    return spark.table(f"{name}.curated")


def bucketed_curation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curation over tables bucketed by title: keyed rows join with no exchange."""
    books, ratings = _views(spark, sf_dir)
    where = scratch_path(spark, "buckets")
    name = "folio_" + where.rsplit("-", 1)[-1]
    ensure_database(spark, name, where)
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    write_table(books, table=f"{name}.books", bucket_by=(buckets, ["title"]))
    write_table(ratings, table=f"{name}.ratings", bucket_by=(buckets, ["title"]), cluster_by=["title"])
    return curate(spark.table(f"{name}.books"), spark.table(f"{name}.ratings"), catalog_order=CATALOG_ORDER,
                  split_nulls=True)


#: Row groups small enough for lookups to skip most of a small table, too.
LOOKUP_ROW_GROUP = 1 << 18
LOOKUP_COLUMNS = ("title", "user_id", "review_score")


def _lookup_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews laid out for lookups by title, user and score."""
    _, ratings = _views(spark, sf_dir)
    path = scratch_path(spark, "lookup")
    write_table(ratings, path=path, z_order_by=LOOKUP_COLUMNS, bloom_distinct=10_000, row_group_bytes=LOOKUP_ROW_GROUP)
    return spark.read.schema(ratings.schema).parquet(path)


def lookup_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup_table(spark, sf_dir).where("title = 'T77'")


def lookup_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup_table(spark, sf_dir).where("user_id = '7'")


def lookup_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By score and user together; and those without a title."""
    found = _lookup_table(spark, sf_dir)
    return found.where("review_score = 3 AND user_id < '2'").union(found.where("review_score = 6 AND title IS NULL"))


def audit_job_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit job with its report written, and the report read back as text."""
    books, ratings = _views(spark, sf_dir)
    path = report_path_for(scratch_path(spark, "reports"))
    audit_job(spark, books, ratings, report_path=path)
    report = spark.read.options(**{**CSV_READ_OPTIONS, "multiLine": "false"}).csv(path)
    return report.select(*[F.col(c).cast(kind).alias(c) for c, kind in REPORT_TYPES.items()])


REPORT_TYPES = {"seccion": "string", "tabla": "string", "registros": "long", "review_score": "double",
                "cantidad": "long", "porcentaje": "double", "metrica": "string", "valor": "long",
                "score_minimo": "double", "score_maximo": "double", "score_promedio": "double", "fuera_de_rango": "long"}


def audit_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit report after three appended loads, each audited by reading it alone."""
    books, ratings = _views(spark, sf_dir)
    out, state = scratch_path(spark, "audited"), scratch_path(spark, "audit_state")
    books = align_to_schema(books, C.CATALOG_SCHEMA)
    ratings = align_to_schema(ratings, C.REVIEW_SCHEMA)
    for n in range(3):
        write_table(books.where(F.crc32(F.coalesce("description", F.lit("")).cast("binary")) % 3 == n),
                    path=f"{out}/books_data", mode="append")
        write_table(ratings.where(F.col("id").cast("long") % 3 == n), path=f"{out}/books_rating", mode="append")
        found = incremental_audit_job(spark, f"{out}/books_data", f"{out}/books_rating", state)
    return found.report


def price_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score range over fractional values: the mean of price per hundred, rounded half up."""
    _, ratings = _views(spark, sf_dir)
    scores = ratings.select((F.col("price").cast("decimal(18,2)") / F.lit(10000).cast("decimal(5,0)"))
                            .cast("double").alias("review_score"))
    return QA.score_range(scores)


def extreme_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score range over prices among values of all sizes, which cancel out, and long fractions."""
    _, ratings = _views(spark, sf_dir)
    scores = F.array(F.col("price"), F.lit(1e300), F.lit(-1e300), F.lit(1e-300), F.lit(0.30000000000000004), F.lit(-1e-300),
                     F.lit(1.25e22), F.lit(-1.25e22))
    return QA.score_range(ratings.select(F.explode(scores).alias("review_score")))


def table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the catalog twice in overwrite mode: the second load replaces the first."""
    books, _ = _views(spark, sf_dir)
    path = scratch_path(spark, "overwrite")
    write_table(books, path=path, mode="overwrite")
    write_table(books, path=path, mode="overwrite")
    return spark.read.parquet(path)


def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the reviews, then append them again: the table holds both loads."""
    _, ratings = _views(spark, sf_dir)
    path = scratch_path(spark, "append")
    write_table(ratings, path=path, mode="overwrite")
    write_table(ratings, path=path, mode="append")
    return spark.read.parquet(path)


def etl_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ETL job end to end; its curated CSV read back in the curated schema."""
    books, ratings = _views(spark, sf_dir)
    table, csv = scratch_path(spark, "curated_tbl"), scratch_path(spark, "curated_csv")
    etl_job(spark, books, ratings, table_path=table, csv_path=csv, catalog_order=CATALOG_ORDER)
    return read_csv_table(spark, csv, C.CURATED_SCHEMA).frame


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "curated_reviews": curated_reviews,
    "curated_drop_null_keys": curated_drop_null_keys,
    "curated_salted": curated_salted,
    "curated_split_nulls": curated_split_nulls,
    "curated_keep_null_scores": curated_keep_null_scores,
    "curated_auto_hot_keys": curated_auto_hot_keys,
    "dedupe_catalog": dedupe_catalog,
    "review_date": review_date,
    "fill_defaults": fill_defaults_q,
    "table_counts": table_counts,
    "score_distribution": score_distribution,
    "null_profile": null_profile,
    "score_range": score_range,
    "date_range": date_range,
    "volume_gate": volume_gate,
    "audit_report": audit_report,
    "key_violations": key_violations,
    "orphan_reviews": orphan_reviews,
    "table_scan": table_scan,
    "top_n": top_n,
    "top_n_tree": top_n_tree,
    "top_n_cutoff": top_n_cutoff,
    "rename_columns": rename_columns_q,
    "project_existing": project_existing_q,
    "na_tokens": na_tokens_q,
    "typed_cast": typed_cast_q,
    "csv_roundtrip": csv_roundtrip,
    "split_csv": split_csv,
    "header_orders": header_orders,
    "ingest_reviews": ingest_reviews,
    "stream_ingest": stream_ingest,
    "table_overwrite": table_overwrite,
    "table_append": table_append,
    "etl_csv": etl_csv,
    "price_range": price_range,
    "extreme_mean": extreme_mean,
    "lookup_title": lookup_title,
    "lookup_user": lookup_user,
    "lookup_score": lookup_score,
    "audit_job_report": audit_job_report,
    "audit_incremental": audit_incremental,
    "bucketed_curation": bucketed_curation,
    "catalog_tables": catalog_tables,
    "recovered_load": recovered_load,
    "append_by_name": append_by_name,
    "first_as_loaded": first_as_loaded,
    "malformed_rows": malformed_rows,
}
