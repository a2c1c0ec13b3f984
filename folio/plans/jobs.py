"""Composite jobs: raw ingest, audit with volume gate, and extract-transform-load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio import config as C
from folio.operators import quality as QA
from folio.operators.curate import curate
from folio.operators.shaping import align_to_schema
from folio.sinks.staging import StagedLoad, delete_path, path_exists
from folio.sinks.writers import ensure_database, write_csv
from folio.sources.csv import read_csv_table
from folio.sources.tables import hash_sample, read_table, table_exists, top_n


@dataclass
class IngestResult:
    counts: dict[str, int] = field(default_factory=dict)
    missing_columns: dict[str, list[str]] = field(default_factory=dict)
    dropped_headers: dict[str, list[str]] = field(default_factory=dict)
    rejected_values: dict[str, dict[str, int]] = field(default_factory=dict)
    wide_rows: dict[str, int] = field(default_factory=dict)
    short_rows: dict[str, int] = field(default_factory=dict)
    #: For ``multi_line="split"``: (file, header, missing, dropped) of each input file.
    files: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def total(self) -> int:
        return sum(self.counts.values())


def _target(name: str, out_root: str | None, database: str | None) -> dict[str, str]:
    if (out_root is None) == (database is None):
        raise ValueError("give exactly one of out_root= or database=")
    return {"table": f"{database}.{name}"} if database else {"path": f"{out_root.rstrip('/')}/{name}"}


def _next_load(spark: SparkSession, target: Mapping[str, str], columns: Sequence[str]) -> int:
    """The number of the next load into an existing table; its columns must be those of the load."""
    old = read_table(spark, **target)
    if sorted(old.columns) != sorted(columns):
        raise ValueError(f"cannot append to {target}: it has the columns {old.columns}, the load has {list(columns)}")
    if C.LOAD_SEQ not in old.columns:
        return 0
    return int(old.agg(F.coalesce(F.max(C.LOAD_SEQ), F.lit(-1))).first()[0]) + 1


def ingest_job(spark: SparkSession, sources: Mapping[str, tuple[str, object]],
               out_root: str | None = None, *, database: str | None = None,
               truncate_first: bool = True, on_missing: str = "fail",
               header_map: Mapping[str, str] = C.HEADER_MAP,
               na_tokens: Sequence[str] = C.NA_TOKENS,
               out_partitions: int | None = None,
               load_order: bool = True,
               malformed: str = "fail",
               multi_line: bool | str = True) -> IngestResult:
    """Load each ``name -> (csv_path, schema)`` into ``out_root/name`` or ``database.name`` (Parquet).

    One Spark job per table replaces the chunked append loop.  All tables are
    staged and take effect together (``StagedLoad``): replaced, or with
    ``truncate_first=False`` appended to; when anything fails, every table
    keeps its old rows (a load cut off while it is put in place is finished by
    ``sinks.staging.recover``).  A skipped input (``on_missing="skip"``) leaves its
    table alone and counts 0.

    Tables have the full ``schema`` (columns the file lacks are NULL) and,
    with ``load_order``, the number of the load and the row's place in it
    (``_load_seq``, ``_row_order``), by which ``curate`` keeps the first row
    as loaded.  Reports the table's row count after the load, target columns
    absent from the file, headers dropped, per-column cast rejections, and
    rows with too many or too few fields (``read_csv_table``).

    A quoted-newline CSV is parsed by one task per file; ``multi_line="split"``
    splits files over many tasks, maps each file by its own header and numbers
    rows by file name and place, whatever the splits; ``False`` splits files that
    have no line breaks in fields.  ``out_partitions`` spreads the casting and
    Parquet encoding over that many tasks (a round-robin shuffle).
    """
    result = IngestResult()
    if database is not None:
        ensure_database(spark, database)
    # Preflight: resolve every input (existence, headers) before any is loaded
    planned = {}
    for name, (path, schema) in sources.items():
        rejects, widths = Observation(f"rejects_{name}"), Observation(f"widths_{name}")
        proj = read_csv_table(spark, path, schema, header_map=header_map, na_tokens=na_tokens,
                              on_missing=on_missing, observation=rejects, malformed=malformed,
                              multi_line=multi_line, widths=widths,
                              row_order_col=C.ROW_ORDER if load_order else None)
        planned[name] = (schema, rejects, widths, proj)
    with StagedLoad(spark) as load:
        for name, (schema, rejects, widths, proj) in planned.items():
            result.missing_columns[name], result.dropped_headers[name] = proj.missing, proj.dropped
            result.rejected_values[name] = {}
            result.counts[name] = result.wide_rows[name] = result.short_rows[name] = 0
            if not proj.found:
                continue
            if proj.files is not None:
                result.files[name] = proj.files
            target = _target(name, out_root, database)
            keep = [C.ROW_ORDER] if load_order else []
            frame = align_to_schema(proj.frame, schema, keep=keep)
            exists = not truncate_first and table_exists(spark, **target)
            if load_order:
                seq = _next_load(spark, target, [*frame.columns, C.LOAD_SEQ]) if exists else 0
                frame = frame.withColumn(C.LOAD_SEQ, F.lit(seq))
            elif exists:
                _next_load(spark, target, frame.columns)
            if out_partitions:
                frame = frame.repartition(out_partitions)
            old = read_table(spark, **target).count() if exists else 0
            result.counts[name] = old + load.stage(frame, **target, mode="append" if exists else "overwrite")
            typed = [f.name for f in schema.fields if not isinstance(f.dataType, T.StringType)]
            if set(typed) - set(proj.missing):
                result.rejected_values[name] = {k: int(v) for k, v in rejects.get.items()}
            if malformed != "strict":
                seen = widths.get
                result.wide_rows[name], result.short_rows[name] = int(seen["wide_rows"]), int(seen["short_rows"])
    return result


@dataclass
class AuditResult:
    passed: bool
    gate: list[tuple[str, int, int, bool]]
    out_of_range: int
    report: DataFrame
    date_range: DataFrame
    times_out_of_range: int = 0
    scores_not_exact: int = 0


class VolumeGateError(RuntimeError):
    """A table is below its minimum row count."""


def report_path_for(report_dir: str, when: datetime | None = None) -> str:
    """``<report_dir>/<prefix><yyyyMMdd_HHmmss>``: one report folder per run."""
    stamp = (when or datetime.now()).strftime(C.REPORT_TS_FORMAT)
    return f"{report_dir.rstrip('/')}/{C.REPORT_PREFIX}{stamp}"


def audit_job(spark: SparkSession, catalog: DataFrame, reviews: DataFrame, *,
              thresholds: Mapping[str, int] = C.VOLUME_THRESHOLDS,
              report_path: str | None = None, raise_on_fail: bool = False) -> AuditResult:
    """The audit battery: counts, distribution, nulls, score and date ranges, gate.

    Only the volume gate decides ``passed``; out-of-range scores are
    reported but do not fail.  ``times_out_of_range`` counts review times no
    timestamp can hold, which the date range skips, and ``scores_not_exact``
    the scores that are infinite, NaN, or 10**10 and more.  The report stacks the first four sections
    (the date range is returned separately) and is written as one small CSV
    when ``report_path`` is given.  Each table is scanned once for all of it
    (``audit_sections``); only aggregate rows reach the driver.
    """
    return _audited(spark, QA.audit_sections(catalog, reviews), thresholds, report_path, raise_on_fail)


def _audited(spark: SparkSession, sec: Mapping[str, DataFrame], thresholds: Mapping[str, int],
             report_path: str | None, raise_on_fail: bool) -> AuditResult:
    gate_df = QA.volume_gate(sec["counts"], QA.thresholds_frame(spark, thresholds))
    gate = [(r["tabla"], r["registros"], r["minimo"], r["ok"]) for r in gate_df.collect()]
    report = QA.audit_report([
        (C.SECTION_COUNTS, sec["counts"]),
        (C.SECTION_DISTRIBUTION, sec["distribution"]),
        (C.SECTION_NULLS, sec["nulls"]),
        (C.SECTION_SCORE_RANGE, sec["score_range"]),
    ])
    out_of_range = sec["score_range"].select("fuera_de_rango").first()[0]
    if report_path is not None:
        write_csv(report, report_path, single_file=True)
    passed = all(ok for *_, ok in gate)
    if raise_on_fail and not passed:
        raise VolumeGateError(f"volume gate failed: {gate}")
    left_out = sec["left_out"].first()
    return AuditResult(passed, gate, int(out_of_range or 0), report, sec["date_range"],
                       left_out["times_out_of_range"], left_out["scores_not_exact"])


def _part_partials(spark: SparkSession, path: str, state: str, schema: T.StructType, kind: str) -> DataFrame:
    """The union of a table's partials by part, after those of its new files are added to the state.

    A part is a folder of partials and the list of the files that they cover, written
    last, so a part without a whole list does not count and is written again.  When
    a file that some part covers is gone (the table was replaced), all parts are out of date.
    """
    now = {unquote(f) for f in spark.read.schema(schema).parquet(path).inputFiles()}
    parts, known = 0, set()
    while path_exists(spark, f"{state}/{parts}/files/_SUCCESS"):
        known |= {r["file"] for r in spark.read.schema("file string").parquet(f"{state}/{parts}/files").toLocalIterator()}
        parts += 1
    if known - now:
        delete_path(spark, state)
        parts, known = 0, set()
    new = sorted(now - known)
    frame = spark.read.schema(schema).parquet(*new) if new else spark.createDataFrame([], schema)
    empty = spark.createDataFrame([], C.CATALOG_SCHEMA if kind == "reviews" else C.REVIEW_SCHEMA)
    own = QA.audit_partials(*((empty, frame) if kind == "reviews" else (frame, empty)))[kind == "catalog"]
    if new or not parts:
        own.write.mode("overwrite").parquet(f"{state}/{parts}/partials")
        (spark.createDataFrame([(f,) for f in new], "file string").coalesce(1)
         .write.mode("overwrite").parquet(f"{state}/{parts}/files"))
        parts += 1
    return spark.read.schema(own.schema).parquet(*[f"{state}/{n}/partials" for n in range(parts)])


def incremental_audit_job(spark: SparkSession, catalog_path: str, reviews_path: str, state_path: str, *,
                          thresholds: Mapping[str, int] = C.VOLUME_THRESHOLDS,
                          report_path: str | None = None, raise_on_fail: bool = False) -> AuditResult:
    """``audit_job`` over Parquet folders, reading only the files that came since the last audit.

    ``state_path`` keeps the aggregates of what was audited (a row for each score and
    audit) and the names of its files.  An appended load is read alone; a replaced
    table is read whole.  One audit at a time per state; one that was cut off is repeated.
    """
    both = [_part_partials(spark, path, f"{state_path.rstrip('/')}/{kind}", schema, kind)
            for path, schema, kind in ((reviews_path, C.REVIEW_SCHEMA, "reviews"),
                                       (catalog_path, C.CATALOG_SCHEMA, "catalog"))]
    sec = QA.audit_sections(None, None, partials=QA.merge_partials(*both))
    return _audited(spark, sec, thresholds, report_path, raise_on_fail)


def ingest_and_audit(spark: SparkSession, catalog_csv: str, reviews_csv: str,
                     out_root: str | None = None, *, database: str | None = None,
                     report_dir: str | None = None,
                     thresholds: Mapping[str, int] = C.VOLUME_THRESHOLDS,
                     raise_on_fail: bool = True,
                     **options) -> tuple[IngestResult, AuditResult]:
    """Load both raw tables, then audit them; fail fast on the volume gate.

    Tables land as ``books_data`` and ``books_rating`` (``ingest_job`` has the
    targets and the ``options``); the audit reads the written tables, not the
    CSV again, and its report goes to a timestamped folder under
    ``report_dir``.  A table that a skipped input never made counts as empty.
    """
    loaded = ingest_job(spark, {"books_data": (catalog_csv, C.CATALOG_SCHEMA),
                                "books_rating": (reviews_csv, C.REVIEW_SCHEMA)},
                        out_root, database=database, **options)
    tables = [read_table(spark, **_target(name, out_root, database), schema=schema, on_missing="skip")
              for name, schema in (("books_data", C.CATALOG_SCHEMA), ("books_rating", C.REVIEW_SCHEMA))]
    audited = audit_job(spark, *tables, thresholds=thresholds,
                        report_path=report_path_for(report_dir) if report_dir else None,
                        raise_on_fail=raise_on_fail)
    return loaded, audited


def etl_job(spark: SparkSession, catalog: DataFrame, reviews: DataFrame, *,
            table_path: str | None = None, table: str | None = None, csv_path: str | None = None,
            catalog_order: Sequence[str | Column] | None = None,
            null_keys: str = "match",
            fills: Mapping[str, object] = C.DEFAULT_FILLS,
            max_reviews: int | None = None,
            review_order: Sequence[str] | None = None,
            review_sample: tuple[Sequence[str], int] | None = None,
            cluster_by: Sequence[str] = (),
            max_records_per_file: int | None = None,
            compression: str | None = None,
            csv_single_file: bool = False) -> int:
    """Extract -> curate -> load: write the curated table, then its CSV copy.

    The target is a path or a catalog table.  The CSV is derived from the
    written table, so the join runs once and the two outputs cannot disagree;
    both are staged and replace the old ones together, so a failure leaves
    those as they were.  ``max_reviews`` keeps the first n reviews by ``review_order``
    (a deterministic cap instead of an unordered limit); ``review_sample=
    (keys, k)`` keeps the reviews whose key hash falls in one of ``k``
    buckets instead -- a repeatable subset filtered in every task, with no
    single-task merge, for development runs on very large tables.  ``cluster_by``,
    ``max_records_per_file`` and ``compression`` shape the table files (see
    ``write_table``).  ``csv_single_file`` writes the CSV copy as one file
    (one task; for outputs small enough to handle that way).  Returns the
    row count of the curated table.
    """
    if max_reviews is not None:
        if not review_order:
            raise ValueError("max_reviews needs review_order for a deterministic cap")
        reviews = top_n(reviews, max_reviews, review_order)
    if review_sample is not None:
        keys, buckets = review_sample
        reviews = hash_sample(reviews, list(keys), buckets)
    curated = curate(catalog, reviews, catalog_order=catalog_order, null_keys=null_keys,
                     fills=fills)
    with StagedLoad(spark) as load:
        rows = load.stage(curated, path=table_path, table=table, cluster_by=cluster_by,
                          max_records_per_file=max_records_per_file, compression=compression)
        if csv_path is not None:
            load.stage_csv(load.read(table or table_path), csv_path, single_file=csv_single_file,
                           max_records_per_file=max_records_per_file)
    return rows
