"""Command line: ``python -m folio <command>``, or ``spark-submit folio/__main__.py <command>``.

    load   --books CSV --ratings CSV TABLES [--report-dir DIR] [--append] [--skip-missing]
           [--no-load-order] [--strict | --permissive] [--split-files | --no-line-breaks] [--no-fail]
    ingest as load, without the audit and its options
    audit  TABLES [--report-dir DIR] [--fail]
    etl    TABLES (--out DIR | --out-table NAME) [--csv DIR [--csv-single-file]]
           [--max-reviews N --review-order COL,...]
           [--null-keys match|drop] [--keep-null-scores] [--catalog-order COL,...]
           [--sample-buckets N [--sample-keys COL,...]]
           [--cluster-by COL,...] [--compression CODEC] [--max-records-per-file N]

    recover FOLDER   finish or undo the loads cut off while they were put in place

TABLES is ``--tables DIR`` (Parquet folders ``DIR/books_data`` and
``DIR/books_rating``) or ``--database NAME`` (catalog tables).  They carry their
load order, by which ``etl`` keeps the first catalog row as loaded.
The session comes from ``SparkSession.builder.getOrCreate()``, so cluster
settings given to ``spark-submit`` apply.  Exit status 1 when the volume
gate fails (where asked) or a step raises.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date

from pyspark.sql import SparkSession

from folio import config as C
from folio.plans.jobs import (AuditResult, VolumeGateError, audit_job, etl_job, ingest_and_audit, ingest_job,
                              report_path_for)
from folio.session import configure
from folio.sinks.staging import recover
from folio.sources.tables import read_table


def _tables(spark: SparkSession, args: argparse.Namespace):
    return [read_table(spark, table=f"{args.database}.{name}") if args.database
            else read_table(spark, path=f"{args.tables.rstrip('/')}/{name}")
            for name in ("books_data", "books_rating")]


def _audited(aud: AuditResult) -> dict[str, object]:
    dates = aud.date_range.first()
    return {"gate": aud.gate, "passed": aud.passed, "out_of_range": aud.out_of_range,
            "date_range": {k: str(v) if isinstance(v, date) else v for k, v in dates.asDict().items()},
            "times_out_of_range": aud.times_out_of_range, "scores_not_exact": aud.scores_not_exact}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="folio", description="Review-data curation on Spark")
    sub = p.add_subparsers(dest="command", required=True)

    def table_args(q):
        place = q.add_mutually_exclusive_group(required=True)
        place.add_argument("--tables", help="folder of the Parquet tables")
        place.add_argument("--database", help="catalog database of the tables")

    def ingest_args(q):
        q.add_argument("--books", required=True, help="catalog CSV file or folder")
        q.add_argument("--ratings", required=True, help="reviews CSV file or folder")
        table_args(q)
        q.add_argument("--append", action="store_true", help="append instead of replacing")
        q.add_argument("--skip-missing", action="store_true", help="skip absent inputs")
        width = q.add_mutually_exclusive_group()
        width.add_argument("--strict", action="store_const", dest="malformed", const="strict", default="fail",
                           help="fail on rows with too few fields, too")
        width.add_argument("--permissive", action="store_const", dest="malformed", const="permissive",
                           help="cut rows with too many fields instead of failing")
        lines = q.add_mutually_exclusive_group()
        lines.add_argument("--split-files", action="store_const", dest="multi_line", const="split", default=True,
                           help="split files over many tasks, and map each by its own header")
        lines.add_argument("--no-line-breaks", action="store_const", dest="multi_line", const=False,
                           help="no field holds a line break: files may be split")
        q.add_argument("--no-load-order", action="store_true", help="do not keep the rows' load order")

    load = sub.add_parser("load", help="ingest, then audit with the volume gate")
    ingest_args(load)
    load.add_argument("--report-dir")
    load.add_argument("--no-fail", action="store_true", help="report a failed gate, exit 0")
    ingest_args(sub.add_parser("ingest", help="CSV -> typed Parquet tables"))

    audit = sub.add_parser("audit", help="quality report and volume gate")
    table_args(audit)
    audit.add_argument("--report-dir")
    audit.add_argument("--fail", action="store_true", help="exit 1 when the gate fails")

    etl = sub.add_parser("etl", help="curated dataset: Parquet table and CSV copy")
    table_args(etl)
    out = etl.add_mutually_exclusive_group(required=True)
    out.add_argument("--out", help="folder of the curated table")
    out.add_argument("--out-table", help="name of the curated table in the catalog")
    etl.add_argument("--csv")
    etl.add_argument("--csv-single-file", action="store_true",
                     help="write the CSV copy as one file (small outputs)")
    etl.add_argument("--max-reviews", type=int)
    etl.add_argument("--review-order", help="comma-separated total order for --max-reviews")
    etl.add_argument("--sample-buckets", type=int,
                     help="keep 1/N of the reviews by key hash (see --sample-keys)")
    etl.add_argument("--sample-keys", default="id", help="comma-separated hash keys for sampling")
    etl.add_argument("--catalog-order", help="comma-separated order picking the first catalog row")
    etl.add_argument("--null-keys", choices=("match", "drop"), default="match")
    etl.add_argument("--keep-null-scores", action="store_true", help="do not fill NULL scores")
    etl.add_argument("--cluster-by", help="comma-separated columns to sort rows by within files")
    etl.add_argument("--compression", help="Parquet codec, e.g. zstd")
    etl.add_argument("--max-records-per-file", type=int)

    cut = sub.add_parser("recover", help="finish or undo loads that were cut off")
    cut.add_argument("folder", help="folder of the tables, with the loads' intent logs")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = configure(spark or SparkSession.builder.appName(f"folio-{args.command}").getOrCreate())
    if args.command in ("ingest", "load"):
        options = {"database": args.database, "truncate_first": not args.append,
                   "on_missing": "skip" if args.skip_missing else "fail", "malformed": args.malformed,
                   "multi_line": args.multi_line, "load_order": not args.no_load_order}
    try:
        if args.command == "ingest":
            res = ingest_job(spark, {"books_data": (args.books, C.CATALOG_SCHEMA),
                                     "books_rating": (args.ratings, C.REVIEW_SCHEMA)},
                             args.tables, **options)
            print(json.dumps({"counts": res.counts, "total": res.total,
                              "dropped_headers": res.dropped_headers,
                              "rejected_values": res.rejected_values,
                              "wide_rows": res.wide_rows, "short_rows": res.short_rows}))
        elif args.command == "load":
            res, aud = ingest_and_audit(spark, args.books, args.ratings, args.tables,
                                        report_dir=args.report_dir, raise_on_fail=not args.no_fail, **options)
            print(json.dumps({"counts": res.counts, **_audited(aud)}))
        elif args.command == "recover":
            print(json.dumps({"recovered": recover(spark, args.folder)}))
        elif args.command == "audit":
            books, ratings = _tables(spark, args)
            path = report_path_for(args.report_dir) if args.report_dir else None
            aud = audit_job(spark, books, ratings, report_path=path, raise_on_fail=args.fail)
            print(json.dumps({**_audited(aud), "report": path}))
        elif args.command == "etl":
            books, ratings = _tables(spark, args)
            fills = dict(C.DEFAULT_FILLS)
            if args.keep_null_scores:
                fills["review_score"] = None
            rows = etl_job(spark, books, ratings, table_path=args.out, table=args.out_table, csv_path=args.csv,
                           catalog_order=args.catalog_order.split(",") if args.catalog_order else None,
                           null_keys=args.null_keys, fills=fills, max_reviews=args.max_reviews,
                           review_order=args.review_order.split(",") if args.review_order else None,
                           review_sample=(args.sample_keys.split(","), args.sample_buckets)
                           if args.sample_buckets else None,
                           cluster_by=args.cluster_by.split(",") if args.cluster_by else (),
                           compression=args.compression,
                           csv_single_file=args.csv_single_file,
                           max_records_per_file=args.max_records_per_file)
            print(json.dumps({"curated_rows": rows, "table": args.out or args.out_table, "csv": args.csv}))
    except VolumeGateError as exc:
        print(json.dumps({"error": str(exc)}), file=sys.stderr)
        return 1
    return 0
