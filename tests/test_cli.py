from __future__ import annotations

import json
import os

from folio.cli import main

BOOKS = ("Title,authors,categories,publisher\n"
         "T1,A,Fiction,P\nT1,B,Drama,P\nT2,C,,Q\n")
RATINGS = ("Id,Title,review/score,review/time,User_id,review/summary,review/text\n"
           "1,T1,5,0,u1,s,t\n2,T2,,86400,u2,s,t\n3,T9,4,86400,u3,s,t\n4,,3,,u4,s,t\n")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_cli_load_audit_etl(spark, tmp_out, capsys):
    books = _write(f"{tmp_out}/raw/books_data.csv", BOOKS)
    ratings = _write(f"{tmp_out}/raw/Books_rating.csv", RATINGS)
    tables = f"{tmp_out}/tables"
    # the default gate (100,000 / 10,000 rows) fails on four reviews: exit 1
    assert main(["load", "--books", books, "--ratings", ratings, "--tables", tables], spark) == 1
    assert main(["load", "--books", books, "--ratings", ratings, "--tables", tables,
                 "--report-dir", f"{tmp_out}/rep", "--no-fail"], spark) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["counts"] == {"books_data": 3, "books_rating": 4} and out["passed"] is False
    assert main(["audit", "--tables", tables], spark) == 0
    assert main(["audit", "--tables", tables, "--fail"], spark) == 1
    capsys.readouterr()
    assert main(["etl", "--tables", tables, "--out", f"{tmp_out}/cur", "--csv", f"{tmp_out}/csv",
                 "--csv-single-file", "--catalog-order", "authors"], spark) == 0
    assert len([f for f in os.listdir(f"{tmp_out}/csv") if f.endswith(".csv")]) == 1
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["curated_rows"] == 2          # T1 and T2 match; T9 orphan; NULL has no catalog row
    cur = {r.title: r for r in spark.read.parquet(f"{tmp_out}/cur").collect()}
    assert cur["T1"].authors == "A" and cur["T2"].review_score == 0.0
    assert cur["T2"].categories == "Unknown"
    assert main(["etl", "--tables", tables, "--out", f"{tmp_out}/cur2", "--max-reviews", "1",
                 "--review-order", "id", "--keep-null-scores"], spark) == 0
    assert spark.read.parquet(f"{tmp_out}/cur2").count() == 1


def test_cli_keeps_the_first_row_as_loaded(spark, tmp_out, capsys):
    books = _write(f"{tmp_out}/raw2/books_data.csv", BOOKS)
    ratings = _write(f"{tmp_out}/raw2/Books_rating.csv", RATINGS)
    tables = f"{tmp_out}/tables2"
    assert main(["ingest", "--books", books, "--ratings", ratings, "--tables", tables], spark) == 0
    assert main(["etl", "--tables", tables, "--out", f"{tmp_out}/cur3", "--cluster-by", "title",
                 "--compression", "zstd"], spark) == 0
    cur = {r.title: r.authors for r in spark.read.parquet(f"{tmp_out}/cur3").collect()}
    assert cur == {"T1": "A", "T2": "C"}     # T1's first row in the file has author A


def test_cli_etl_hash_sample(spark, tmp_out, capsys):
    books = _write(f"{tmp_out}/raw3/books_data.csv", BOOKS)
    ratings = _write(f"{tmp_out}/raw3/Books_rating.csv", RATINGS)
    tables = f"{tmp_out}/tables3"
    assert main(["ingest", "--books", books, "--ratings", ratings, "--tables", tables], spark) == 0
    sizes = []
    for b in (1, 2):
        out = f"{tmp_out}/s{b}"
        assert main(["etl", "--tables", tables, "--out", out, "--sample-buckets", str(b)], spark) == 0
        sizes.append(spark.read.parquet(out).count())
    assert sizes[0] == 2 and sizes[1] <= 2


def test_cli_database_and_date_range(spark, tmp_out, capsys):
    import json
    books = _write(f"{tmp_out}/raw4/books_data.csv", BOOKS)
    ratings = _write(f"{tmp_out}/raw4/Books_rating.csv", RATINGS)
    spark.sql(f"CREATE DATABASE folio_cli LOCATION '{tmp_out}/folio_cli'")
    try:
        assert main(["load", "--books", books, "--ratings", ratings, "--database", "folio_cli", "--no-fail"], spark) == 0
        told = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
        assert told["date_range"]["primera_resena"] <= told["date_range"]["ultima_resena"]
        assert main(["etl", "--database", "folio_cli", "--out-table", "folio_cli.curated"], spark) == 0
        assert spark.table("folio_cli.curated").count() == 2
    finally:
        spark.sql("DROP DATABASE IF EXISTS folio_cli CASCADE")
