"""Splitting quoted-newline CSV files over tasks, and files with headers of their own."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio import config as C
from folio.operators.shaping import DuplicateHeaderError
from folio.plans.jobs import ingest_job
from folio.sources import csv_split as S
from folio.sources.csv import read_csv_table

PIECES = ["a", "bb", ",", '"', "\n", "\n\n", "x y", '5" disk', '""', "é", "\\", '"\n"', " ", " ", "\u0085"]
NAMES = ("Title", "authors", "publisher")
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("title", "authors", "publisher")])


def _field(rng, text):
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in ',"\n') or rng.random() < 0.3 else text


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng, path = random.Random(4), tmp_path_factory.mktemp("split") / "in"
    path.mkdir()
    for f in range(3):
        with open(path / f"f{f}.csv", "w", newline="", encoding="utf-8") as out:
            out.write(",".join(NAMES) + "\n")
            for i in range(250):
                row = [f"{f}{i:05d}", *("".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 12))) for _ in "ab")]
                fields = [_field(rng, x) for x in row]
                if rng.random() < 0.1:
                    fields[1] = 'a 5" disk'  # quotes that do not open a field
                if rng.random() < 0.04:
                    fields[2] = '"' + "long, \n" * rng.randrange(1, 1500) + '"'
                out.write(",".join(fields) + rng.choice(["\n", "\n", "\n\n"]))
            if f == 1:
                out.write("last,without,")  # no line break at the end
    return str(path)


@pytest.fixture
def splits_of(spark):
    """Sets the size of splits for one test."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}

    def use(size):
        for k, v in zip(keys, (size, "1")):
            spark.conf.set(k, v)
    yield use
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", ["6k", "128m"])
def test_rows_equal_the_one_task_read_in_order(spark, folder, splits_of, size):
    whole = read_csv_table(spark, folder, SCHEMA).frame.collect()
    splits_of(size)
    found = read_csv_table(spark, folder, SCHEMA, multi_line="split", row_order_col="n").frame.orderBy("n").collect()
    assert sorted(map(str, (tuple(r)[:3] for r in found))) == sorted(map(str, map(tuple, whole)))
    assert [r.n for r in found] == list(range(len(whole)))
    titles = [r.title for r in found if r.title != "last"]
    assert titles == sorted(titles)


def test_many_tasks_read_one_file(spark, folder, splits_of):
    splits_of("8k")
    frame = read_csv_table(spark, f"{folder}/f0.csv", SCHEMA, multi_line="split").frame
    assert frame.select(F.spark_partition_id().alias("p")).distinct().count() > 4


def test_without_broadcast_rows_and_order_are_the_same(spark, folder, splits_of, monkeypatch):
    splits_of("8k")
    one = read_csv_table(spark, folder, SCHEMA, multi_line="split", row_order_col="n").frame.collect()
    monkeypatch.setattr(S, "MAX_BROADCAST_SPLITS", 0)
    two = read_csv_table(spark, folder, SCHEMA, multi_line="split", row_order_col="n").frame.collect()
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_changed_splits_raise(spark, folder, splits_of):
    splits_of("4k")
    frame = read_csv_table(spark, folder, SCHEMA, multi_line="split").frame
    splits_of("8k")
    with pytest.raises(PySparkException, match="changed between two reads"):
        frame.select("title").collect()


@pytest.mark.parametrize("line, opens", [
    ('a,"b', True), ('a,"b""', True), ('a,"b"', False), ('a,b"c', False), ('"', True), ('""', False), ('"""', True),
    ('"a"b,"c', True), ('"a"b"c', False), (',,"x, ""y""', True), ('a"b,"c', True), ('"a,b",', False), (' "a', False),
    ('"' * 20001, True), ('"' + 'x""' * 30000, True), ('a,' * 30000 + '"', True)])
def test_which_lines_open_a_field(spark, line, opens):
    frame = spark.createDataFrame([(line.replace('""', ""),)], "value string")
    assert frame.select(F.col("value").rlike(S.open_pattern())).first()[0] is opens


def test_states_follow_the_lines_one_by_one():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.random((2, rng.integers(1, 12))) < 0.5
        for start in (False, True):
            state, expected = start, []
            for x, y in zip(a, b):
                state = bool(y if state else x)
                expected.append(state)
            assert S._states(a, b, start).tolist() == expected


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


def test_each_file_is_mapped_by_its_own_header(spark, tmp_out):
    _write(f"{tmp_out}/in/a.csv", "Title,authors,publisher\nT1,A1,P1\n")
    _write(f"{tmp_out}/in/b.csv", "authors,Title,bogus\nA2,T2,x\n")
    _write(f"{tmp_out}/in/c.csv", '﻿"pub,1",publisher,Title\r\n"1\r\n2",P3,"T\r\n3"\r\n')
    _write(f"{tmp_out}/in/d.csv", "Title,authors,publisher\n")
    proj = read_csv_table(spark, f"{tmp_out}/in", SCHEMA, multi_line="split")
    assert sorted(map(tuple, proj.frame.collect())) == [("T\n3", None, "P3"), ("T1", "A1", "P1"), ("T2", "A2", None)]
    files = {os.path.basename(r.file): (r.missing, r.dropped) for r in proj.files.collect()}
    assert files == {"a.csv": ([], []), "b.csv": (["publisher"], ["bogus"]), "c.csv": (["authors"], ["pub,1"]),
                     "d.csv": ([], [])}
    assert proj.missing == [] and sorted(proj.dropped) == ["bogus", "pub,1"]


def test_the_one_task_read_never_maps_by_position(spark, tmp_out):
    _write(f"{tmp_out}/in/a.csv", "Title,authors,publisher\nT1,A1,P1\n")
    _write(f"{tmp_out}/in/b.csv", "authors,Title,publisher\nA2,T2,P2\n")
    for multi_line in (True, False):
        with pytest.raises(Exception, match="FAILED_READ_FILE"):
            read_csv_table(spark, f"{tmp_out}/in", SCHEMA, multi_line=multi_line).frame.collect()


def test_headers_that_repeat_raise_and_missing_input_is_skipped(spark, tmp_out):
    _write(f"{tmp_out}/in/a.csv", "Title,title\na,b\n")
    with pytest.raises(DuplicateHeaderError):
        read_csv_table(spark, f"{tmp_out}/in", SCHEMA, multi_line="split")
    gone = read_csv_table(spark, f"{tmp_out}/none", SCHEMA, multi_line="split", on_missing="skip")
    assert not gone.found and gone.frame.count() == 0
    with pytest.raises(PySparkException):
        read_csv_table(spark, f"{tmp_out}/none", SCHEMA, multi_line="split")


def test_wide_and_short_rows_by_the_header_of_their_file(spark, tmp_out):
    _write(f"{tmp_out}/in/a.csv", "Title,authors\nT1,A1,surplus\nT2,A2\nT3\n")
    _write(f"{tmp_out}/in/b.csv", 'Title,authors,publisher\nT4,A4\nT5,"A\n5",P5\nT6,A6,P6,"x,y"\n')
    widths = Observation("split_widths")
    proj = read_csv_table(spark, f"{tmp_out}/in", SCHEMA, multi_line="split", malformed="permissive", widths=widths)
    rows = sorted(map(tuple, proj.frame.collect()))
    assert rows == [("T1", "A1", None), ("T2", "A2", None), ("T3", None, None), ("T4", "A4", None),
                    ("T5", "A\n5", "P5"), ("T6", "A6", "P6")]
    assert widths.get == {"wide_rows": 2, "short_rows": 2}
    for malformed in ("fail", "strict"):
        with pytest.raises(Exception, match="row with more than|MALFORMED_RECORD"):
            read_csv_table(spark, f"{tmp_out}/in", SCHEMA, multi_line="split", malformed=malformed).frame.collect()


def test_load_order_over_many_files_does_not_depend_on_splits(spark, tmp_out, folder, splits_of):
    orders = []
    for n, size in enumerate(("8k", "300k")):
        splits_of(size)
        found = ingest_job(spark, {"books_data": (folder, C.CATALOG_SCHEMA)}, f"{tmp_out}/{n}", multi_line="split")
        table = spark.read.parquet(f"{tmp_out}/{n}/books_data")
        orders.append(sorted((r[C.ROW_ORDER], r.title) for r in table.collect()))
        assert found.files["books_data"].count() == 3
    assert orders[0] == orders[1] and [n for n, _ in orders[0]] == list(range(len(orders[0])))


@pytest.mark.parametrize("sep", [",", "\t"])
def test_lines_with_one_quote_need_no_slow_test(spark, tmp_path, monkeypatch, sep):
    rng, slow = random.Random(3), S.open_pattern(sep)
    lines = ["".join(rng.choice(['"', '""', sep, "a", " ", "é"]) for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    (tmp_path / "a.csv").write_text("\n".join(lines), encoding="utf-8")

    def found():
        return {r["value"]: (r["open_out"], r["open_in"]) for r in S._lines(spark, str(tmp_path), sep).collect()}

    frame = spark.createDataFrame([(x, x.replace('""', "")) for x in set(lines)], "value string, quoted string")
    want = {r["value"]: (r["a"], r["b"]) for r in frame.select(
        "value", F.col("quoted").rlike(slow).alias("a"), F.concat(F.lit('"'), "quoted").rlike(slow).alias("b")).collect()}
    assert found() == {v: want[v] if '"' in v.replace('""', "") else (False, True) for v in lines}
    monkeypatch.setattr(S, "open_pattern", lambda sep: r"\A(?!)")
    assert all(own == want[v] for v, own in found().items() if v.replace('""', "").count('"') == 1)
