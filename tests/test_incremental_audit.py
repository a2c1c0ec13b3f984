"""Audits from stored partials: equal to the full audit, and earlier loads are not read."""

from __future__ import annotations

import glob

import pytest

from folio import config as C
from folio.operators.shaping import align_to_schema
from folio.plans.jobs import audit_job, incremental_audit_job
from folio.sinks.writers import write_table


def _frames(spark, n, seed):
    ids = spark.range(n)
    books = ids.selectExpr(f"IF(id % 7 = 0, NULL, concat('T', id % 5 + {seed})) AS title",
                           "IF(id % 3 = 0, NULL, 'A') AS authors")
    ratings = ids.selectExpr("concat('T', id % 9) AS title", "IF(id % 4 = 0, NULL, 'u') AS user_id",
                             f"IF(id % 5 = 0, NULL, CAST(id % 8 AS DOUBLE) + {seed} * 0.25) AS review_score",
                             f"IF(id % 6 = 0, NULL, IF(id % 11 = 1, 900000000000000000, id * 86400 * {seed + 1})) AS review_time")
    return align_to_schema(books, C.CATALOG_SCHEMA), align_to_schema(ratings, C.REVIEW_SCHEMA)


def _add(spark, out, n, seed, mode="append"):
    for name, frame in zip(("b", "r"), _frames(spark, n, seed)):
        write_table(frame, path=f"{out}/{name}", mode=mode)


def _told(result):
    key = lambda r: str(r)
    return (result.passed, result.gate, result.out_of_range, sorted(map(str, result.report.collect()), key=key),
            result.date_range.collect(), result.times_out_of_range, result.scores_not_exact)


def _both(spark, out):
    state = f"{out}/state"
    found = _told(incremental_audit_job(spark, f"{out}/b", f"{out}/r", state))
    full = _told(audit_job(spark, spark.read.parquet(f"{out}/b"), spark.read.parquet(f"{out}/r")))
    return found, full


def test_equal_to_the_full_audit_after_appends_and_a_replacement(spark, tmp_out):
    for n, seed, mode in ((50, 0, "append"), (37, 1, "append"), (37, 1, "append"), (20, 2, "overwrite"), (0, 3, "append")):
        _add(spark, tmp_out, n, seed, mode)
        found, full = _both(spark, tmp_out)
        assert found == full
    again, _ = _both(spark, tmp_out)
    assert again == found


def test_earlier_loads_are_not_opened(spark, tmp_out):
    _add(spark, tmp_out, 60, 0)
    incremental_audit_job(spark, f"{tmp_out}/b", f"{tmp_out}/r", f"{tmp_out}/state")
    old = glob.glob(f"{tmp_out}/[br]/part-*")
    _add(spark, tmp_out, 45, 1)
    full = _told(audit_job(spark, spark.read.parquet(f"{tmp_out}/b"), spark.read.parquet(f"{tmp_out}/r")))
    for name in old:  # no reader could make rows of these any more
        with open(name, "r+b") as f:
            f.truncate(0)
            f.write(b"not parquet")
    assert _told(incremental_audit_job(spark, f"{tmp_out}/b", f"{tmp_out}/r", f"{tmp_out}/state")) == full


def test_an_audit_cut_off_before_its_list_is_whole_is_repeated(spark, tmp_out, monkeypatch):
    _add(spark, tmp_out, 30, 0)
    _both(spark, tmp_out)
    _add(spark, tmp_out, 31, 1)
    real = spark.createDataFrame

    def fails(data, *args, **kw):
        if args and args[0] == "file string":
            raise OSError("cut off")
        return real(data, *args, **kw)

    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, *a, **k: fails(*a, **k))
    with pytest.raises(OSError):
        incremental_audit_job(spark, f"{tmp_out}/b", f"{tmp_out}/r", f"{tmp_out}/state")
    monkeypatch.undo()
    found, full = _both(spark, tmp_out)
    assert found == full
