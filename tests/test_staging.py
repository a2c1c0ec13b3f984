"""Group loads: failures after every single rename and drop, recovery, and appends by name."""

from __future__ import annotations

import os

import pytest

from folio import cli
from folio.sinks.staging import LOG, PendingLoadError, StagedLoad, recover
from folio.sinks.writers import ensure_database, write_table


class Lost(BaseException):
    """The driver is gone: nothing catches it."""


class Failing(StagedLoad):
    """Fails after step ``at`` and, unless ``once``, after every later one."""

    def __init__(self, spark, at, error, once=False, **kw):
        super().__init__(spark, **kw)
        self.at, self.error, self.once, self.steps = at, error, once, 0

    def _done(self, step):
        self.steps += 1
        if self.steps == self.at or (self.steps > self.at and not self.once):
            raise self.error(step)


def _frame(spark, tag, n=4):
    return spark.range(n).selectExpr("id", f"'{tag}' AS tag").coalesce(1)


def _tags(spark, out):
    found = {}
    for name in ("a", "b", "c", "d"):
        path = f"{out}/{name}"
        found[name] = sorted(r.tag for r in spark.read.parquet(path).distinct().select("tag").distinct().collect()) \
            if os.path.exists(path) else None
    return found


OLD = {"a": ["old"], "b": ["old"], "c": ["old"], "d": None}
NEW = {"a": ["new"], "b": ["new"], "c": ["new", "old"], "d": ["new"]}


def _load(spark, load, out):
    """Two replaced tables, one appended to, one that was not there."""
    with load:
        load.stage(_frame(spark, "new"), path=f"{out}/a")
        load.stage(_frame(spark, "new"), path=f"{out}/b")
        load.stage(_frame(spark, "new").select("tag", "id"), path=f"{out}/c", mode="append")
        load.stage(_frame(spark, "new"), path=f"{out}/d", mode="append")


def _clean(out):
    return sorted(os.listdir(out))


@pytest.mark.parametrize("error, once", [(Lost, False), (OSError, False), (OSError, True)])
def test_all_new_or_all_old_after_a_failure_at_every_step(spark, tmp_out, error, once):
    results, at = [], 0
    while True:
        at += 1
        out = f"{tmp_out}/{at}"
        for name in "abc":
            write_table(_frame(spark, "old"), path=f"{out}/{name}")
        load = Failing(spark, at, error, once)
        try:
            _load(spark, load, out)
        except error:
            recover(spark, out)
            recover(spark, out)
        else:
            assert load.steps < at  # no step left to fail at
            break
        found = _tags(spark, out)
        assert found in (OLD, NEW), (at, found)
        assert _clean(out) == [n for n in "abcd" if found[n] is not None]
        assert spark.read.parquet(f"{out}/c").count() == 4 * len(found["c"])
        results.append(found == NEW)
    assert len(results) == 9  # 2 + 2 renames, 1 moved file, 1 rename, 3 drops
    assert all(results) if error is Lost else results == [False] * 6 + [True] * 3


def test_recovery_may_be_cut_off_too(spark, tmp_out, monkeypatch):
    from folio.sinks import staging

    for undo in (False, True):
        out = f"{tmp_out}/{undo}"
        for name in "abc":
            write_table(_frame(spark, "old"), path=f"{out}/{name}")
        with pytest.raises((Lost, OSError)):
            _load(spark, Failing(spark, 4, OSError if undo else Lost), out)
        real, left = staging._Placing, [1]

        class Cut(real):
            def __init__(self, spark, items):
                def done(step):
                    left[0] += 1
                    if left[0] % 2 == 0:
                        raise Lost(step)
                super().__init__(spark, items, done)

        monkeypatch.setattr(staging, "_Placing", Cut)
        for _ in range(20):
            try:
                recover(spark, out)
                break
            except Lost:
                pass
        monkeypatch.setattr(staging, "_Placing", real)
        assert _tags(spark, out) == (OLD if undo else NEW)
        assert not [n for n in os.listdir(out) if n.startswith("_")]


def test_a_pending_load_blocks_the_next_one_until_recovered(spark, tmp_out, capsys):
    write_table(_frame(spark, "old"), path=f"{tmp_out}/a")
    with pytest.raises(Lost):
        with Failing(spark, 1, Lost) as load:
            load.stage(_frame(spark, "new"), path=f"{tmp_out}/a")
    assert [n for n in os.listdir(tmp_out) if n.startswith(LOG)]
    with pytest.raises(PendingLoadError):
        with StagedLoad(spark) as load:
            load.stage(_frame(spark, "newer"), path=f"{tmp_out}/a")
    assert cli.main(["recover", tmp_out], spark) == 0
    assert "finished" in capsys.readouterr().out
    assert _clean(tmp_out) == ["a"] and _tags(spark, tmp_out)["a"] == ["new"]


def test_appends_to_tables_go_by_name_and_survive_failures(spark, tmp_out):
    ensure_database(spark, "folio_staging", f"{tmp_out}/db")
    try:
        for at in range(1, 5):
            name = f"folio_staging.t{at}"
            write_table(_frame(spark, "old"), table=name)
            try:
                with Failing(spark, at, Lost) as load:
                    load.stage(_frame(spark, "new").selectExpr("tag", "CAST(id AS INT) AS id"), table=name, mode="append")
                    load.stage(_frame(spark, "new"), table=f"{name}_other")
            except Lost:
                assert set(recover(spark, f"{tmp_out}/db").values()) == {"finished"}
            rows = sorted(map(tuple, spark.table(name).collect()))
            assert rows == sorted((i, t) for i in range(4) for t in ("new", "old"))
            assert spark.table(f"{name}_other").count() == 4
        assert all("__" not in t.name for t in spark.catalog.listTables("folio_staging"))
        with pytest.raises(ValueError, match="cannot append"):
            with StagedLoad(spark) as load:
                load.stage(_frame(spark, "new").drop("tag"), table="folio_staging.t1", mode="append")
        write_table(_frame(spark, "old"), table="folio_staging.buckets", bucket_by=(2, ["id"]))
        with pytest.raises(ValueError, match="buckets"):
            with StagedLoad(spark) as load:
                load.stage(_frame(spark, "new"), table="folio_staging.buckets", mode="append")
    finally:
        spark.sql("DROP DATABASE folio_staging CASCADE")
