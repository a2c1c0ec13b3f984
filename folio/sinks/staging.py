"""Replace tables only when everything that belongs together is ready.

A load writes to staging locations beside its targets and checks what arrived;
until then a failure leaves all targets as they were.  Then it writes an intent
log, puts every result in place, removes the old data and deletes the log.
Placing takes several renames, so the log names each step's source and target, and
every step may be repeated.  When one fails, the load undoes those before it;
if that fails, too, or the driver is gone, ``recover`` finishes the group (or goes on
undoing it), so that after it all targets are the new ones or all the old ones.

A reader may find a path absent between two renames, and where renames copy (object
stores) placing takes as long as a copy.  Appends to catalog tables move files into the
table's location: for Parquet tables without partitions or buckets; by name, as
Parquet is read.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from folio.functions.exprs import column
from folio.sinks.writers import write_csv, write_table


class LoadCountError(RuntimeError):
    """A staged table does not hold the rows its write reported."""


class PendingLoadError(RuntimeError):
    """An earlier load of the same target was cut off; ``recover`` it first."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    if not fs.rename(p, _fs(spark, target)[1]):
        raise OSError(f"could not rename {source} to {target}")


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name first, so that it is there whole or not at all."""
    fs, p = _fs(spark, path + ".part")
    out = fs.create(p, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    _rename(spark, path + ".part", path)


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    size = fs.getFileStatus(p).getLen()
    stream = fs.open(p)
    text = bytes(stream.readNBytes(int(size))).decode("utf-8")
    stream.close()
    return text


def _files(spark: SparkSession, folder: str) -> list[str]:
    """Names of the data files in a folder."""
    fs, p = _fs(spark, folder)
    names = [status.getPath().getName() for status in fs.listStatus(p)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def _sibling(target: str, tag: str) -> str:
    """``a/b/t`` -> ``a/b/_t_<tag>``: a name that Spark's readers of ``a/b`` skip."""
    parent, _, name = target.rstrip("/").rpartition("/")
    return f"{parent}/_{name}_{tag}" if parent else f"_{name}_{tag}"


def _details(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def _location(spark: SparkSession, table: str) -> str:
    return _details(spark, table)["Location"].rstrip("/")


@dataclass
class _Staged:
    target: str
    is_table: bool
    append: bool
    staged: str
    rows: int | None  # None: not a table
    #: What placing finds and does, noted before the first step.
    old: str = ""
    had: bool = False
    files: list[str] = field(default_factory=list)
    into: str = ""


LOG = "_folio_load_"


class _Placing:
    """The steps that put a group in place, or undo that; each may be repeated after a failure."""

    def __init__(self, spark: SparkSession, items: list[_Staged], done=lambda step: None) -> None:
        self.spark, self.items, self.done = spark, items, done

    def _move(self, item: _Staged, source: str, target: str) -> None:
        if item.is_table:
            self.spark.sql(f"ALTER TABLE {source} RENAME TO {target}")
        else:
            _rename(self.spark, source, target)
        self.done(f"rename {source} to {target}")

    def _drop(self, item: _Staged, what: str) -> None:
        if not self._there(item, what):
            return
        if item.is_table:
            self.spark.sql(f"DROP TABLE {what}")
        else:
            delete_path(self.spark, what)
        self.done(f"drop {what}")

    def _there(self, item: _Staged, what: str) -> bool:
        return self.spark.catalog.tableExists(what) if item.is_table else path_exists(self.spark, what)

    def _staged_folder(self, item: _Staged) -> str:
        return _location(self.spark, item.staged) if item.is_table else item.staged

    def finish(self) -> None:
        for item in self.items:
            if item.append and item.had:
                self._append(item)
            elif self._there(item, item.staged):
                if item.had and not self._there(item, item.old):
                    self._move(item, item.target, item.old)
                self._move(item, item.staged, item.target)

    def clean(self) -> None:
        """Remove what is left once every result is in place."""
        for item in self.items:
            if item.append and item.had:
                self._drop(item, item.staged)
            elif item.had:
                self._drop(item, item.old)

    def _append(self, item: _Staged) -> None:
        if not self._there(item, item.staged):
            return
        source = self._staged_folder(item)
        there = set(_files(self.spark, source))
        for name in item.files:
            if name in there:
                _rename(self.spark, f"{source}/{name}", f"{item.into}/{name}")
                self.done(f"move {name} to {item.into}")
        if item.is_table:
            self.spark.catalog.refreshTable(item.target)

    def undo(self) -> None:
        for item in reversed(self.items):
            if item.append and item.had:
                there = set(_files(self.spark, item.into))
                for name in item.files:
                    if name in there:
                        delete_path(self.spark, f"{item.into}/{name}")
                        self.done(f"delete {name} from {item.into}")
                if item.is_table:
                    self.spark.catalog.refreshTable(item.target)
            elif item.had:
                if self._there(item, item.old):  # else it was not begun, or is undone
                    if self._there(item, item.target):
                        self._move(item, item.target, item.staged)
                    self._move(item, item.old, item.target)
            elif self._there(item, item.target) and not self._there(item, item.staged):
                self._move(item, item.target, item.staged)
        for item in self.items:
            self._drop(item, item.staged)


def _logs(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(p)]
    return [f"{folder.rstrip('/')}/{n}" for n in sorted(names) if n.startswith(LOG) and n.endswith(".json")]


def recover(spark: SparkSession, folder: str) -> dict[str, str]:
    """Finish or undo the loads that were cut off while their results were put in place.

    ``folder`` holds the intent logs: ``StagedLoad.log_folder``, by default the one
    beside the first target.  A load that had begun to undo goes on undoing; any
    other is finished, as all its data is staged and counted.  May be
    repeated, also after a failure; not while such a load is running.  Returns each
    log with "finished" or "undone".
    """
    out = {}
    for log in _logs(spark, folder):
        items = [_Staged(**item) for item in json.loads(_read_text(spark, log))]
        placing = _Placing(spark, items)
        undo = log.removesuffix(".json") + ".undo"
        if path_exists(spark, undo):
            placing.undo()
            out[log] = "undone"
        else:
            placing.finish()
            placing.clean()
            out[log] = "finished"
        delete_path(spark, log)
        delete_path(spark, undo)
    return out


class StagedLoad:
    """A group of table loads that take effect together.

        with StagedLoad(spark) as load:
            load.stage(books, path=".../books")
            load.stage(reviews, table="db.reviews", mode="append")
        # both in place; after an exception, neither (or ``recover`` says so)

    ``mode="overwrite"`` replaces the target, ``"append"`` adds the staged
    files to it; its columns must be those of the target, in any order.
    """

    def __init__(self, spark: SparkSession, log_folder: str | None = None) -> None:
        self.spark = spark
        self._tag = uuid.uuid4().hex[:12]
        self._staged: list[_Staged] = []
        self._log_folder = log_folder

    def __enter__(self) -> StagedLoad:
        return self

    def __exit__(self, kind, value, trace) -> None:
        if kind is None:
            self.commit()
        else:
            self.abort()

    def stage(self, df: DataFrame, *, path: str | None = None, table: str | None = None,
              mode: str = "overwrite", **options) -> int:
        """Write ``df`` beside its target (``write_table``'s options); returns its rows."""
        if (path is None) == (table is None):
            raise ValueError("give exactly one of path= or table=")
        if mode not in ("overwrite", "append"):
            raise ValueError("mode must be 'overwrite' or 'append'")
        if table is not None:
            database, _, name = table.rpartition(".")
            staged = f"{database}.{name}__{self._tag}" if database else f"{name}__{self._tag}"
        else:
            staged = _sibling(path, f"staging_{self._tag}")
        item = _Staged(table or path.rstrip("/"), table is not None, mode == "append", staged, 0)
        if item.append and self._exists(item):
            df = self._as_target(df, item)
        self._staged.append(item)
        item.rows = int(write_table(df, **{"table" if item.is_table else "path": staged}, mode="overwrite", **options))
        return item.rows

    def stage_csv(self, df: DataFrame, path: str, **options) -> None:
        """Write a CSV copy beside ``path`` (``write_csv``'s options)."""
        item = _Staged(path.rstrip("/"), False, False, _sibling(path, f"staging_{self._tag}"), None)
        self._staged.append(item)
        write_csv(df, item.staged, **options)

    def read(self, target: str) -> DataFrame:
        """What is staged for a target."""
        item = next(i for i in self._staged if i.target == target.rstrip("/"))
        return self._read(item)

    def _read(self, item: _Staged) -> DataFrame:
        return self.spark.table(item.staged) if item.is_table else self.spark.read.parquet(item.staged)

    def _exists(self, item: _Staged) -> bool:
        return self.spark.catalog.tableExists(item.target) if item.is_table else path_exists(self.spark, item.target)

    def _as_target(self, df: DataFrame, item: _Staged) -> DataFrame:
        """The rows with the target's columns, by name, in its order and of its types."""
        if item.is_table:
            details = _details(self.spark, item.target)
            if details.get("Provider", "").lower() != "parquet" or "# Partition Information" in details \
                    or details.get("Num Buckets", "0") not in ("0", "-1"):
                raise ValueError(f"{item.target}: appends need a Parquet table without partitions or buckets")
        old = self.spark.table(item.target) if item.is_table else self.spark.read.parquet(item.target)
        if sorted(old.columns) != sorted(df.columns):
            raise ValueError(f"cannot append to {item.target}: it has the columns {old.columns}, "
                             f"the load has {df.columns}")
        return df.select(*[column(f.name).cast(f.dataType).alias(f.name) for f in old.schema.fields])

    @property
    def log_folder(self) -> str:
        """Where the intent log goes: beside the first path, or in the first table's database."""
        if self._log_folder is None and self._staged:
            paths = [i.target for i in self._staged if not i.is_table]
            place = paths[0] if paths else _location(self.spark, self._staged[0].staged)
            self._log_folder = place.rpartition("/")[0] or "."
        return self._log_folder or "."

    def commit(self) -> None:
        for item in self._staged:
            if item.rows is None:
                continue
            found = self._read(item).count()  # from the files' footers
            if found != item.rows:
                self.abort()
                raise LoadCountError(f"{item.target}: wrote {item.rows} rows, staged {found}")
        if not self._staged:
            return
        try:
            self._check_pending()
            for item in self._staged:
                self._plan(item)
            log = f"{self.log_folder}/{LOG}{self._tag}.json"
            _write_text(self.spark, log, json.dumps([asdict(i) for i in self._staged]))
        except Exception:
            self.abort()
            raise
        placing = _Placing(self.spark, list(self._staged), self._done)
        self._staged.clear()
        undo = log.removesuffix(".json") + ".undo"
        try:
            placing.finish()
        except Exception:
            _write_text(self.spark, undo, "")
            placing.undo()
            delete_path(self.spark, log)
            delete_path(self.spark, undo)
            raise
        placing.clean()
        delete_path(self.spark, log)

    def _done(self, step: str) -> None:
        """Called after every rename and drop; tests let it fail."""

    def _check_pending(self) -> None:
        mine = {i.target for i in self._staged}
        for log in _logs(self.spark, self.log_folder):
            theirs = {item["target"] for item in json.loads(_read_text(self.spark, log))}
            if mine & theirs:
                raise PendingLoadError(f"{log} names {sorted(mine & theirs)}; run recover() on its folder")

    def _plan(self, item: _Staged) -> None:
        item.had = self._exists(item)
        item.old = f"{item.staged}_old" if item.is_table else _sibling(item.target, f"old_{self._tag}")
        if item.append and item.had:
            item.files = _files(self.spark, _location(self.spark, item.staged) if item.is_table else item.staged)
            item.into = _location(self.spark, item.target) if item.is_table else item.target

    def abort(self) -> None:
        for item in self._staged:
            if item.is_table:
                self.spark.sql(f"DROP TABLE IF EXISTS {item.staged}")
            else:
                delete_path(self.spark, item.staged)
        self._staged.clear()
