"""CSV files with line breaks in quoted fields, each read by many tasks.

Spark's ``multiLine`` reader gives a file to one task, because a split cannot
tell whether it starts inside quotes.  Here the files are read as lines, which
Spark splits, and a scan over the splits finds that out:

1. Each line is a function from "starts inside quotes" to "ends inside quotes"
   (two tests by regular expression, for lines with a quote).  A task composes
   its lines' functions for each of its splits, and counts the records that start there, for
   both ways the split may start.
2. A prefix scan over the splits, one row each, gives every split its true start,
   and the number of records before it.
3. Tasks read the lines again, join those of a record and number the records.
   Records that cross a split's border are joined from the lines at its ends.

Quotes open a field only at its start, so quotes within unquoted fields do not
matter.  Rows are numbered by file name, then place, whatever the splits; each
file's own header names its columns, so files may differ in their order.

Lines end with ``\\n`` or ``\\r\\n``, also inside quotes (read as ``\\n``); files
are UTF-8.  Empty lines between records are skipped.  A split never becomes a
group of its own: only lines at the border of two splits are shuffled.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.session import scratch_path

#: Beyond this many splits (at about 100 bytes each) their starts are joined by a shuffle.
MAX_BROADCAST_SPLITS = 200_000
#: Different header lines in one folder.
MAX_HEADERS = 500
PLACE, HEADER_NO, RECORD_TEXT = "__place", "__header_no", "__text"

_SUMMARY = ("file string, start long, length long, first long, n_lines long, open_out boolean, open_in boolean, "
            "n_out long, n_in long, head_in long, tail_out long, tail_in long, header string")


def open_pattern(sep: str = ",") -> str:
    """Matches a line without doubled quotes that, read from outside quotes, ends inside a quoted field."""
    s = re.escape(sep) if sep != "\t" else "\\t"
    return f'\\A(?:(?:"[^"]*+"[^{s}]*+|[^"{s}][^{s}]*+|){s})*+"[^"]*+\\z'


def _lines(spark: SparkSession, path: str | list[str], sep: str) -> DataFrame:
    meta = F.col("_metadata")
    value = F.regexp_replace("value", "\r\\z", "")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("start"),
        meta["file_block_length"].alias("length"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("line"),
        F.when(F.col("value").endswith("\r"), value).otherwise(F.col("value")).alias("value"))
    # A pair of quotes changes no state, wherever it stands: it is an escaped quote, an empty field or plain text.
    # Without pairs, few lines have a quote left for the slow test.
    lines = lines.withColumn("quoted", F.when(F.contains("value", F.lit('"')), F.replace("value", F.lit('""'), F.lit(""))))
    quotes, pattern = F.coalesce(F.contains("quoted", F.lit('"')), F.lit(False)), open_pattern(sep)
    # Of those, most have one quote, which opens a field at its start or closes the one that began before.
    ends = [F.octet_length(F.substring_index("quoted", '"', side)) for side in (1, -1)]
    lines = lines.withColumn("quotes", F.when(~quotes, 0).when(ends[0] + ends[1] + 1 == F.octet_length("quoted"), 1).otherwise(2))
    opens = F.col("quoted").startswith('"') | F.contains("quoted", F.lit(f'{sep}"'))
    return lines.select(
        "*", F.when(F.col("quotes") == 0, False).when(F.col("quotes") == 1, opens)
        .otherwise(F.col("quoted").rlike(pattern)).alias("open_out"),
        F.when(F.col("quotes") == 0, True).when(F.col("quotes") == 1, False)
        .otherwise(F.concat(F.lit('"'), "quoted").rlike(pattern)).alias("open_in")).drop("quoted", "quotes")


def _states(open_out: np.ndarray, open_in: np.ndarray, start: bool) -> np.ndarray:
    """Whether each line ends inside quotes, for lines that begin in state ``start``."""
    flips = np.cumsum(open_out & ~open_in)
    fixed = open_out == open_in
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(fixed)), -1))
    known = np.maximum(last, 0)
    odd = (flips & 1).astype(bool)
    return np.where(last >= 0, open_out[known] ^ odd ^ odd[known], start ^ odd)


def _before(after: np.ndarray, start: bool) -> np.ndarray:
    return np.concatenate([[start], after[:-1]])


def _flags(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(bool)


class _Way:
    """One way to read a split, streamed: begun inside quotes, or not."""

    def __init__(self, start: bool) -> None:
        self.state, self.records, self.head, self.tail = start, 0, 0, 0

    def take(self, open_out: np.ndarray, open_in: np.ndarray, empty: np.ndarray) -> np.ndarray:
        """Counts the lines; returns which of them start a record."""
        after = _states(open_out, open_in, self.state)
        starts = ~_before(after, self.state) & ~empty
        at = np.flatnonzero(starts)
        if not self.records:
            self.head += int(at[0]) if len(at) else len(after)
        self.tail = len(after) - int(at[-1]) if len(at) else self.tail + len(after)
        self.records += len(at)
        self.state = bool(after[-1])
        return starts


def _segments(batch: pa.RecordBatch, key: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of one split."""
    keys = batch.column(key).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)])


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a split; splits of one task come one after the other."""
    now: tuple | None = None
    out: dict | None = None
    ways: list[_Way] = []

    def row() -> pa.RecordBatch:
        a, b = ways
        open_a, open_b = a.state and a.records > 0, b.state and b.records > 0
        values = [*now, out["first"], out["n"], a.state, b.state, a.records, b.records, b.head,
                  a.tail if open_a else 0, b.tail if open_b else 0, out["header"]]
        types = [pa.string()] + [pa.int64()] * 4 + [pa.bool_()] * 2 + [pa.int64()] * 5 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)],
                                          names=[x.split(" ")[0] for x in _SUMMARY.split(", ")])

    for batch in batches:
        if not batch.num_rows:
            continue
        for low, high in _segments(batch, 8):
            part = batch.slice(low, high - low)
            key = tuple(part.column(k)[0].as_py() for k in range(3))
            if key != now:
                if now is not None:
                    yield row()
                now, ways = key, [_Way(False), _Way(True)]
                out = {"first": part.column(3)[0].as_py(), "n": 0, "header": None}
            a, b, empty = (_flags(part.column(k)) for k in (4, 5, 6))
            begun = ways[0].records
            first = ways[0].take(a, b, empty)
            ways[1].take(a, b, empty)
            if key[1] == 0 and not begun and first.any():  # a header that fills a whole batch is not one
                at = np.flatnonzero(first)
                end = at[1] if len(at) > 1 else len(first)
                out["header"] = "\n".join(part.column(7).slice(at[0], end - at[0]).to_pylist()).rstrip("\n")
            out["n"] += len(a)
    if now is not None:
        yield row()


def _join_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that start and end within a split; a file's first one is its header and left out."""
    now, state, number, pending = None, False, 0, []
    header_no, base, first_split = 0, 0, False

    def records(texts: pa.Array) -> pa.RecordBatch:
        nonlocal number
        place = base + number + np.arange(len(texts))
        skip = int(first_split and number == 0 and len(texts) > 0)
        number += len(texts)
        n = len(texts) - skip
        return pa.RecordBatch.from_arrays(
            [pa.array(place[skip:], pa.int64()), pa.array(np.full(n, header_no), pa.int32()),
             texts.slice(skip).cast(pa.string())], names=[PLACE, HEADER_NO, RECORD_TEXT])

    def closed() -> Iterator[pa.RecordBatch]:
        if pending and not state:
            yield records(pa.array(["\n".join(pending)]))

    for batch in batches:
        for low, high in _segments(batch, 0) if batch.num_rows else ():
            part = batch.slice(low, high - low)
            if part.column(0)[0].as_py() != now:
                yield from closed()
                now, pending, number = part.column(0)[0].as_py(), [], 0
                state, base, header_no, first_split = (part.column(k)[0].as_py() for k in (1, 2, 3, 4))
            a, b = _flags(part.column(5)), _flags(part.column(6))
            lines = part.column(7)
            after = _states(a, b, state)
            before = _before(after, state)
            starts = ~before & (pc.binary_length(lines).to_numpy(zero_copy_only=False) > 0)
            state = bool(after[-1])
            at = np.flatnonzero(starts)
            head = int(at[0]) if len(at) else len(a)
            if pending:
                pending += lines.slice(0, head).filter(pa.array(before[:head])).to_pylist()
            if not len(at):
                continue
            content = np.flatnonzero((starts | before)[head:]) + head
            own = lines.take(pa.array(content))
            cuts = np.flatnonzero(starts[content])
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), own), "\n")  # all but the last
            if pending:
                yield records(pa.array(["\n".join(pending)]))
            if len(joined):
                yield records(joined)
            pending = own.slice(cuts[-1]).to_pylist()
    yield from closed()


class Records(NamedTuple):
    """``rows``: (PLACE, HEADER_NO, RECORD_TEXT) of every record but the headers; ``headers``: the names by HEADER_NO.

    ``files``: (file, HEADER_NO).
    """

    rows: DataFrame
    headers: list[list[str]]
    files: DataFrame


def _safe_names(header: str, sep: str) -> list[str]:
    """Header names; empty ones and those that repeat up to case get their position, as Spark's reader does it."""
    names = next(csv.reader([header.removeprefix("\ufeff")], delimiter=sep), [])
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def read_records(spark: SparkSession, path: str | list[str], sep: str = ",") -> Records:
    """All records of the files as text, numbered in the order of files and places.

    The scan over the splits runs here; the rows are read when they are used.
    """
    lines = _lines(spark, path, sep)
    scratch = scratch_path(spark, "csv-splits")
    (lines.select("file", "start", "length", "line", "open_out", "open_in", (F.col("value") == "").alias("empty"),
                  F.when(F.col("start") == 0, F.col("value")).alias("value"), F.xxhash64("file", "start").alias("split"))
     .mapInArrow(_summarise, _SUMMARY).write.parquet(f"{scratch}/summaries"))
    summaries = spark.read.schema(_SUMMARY).parquet(f"{scratch}/summaries")

    texts = [r[0] for r in summaries.where("header IS NOT NULL").select("header").distinct()
             .orderBy("header").limit(MAX_HEADERS + 1).collect()]
    if len(texts) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different header lines under {path}")
    numbers = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], f"header string, {HEADER_NO} int")

    # one row a split: whether it starts inside quotes, and how many records come before it
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("open_out") == F.col("open_in")
    flip = F.when(F.col("open_out") & ~F.col("open_in"), 1).otherwise(0)
    inside = lambda c: F.col(c).cast("int")
    splits = (summaries.join(F.broadcast(numbers), "header", "left")
              .withColumn("flips", F.coalesce(F.sum(flip).over(earlier), F.lit(0)))
              .withColumn("anchor", F.when(fixed, (inside("open_out") + F.col("flips")) % 2))
              .withColumn("inside", (F.coalesce(F.last("anchor", ignorenulls=True).over(earlier), F.lit(0))
                                     + F.col("flips")) % 2 == 1)
              .withColumn(HEADER_NO, F.max(HEADER_NO).over(Window.partitionBy("file")))
              .withColumn("n", F.when(F.col("inside"), F.col("n_in")).otherwise(F.col("n_out"))
                          - F.when(F.col("start") == 0, 1).otherwise(0))
              .withColumn("head", F.when(F.col("inside"), F.col("head_in")).otherwise(0))
              .withColumn("tail", F.when(F.col("inside"), F.col("tail_in")).otherwise(F.col("tail_out")))
              .withColumn("owner", F.last(F.when(F.col("tail") > 0, F.col("start")), ignorenulls=True).over(earlier)))
    splits.write.parquet(f"{scratch}/placed")
    placed = spark.read.schema(splits.schema).parquet(f"{scratch}/placed")
    whole = Window.orderBy("file", "start")  # one row a split
    table = (placed.withColumn("block", F.row_number().over(whole))
             .withColumn("base", F.coalesce(F.sum("n").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                         - F.when(F.col("start") == 0, 1).otherwise(0))
             .select("file", "start", "length", "block", "inside", "base", HEADER_NO, "n", "head", "tail", "owner",
                     "first", "n_lines"))
    table.write.parquet(f"{scratch}/splits")
    table = spark.read.schema(table.schema).parquet(f"{scratch}/splits")
    crosses = (F.col("head") > 0) | (F.col("tail") > 0)
    count, crossing = table.agg(F.count("*"), F.count_if(crosses)).first()

    # a split that the second read cuts otherwise than the first finds no row
    key = ["file", "start", "length"]
    small = count <= MAX_BROADCAST_SPLITS
    known = lines.join(F.broadcast(table) if small else table, key, "left")
    changed = F.raise_error(F.concat(F.lit("the splits or the file changed between two reads: "), "file"))
    known = known.withColumn("block", F.coalesce("block", changed.cast("int")))
    if not small:
        known = known.repartition("block").sortWithinPartitions("block", "line")
    rows = known.select("block", "inside", "base", HEADER_NO, (F.col("start") == 0).alias("first_split"),
                        "open_out", "open_in", "value").mapInArrow(
        _join_records, f"{PLACE} long, {HEADER_NO} int, {RECORD_TEXT} string")
    if crossing:
        at = F.col("line") - F.col("first")
        is_head, is_tail = at < F.col("head"), at >= F.col("n_lines") - F.col("tail")
        edge = known.where(crosses & (is_head | is_tail))
        # a split within one record is its head only; with a tail, too, the head belongs to an earlier record
        begin = F.when(is_head, F.col("owner")).otherwise(F.col("start"))
        place = F.when(~is_head & ~((F.col("start") == 0) & (F.col("n") == 0)), F.col("base") + F.col("n")
                       - F.when(F.col("start") == 0, 0).otherwise(1))
        joined = (edge.withColumn("begin", begin).withColumn(PLACE, place)
                  .groupBy("file", "begin", HEADER_NO)
                  .agg(F.max(PLACE).alias(PLACE), F.array_sort(F.collect_list(F.struct("start", "line", "value"))).alias("l"))
                  .where(F.col(PLACE).isNotNull())
                  .select(PLACE, HEADER_NO, F.rtrim(F.array_join(F.col("l.value"), "\n"), F.lit("\n")).alias(RECORD_TEXT)))
        rows = rows.union(joined)
    return Records(rows, [_safe_names(t, sep) for t in texts],
                   table.where("start = 0").select("file", HEADER_NO))


def parse_records(records: Records, names: Iterable[list[str]], options: Mapping[str, str],
                  record: str | None) -> DataFrame:
    """Rows with every name of any header (NULL in files without it), PLACE and HEADER_NO.

    ``names`` are the columns' names for each header; ``record`` names the
    column that gets the text of rows with another number of fields.
    """
    names = list(names)
    opts = {k: v for k, v in options.items() if k not in ("header", "multiLine", "inferSchema", "enforceSchema")}
    parsed = []
    for no, own in enumerate(names):
        fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(own))]
        if record:
            fields.append(T.StructField(record, T.StringType()))
            opts["columnNameOfCorruptRecord"] = record
        schema = ", ".join(f"`{f.name}` string" for f in fields)
        parsed.append(F.when(F.col(HEADER_NO) == no, F.from_csv(F.col(RECORD_TEXT), schema, opts)).alias(f"__row{no}"))
    rows = records.rows.select(PLACE, HEADER_NO, *parsed)

    def pick(name: str) -> Column:
        out = F.lit(None).cast("string")
        for no, own in enumerate(names):
            if name in own:
                out = F.when(F.col(HEADER_NO) == no, F.col(f"__row{no}")[f"c{own.index(name)}"]).otherwise(out)
        return out

    columns = list(dict.fromkeys(n for own in names for n in own))
    whole = [F.coalesce(F.lit(None).cast("string"), *[F.col(f"__row{no}")[record] for no in range(len(names))]).alias(record)] \
        if record else []
    return rows.select(*[pick(c).alias(c) for c in columns], *whole, PLACE, HEADER_NO)
