"""Line dedup (6): levelled sorted runs of line hashes.

``LineRuns`` remembers which document first held each line key, as sorted
runs of (key hash, owner) on shared storage.  A batch is reduced to one row a
key, looked up in the runs by a merge join and, for the keys that no run
knows, written as a new run of level 0; when a level has ``fanout`` runs,
they are compacted into one run of the next level.  A key is in one run only,
so compaction is a union.

A line that an earlier batch owns, or that a smaller doc_id of its own batch
holds, is dropped from every document but its owner.  Batches must come in
ascending ranges of doc_id for "the smallest doc_id keeps it" to hold over
all of them; ``batch_bounds`` cuts a table into such ranges.

A key is the line without white space at its ends and with A-Z lower-cased;
keys shorter than ``MIN_CHARS`` code points are never dropped.  Keys are
compared by 128-bit hashes.

Defined results: a null or empty text is one empty line; a line repeated
inside its owner stays; null ids count as the smallest id; rows that repeat a
repeat a doc_id are one document for ownership, and each row is rebuilt on its own
(lines to drop are kept by doc_id and text).
Other columns of the input pass through untouched, but for those that have the
name of an added one, which are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.llm.columns import without
from folio.llm.words import as_bytes
from folio.session import scratch_path

MIN_CHARS = 10
FANOUT = 2
BATCHES = 4

LINES_SCHEMA = "doc_id long, row_key long, line int, k1 long, k2 long"


def _long_enough(key: bytes) -> bool:
    if len(key) < MIN_CHARS or len(key) >= 4 * MIN_CHARS:
        return len(key) >= MIN_CHARS
    return sum((b & 0xC0) != 0x80 for b in key) >= MIN_CHARS


def line_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, key of the text, line number, 128-bit key) of each line that may be dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, row_keys = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            rows, lines, digests = [], [], []
            for row, text in enumerate(as_bytes(batch.column(1))):
                for number, line in enumerate((text or b"").split(b"\n")):
                    key = line.strip().lower()
                    if _long_enough(key):
                        rows.append(row)
                        lines.append(number)
                        digests.append(xxhash.xxh3_128_digest(key))
            keys = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[rows], pa.int64()), pa.array(row_keys[rows], pa.int64()), pa.array(lines, pa.int32()),
                 pa.array(np.ascontiguousarray(keys[:, 0])), pa.array(np.ascontiguousarray(keys[:, 1]))],
                names=["doc_id", "row_key", "line", "k1", "k2"])

    smallest = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return docs.select(smallest, F.col("text"), F.xxhash64("text")).mapInArrow(run, LINES_SCHEMA)


def batch_bounds(docs: DataFrame, batches: int) -> list[int]:
    """Ascending doc_ids that start batches 1, 2, ...: even ranges by approximate quantiles."""
    cuts = docs.select(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000)).first()[0]
    return sorted(set(cuts or []))


class LineRuns:
    """The levelled runs under ``path`` (shared storage); ``level[i]`` lists the runs of level i."""

    def __init__(self, spark: SparkSession, path: str, fanout: int = FANOUT) -> None:
        self.spark, self.path, self.fanout = spark, path, fanout
        self.level: list[list[str]] = []
        self._written = 0

    def _write_run(self, run: DataFrame, level: int) -> None:
        path = f"{self.path}/level{level}-run{self._written}"
        self._written += 1
        (run.select("k1", "k2", "owner").repartitionByRange("k1", "k2")
         .sortWithinPartitions("k1", "k2").write.parquet(path))
        while len(self.level) <= level:
            self.level.append([])
        self.level[level].append(path)

    def read(self) -> DataFrame | None:
        paths = [p for level in self.level for p in level]
        return self.spark.read.schema("k1 long, k2 long, owner long").parquet(*paths) if paths else None

    def add(self, lines: DataFrame) -> DataFrame:
        """Take in one batch of ``line_keys``; the (k1, k2, owner) of its keys that some document must drop."""
        keys = lines.groupBy("k1", "k2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        known = self.read()
        if known is None:
            looked_up = keys.withColumn("owner", F.lit(None).cast("long"))
        else:
            looked_up = keys.join(known.hint("merge"), ["k1", "k2"], "left")
        path = f"{self.path}/batch{self._written}"
        looked_up.write.parquet(path)
        looked_up = self.spark.read.parquet(path)
        self._write_run(looked_up.where("owner IS NULL").select("k1", "k2", F.col("low").alias("owner")), 0)
        self._compact()
        return (looked_up.where("owner IS NOT NULL OR low < high")
                .select("k1", "k2", F.coalesce("owner", "low").alias("owner")))

    def _compact(self) -> None:
        for i in range(64):
            if i >= len(self.level) or len(self.level[i]) < self.fanout:
                return
            runs, self.level[i] = self.level[i], []
            self._write_run(self.spark.read.parquet(*runs), i + 1)


def dropped_lines(docs: DataFrame, runs: LineRuns, batches: int = BATCHES) -> DataFrame:
    """(doc_id, row_key, lines): the sorted numbers of the lines each text of a document loses."""
    spark = docs.sparkSession
    bounds = batch_bounds(docs, batches)
    batch = F.lit(0)
    for b in bounds:
        batch = batch + F.when(F.col("doc_id") >= b, 1).otherwise(0)
    path = scratch_path(spark, "line-keys")
    line_keys(docs).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(LINES_SCHEMA + ", batch int").parquet(path)
    parts = []
    for number in range(len(bounds) + 1):
        own = lines.where(F.col("batch") == number).drop("batch")
        losers = runs.add(own)
        parts.append(own.join(losers, ["k1", "k2"]).where("doc_id <> owner").select("doc_id", "row_key", "line"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct().groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def dedup_lines(docs: DataFrame, runs: LineRuns | None = None, batches: int = BATCHES) -> DataFrame:
    """``docs`` with text rebuilt, and ``_n_lines`` (before) and ``_n_dropped``."""
    spark = docs.sparkSession
    docs = without(docs, "_n_lines", "_n_dropped")
    runs = runs or LineRuns(spark, scratch_path(spark, "line-runs"))
    drop = dropped_lines(docs, runs, batches).select(F.col("doc_id").alias("__line_id"), F.col("row_key").alias("__line_key"),
                                                     F.col("lines").alias("__drop"))
    smallest = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    same = (smallest == F.col("__line_id")) & (F.xxhash64("text") == F.col("__line_key"))
    joined = docs.join(drop, same, "left").drop("__line_id", "__line_key")
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("_n_lines", T.LongType()),
                           T.StructField("_n_dropped", T.LongType())])
    at = names.index("text")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            texts, n_lines, n_dropped = [], [], []
            drops = b.column(len(names))
            for i, text in enumerate(as_bytes(b.column(at))):
                lines = (text or b"").split(b"\n")
                gone = set(drops[i].as_py() or ())
                n_lines.append(len(lines))
                n_dropped.append(len(gone))
                texts.append(b"\n".join(x for n, x in enumerate(lines) if n not in gone) if gone else text or b"")
            columns = list(b.columns[:len(names)])
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=schema.names)

    return joined.mapInArrow(run, schema)

