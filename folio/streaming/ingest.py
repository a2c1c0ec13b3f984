"""Incremental CSV ingest with Structured Streaming.

The bounded chunk-by-chunk loader, made restartable: a file stream over a
landing folder applies the same rename / project / NA-token / cast steps
and appends to a Parquet table (always the full target schema) through
the file sink.  The checkpoint (in
the shared checkpoint folder) records which files were committed, so a
lost executor or a restarted driver neither skips nor duplicates a file,
and a rerun picks up only new files.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import types as T

from folio.config import HEADER_MAP, NA_TOKENS
from folio.operators.shaping import align_to_schema, conform
from folio.sources.csv import CSV_READ_OPTIONS, MALFORMED, RECORD, check_widths, text_schema
from folio.sources.tables import read_table, table_exists


@dataclass
class StreamResult:
    """What one ``availableNow`` run committed."""

    batches: int
    rows: int


def _last_commit(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last batch in the checkpoint's commit log, -1 if there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/commits")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return -1
    names = [status.getPath().getName() for status in fs.listStatus(p)]
    return max((int(x) for x in names if x.isdigit()), default=-1)


def _rows(spark: SparkSession, path: str) -> int:
    """Rows of the stream's table, from the footers of the files its log names."""
    return read_table(spark, path=path).count() if table_exists(spark, path=path) else 0


def stream_csv_to_table(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                        schema: T.StructType, *, header: Iterable[str] | None = None,
                        header_map: Mapping[str, str] = HEADER_MAP,
                        na_tokens: Iterable[str] = NA_TOKENS,
                        files_per_trigger: int | None = None,
                        bytes_per_trigger: str | None = None,
                        malformed: str = "fail",
                        multi_line: bool = True,
                        trigger_interval: str | None = None) -> StreamResult | StreamingQuery:
    """Ingest every file now in ``landing`` (``availableNow``) and stop.

    ``header`` names the landing files' columns (by default, the header line
    of the files already there); Spark checks each file's header line
    against it (``enforceSchema=false``) rather than trusting position.
    ``malformed`` and ``multi_line`` are those of ``read_csv_table``.

    A micro-batch takes all files there are, unless ``files_per_trigger`` or
    ``bytes_per_trigger`` bounds it; with quoted line breaks a file is one
    task, so a bound on files bounds the tasks.

    Returns the batches and rows committed by this run, from the checkpoint
    and the table.  With ``trigger_interval`` (e.g. ``"1 minute"``) the query
    keeps running, picking up new files on that schedule, and is returned
    running instead.
    """
    if malformed not in MALFORMED:
        raise ValueError(f"malformed must be one of {MALFORMED}")
    if header is None:
        # reads only a header line: no schema inference over the data
        header = spark.read.options(**CSV_READ_OPTIONS).csv(landing).columns
    header = list(header)
    strict = malformed == "strict"
    opts = {**CSV_READ_OPTIONS, "enforceSchema": "false", "multiLine": str(multi_line).lower()}
    opts.update({"mode": "FAILFAST"} if strict else {"columnNameOfCorruptRecord": RECORD})
    reader = spark.readStream.options(**opts)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    raw = reader.schema(text_schema(header, with_record=not strict)).csv(landing)
    if not strict:
        raw = check_widths(raw, len(header), malformed)
    typed = align_to_schema(conform(raw, schema, header_map=header_map, na_tokens=na_tokens).frame,
                            schema)
    writer = (typed.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    if trigger_interval:
        return writer.trigger(processingTime=trigger_interval).start(table_path)
    batches, rows = _last_commit(spark, checkpoint), _rows(spark, table_path)
    query = writer.trigger(availableNow=True).start(table_path)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return StreamResult(_last_commit(spark, checkpoint) - batches, _rows(spark, table_path) - rows)
