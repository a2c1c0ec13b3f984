"""Sinks: table overwrite/append, CSV export, JDBC, and post-write row counts.

Writes go through Spark's file committer, so a failed or retried task
never leaves partial output, and an overwrite replaces the table in one
job (no chunk-by-chunk appends).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from folio.sinks.layout import bloom_options, z_ordered

# CSV export: header, quote-escaped quotes, NULL -> empty field, full
# timestamps.  Reads back equal through ``folio.sources.csv``.
CSV_WRITE_OPTIONS: dict[str, str] = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "quoteAll": "false",
    "nullValue": "",
    "emptyValue": '""',
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "dateFormat": "yyyy-MM-dd",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def ensure_database(spark, name: str, location: str | None = None) -> None:
    """Create the catalog database (schema) if it does not exist."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


class EmptyOutputError(ValueError):
    """Refused to replace a table with a frame that has no columns."""


def _guard(df: DataFrame) -> None:
    if not df.columns:
        raise EmptyOutputError("refusing to write a frame with no columns")


def write_table(df: DataFrame, *, path: str | None = None, table: str | None = None,
                mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
                bucket_by: tuple[int, Sequence[str]] | None = None,
                count_rows: bool = True,
                max_records_per_file: int | None = None,
                compression: str | None = None,
                z_order_by: Sequence[str] = (), bloom_distinct: int | None = None,
                row_group_bytes: int | None = None) -> int | None:
    """Write ``df`` to a path or catalog table; return the rows written.

    * ``mode="overwrite"`` recreates the table (truncate-then-load);
      ``"append"`` adds to it.
    * ``cluster_by`` sorts rows within each output file so Parquet min/max
      statistics skip row groups for lookups on those columns (the access
      path an index would give).
    * ``bucket_by=(n, cols)`` (catalog tables only) pre-partitions the table
      so later joins or aggregations on ``cols`` need no shuffle.
    * Row counts come from an ``Observation`` on the write itself, not a
      second scan.
    * ``max_records_per_file`` splits large partitions into several files,
      so later reads stay parallel; ``compression`` picks the file codec
      (e.g. ``"zstd"``; the session default otherwise).
    * ``z_order_by`` sorts rows over all files so that lookups by any of
      these columns skip row groups (``layout.z_ordered``), and gives these columns Bloom
      filters for ``bloom_distinct`` values a row group; ``row_group_bytes`` sizes these.
    """
    _guard(df)
    if z_order_by and (cluster_by or bucket_by is not None):
        raise ValueError("z_order_by is an order of its own")
    if z_order_by:
        df = z_ordered(df, z_order_by)
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path= or table=")
    obs = None
    if count_rows:
        obs = Observation()
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if cluster_by:
        df = df.sortWithinPartitions(*cluster_by)
    writer = df.write.mode(mode).format(fmt)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if compression:
        writer = writer.option("compression", compression)
    if bloom_distinct:
        writer = writer.options(**bloom_options(z_order_by, bloom_distinct))
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by is not None:
        if table is None:
            raise ValueError("bucket_by needs a catalog table")
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
    if table is not None:
        writer.saveAsTable(table)
    else:
        writer.save(path)
    return int(obs.get["rows"]) if obs is not None else None


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite",
              single_file: bool = False, max_records_per_file: int | None = None) -> None:
    """CSV export with a header and no index column.

    Output is one file per partition; ``single_file=True`` funnels every row
    through one task and is meant for small outputs such as reports.
    """
    _guard(df)
    if single_file:
        df = df.coalesce(1)
    writer = df.write.mode(mode).options(**CSV_WRITE_OPTIONS)
    if max_records_per_file and not single_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, *, properties: Mapping[str, str],
               mode: str = "append", max_connections: int = 8, batch_size: int = 10_000,
               truncate: bool = True) -> None:
    """Write to a relational database table through Spark's JDBC sink.

    ``max_connections`` caps the concurrent writers (Spark's ``numPartitions``
    coalesces to it), so a large cluster does not open thousands of database
    sessions; rows go in batches of ``batch_size``.  ``mode="overwrite"`` with
    ``truncate`` empties the table and keeps its definition, like truncate-then-
    load.  Each partition commits on its own, so a failed job can leave part of
    the rows; load a staging table and swap it in where that matters.  Needs the
    database's JDBC driver on the classpath (not exercised in the tests).
    """
    _guard(df)
    writer = (df.write.format("jdbc").mode(mode)
              .option("url", url).option("dbtable", table)
              .option("numPartitions", str(max_connections))
              .option("batchsize", str(batch_size))
              .option("truncate", "true" if truncate else "false"))
    for k, v in properties.items():
        writer = writer.option(k, v)
    writer.save()

