"""Table scans: full, capped, sampled, and the relational-database connector."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from folio.functions.exprs import column
from folio.session import scratch_path


#: Error conditions that mean "there is no such input".
MISSING = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND")


def read_table(spark: SparkSession, *, path: str | None = None, table: str | None = None,
               fmt: str = "parquet", schema: T.StructType | None = None,
               on_missing: str = "fail") -> DataFrame:
    """Full scan of a stored table (by path or catalog name).

    Column pruning and filters pushed by later operators reach the scan.
    ``on_missing="skip"`` returns an empty frame with ``schema`` instead of
    failing when the input does not exist.
    """
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path= or table=")
    try:
        if table is not None:
            return spark.table(table)
        return spark.read.format(fmt).load(path)
    except AnalysisException as exc:
        # absent only: an unreadable or empty folder is an error
        if on_missing == "skip" and schema is not None and exc.getCondition() in MISSING:
            return spark.createDataFrame([], schema)
        raise


def table_exists(spark: SparkSession, *, path: str | None = None, table: str | None = None) -> bool:
    """Whether there is anything at the path, or a table of the name."""
    if table is not None:
        return spark.catalog.tableExists(table)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def top_n(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by a total order of columns (ascending, NULL first); exact.

    The value of the leading column at which the n-th row falls is found
    first, reading that column only.  Every row strictly before it passes a
    plain filter, in parallel and in as many partitions as the scan has;
    only the rows that tie with it are ranked, by the next column in the same
    way.  Rows that tie in all columns of the order are interchangeable to it;
    some of them are taken.  The result's order is not defined: sort it where
    order matters.
    """
    if not order_by or not all(isinstance(c, str) for c in order_by):
        raise ValueError("order_by needs column names")
    if n <= 0:
        return df.limit(0)
    lead = column(order_by[0])
    found = _cut(df, n, order_by[0])
    if found is None:
        return df
    value, before, ties = found
    at = F.lit(value).cast(df.schema[order_by[0]].dataType)
    tied = df.filter(lead.eqNullSafe(at))
    first = df.filter(lead.isNull() | (lead < at)) if value is not None else None
    if before + ties > n:
        rest = list(order_by[1:])
        tied = top_n(tied, n - before, rest) if rest else tied.limit(n - before)
    return tied if first is None or before == 0 else first.unionByName(tied)


def _cut(df: DataFrame, n: int, lead: str) -> tuple[object, int, int] | None:
    """(value, rows before it, rows with it) of the n-th row's lead; None if there are n rows or fewer.

    Distinct leads are counted (a hot one costs a row a task) and
    range-partitioned; one sum a partition tells which of them holds the cut,
    and only that one is summed up row by row.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "top-n")
    (df.groupBy(column(lead).alias("lead")).agg(F.count(F.lit(1)).alias("n"))
     .repartitionByRange("lead").withColumn("part", F.spark_partition_id()).write.parquet(path))
    counts = spark.read.parquet(path)
    before = 0
    for row in counts.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").toLocalIterator():
        if before + row["n"] >= n:
            break
        before += row["n"]
    else:
        return None
    if before + row["n"] == n and counts.agg(F.max("part")).first()[0] == row["part"]:
        return None
    running = F.sum("n").over(Window.partitionBy("part").orderBy("lead").rowsBetween(Window.unboundedPreceding, 0))
    cut = (counts.filter(F.col("part") == row["part"]).withColumn("upto", running + before)
           .filter(F.col("upto") >= n).orderBy("upto").first())
    return cut["lead"], cut["upto"] - cut["n"], cut["n"]


def hash_sample(df: DataFrame, keys: Sequence[str], buckets: int, bucket: int = 0) -> DataFrame:
    """A deterministic 1/``buckets`` sample: rows whose key hash lands in ``bucket``.

    Unlike ``limit``, every task filters independently, so a development
    subset stays parallel and repeatable across runs.
    """
    return df.filter(F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)) == bucket)


def read_jdbc(spark: SparkSession, url: str, table: str, *, properties: Mapping[str, str],
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10_000) -> DataFrame:
    """Parallel read from a relational database through Spark's JDBC source.

    With ``partition_column`` and bounds, Spark issues ``num_partitions``
    range queries in parallel instead of one full-table fetch; ``fetch_size``
    makes drivers stream rows instead of buffering the result.  Needs the
    database's JDBC driver on the classpath (not exercised in the tests).
    """
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", str(fetch_size)))
    for k, v in properties.items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()
