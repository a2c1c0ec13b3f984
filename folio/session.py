"""Session settings and the shared scratch location.

The cluster owns the session; we only pin what results depend on (the
session time zone) and read the shared checkpoint folder it names.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job's results or plan shape depend on.  AQE stays on: it
# coalesces small shuffle partitions, converts joins to broadcast when the
# materialised side is under ``autoBroadcastJoinThreshold`` and splits skewed
# join partitions at run time.
REQUIRED_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Suggested settings for a large cluster (documentation and bench only; the
# cluster may override them).  Shuffle partitions are deliberately high and
# left to AQE to coalesce: 100 TB / 20,000 partitions is ~5 GB of input per
# reducer before the partial aggregates and pruning shrink it.
CLUSTER_CONF: dict[str, str] = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; returns the same session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, app: str = "folio") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the session names none, a local master gets a temporary folder of
    its own; any other master is refused, because its executors would write
    to their own disks.  A Spark Connect client has no SparkContext; it must
    name the folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect session
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return root.rstrip("/")
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not is_local(sc.master):
                raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {sc.master} share")
            root = tempfile.mkdtemp(prefix="folio-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


_SCRATCH: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused directory under the shared checkpoint folder."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.add(path)
    return path


def clean_scratch(spark: SparkSession) -> int:
    """Delete this process's scratch directories; returns how many were there.

    For when no result that reads them is needed any more: DataFrames over
    scratch tables fail afterwards.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    deleted = 0
    for path in sorted(_SCRATCH):
        p = jvm.org.apache.hadoop.fs.Path(path)
        deleted += bool(p.getFileSystem(conf).delete(p, True))
    _SCRATCH.clear()
    return deleted
