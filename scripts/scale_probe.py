"""Scale probe: time key queries on an enlarged copy of the driver tables.

    python scripts/scale_probe.py SRC_SF_DIR OUT_DIR [FACTOR] [FILES]

Writes ``OUT_DIR/lineitem.parquet`` and ``OUT_DIR/part.parquet`` (once):
every source row repeated FACTOR times with its key offset per copy, so
keys stay unique and titles repeat FACTOR times more in the catalog, as
FILES files each (many files -> parallel scans, unlike the single-row-group
test files).  Then times the curation variants with and without broadcast
and a few audits, printing one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from folio.operators.curate import curate  # noqa: E402
from folio.plans import queries as Q  # noqa: E402
from folio.session import local_session  # noqa: E402
from folio.sources import adapters as A  # noqa: E402


def enlarge(spark, src: str, out: str, factor: int, files: int) -> None:
    copies = F.explode(F.sequence(F.lit(0), F.lit(factor - 1))).alias("_copy")
    li = spark.read.parquet(f"{src}/lineitem.parquet")
    (li.select("*", copies)
       .withColumn("l_orderkey", F.col("l_orderkey") + F.col("_copy") * 10_000_000)
       .drop("_copy").repartition(files)
       .write.mode("overwrite").parquet(f"{out}/lineitem.parquet"))
    part = spark.read.parquet(f"{src}/part.parquet")
    (part.select("*", copies)
         .withColumn("p_partkey", F.col("p_partkey") + F.col("_copy") * 1_000_000)
         .drop("_copy").repartition(max(1, files // 8))
         .write.mode("overwrite").parquet(f"{out}/part.parquet"))


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    src, out = sys.argv[1], sys.argv[2]
    factor = int(sys.argv[3]) if len(sys.argv) > 3 else 20
    files = int(sys.argv[4]) if len(sys.argv) > 4 else 64
    spark = local_session(8, app="folio-scale-probe")
    if not os.path.exists(f"{out}/lineitem.parquet/_SUCCESS"):
        enlarge(spark, src, out, factor, files)
    rows = spark.read.parquet(f"{out}/lineitem.parquet").count()
    res: dict[str, float] = {}

    def variants(prefix: str) -> None:
        books, ratings = A.catalog(spark, out), A.reviews(spark, out)
        res[f"{prefix}curated"] = timed(lambda: curate(books, ratings, catalog_order=["seq"]))
        res[f"{prefix}curated_split_nulls"] = timed(
            lambda: curate(books, ratings, catalog_order=["seq"], split_nulls=True))
        res[f"{prefix}curated_salted_null"] = timed(
            lambda: curate(books, ratings, catalog_order=["seq"], hot_keys=[None]))

    timed(lambda: Q.table_counts(spark, out))           # warm-up
    variants("broadcast_")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    variants("sortmerge_")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in ("audit_report", "orphan_reviews", "key_violations", "top_n", "table_scan"):
        res[name] = timed(lambda n=name: Q.QUERIES[n](spark, out))
    print(json.dumps({"review_rows": rows, "factor": factor, "files": files, "seconds": res,
                      "curated_reviews_per_sec": int(rows / res["broadcast_curated"])}))


if __name__ == "__main__":
    main()
