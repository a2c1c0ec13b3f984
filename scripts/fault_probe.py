"""Fault probe: jobs give the same result when tasks fail and are retried.

    python scripts/fault_probe.py SF_DIR

Runs in its own local Spark that allows task retries (``local[4,4]``).  A
test-only step fails the first attempt of every other task in the stage that
reads the reviews, so the scheduler reruns those tasks mid-job; each job's
output is compared with a clean run.  Prints one JSON line of per-job
verdicts.  (The flaky step is a Python UDF on purpose: it exists only here,
to inject failures.)
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from folio.operators import quality as QA  # noqa: E402
from folio.operators.curate import curate  # noqa: E402
from folio.session import configure  # noqa: E402
from folio.sources import adapters as A  # noqa: E402
from folio.sources.tables import top_n  # noqa: E402


def _fail_first_attempt_py(_value):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected task failure")
    return True


# Nondeterministic, so the optimizer keeps it where it is written (after the
# repartition) instead of pushing it into the single scan task.
_fail_first_attempt = F.udf(_fail_first_attempt_py, T.BooleanType()).asNondeterministic()


def _rows(df):
    return sorted((tuple((v is None, str(v)) for v in r) for r in df.collect()))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[4,4]").appName("folio-fault-probe")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    configure(spark)
    books = A.catalog(spark, sf_dir)
    clean = A.reviews(spark, sf_dir, with_part_key=True).repartition(6)
    flaky = clean.filter(_fail_first_attempt(F.col("id")))

    jobs = {
        "curate": lambda r: curate(books, r.drop("part_key"), catalog_order=["seq"]),
        "curate_salted": lambda r: curate(books, r.drop("part_key"), catalog_order=["seq"],
                                          hot_keys=[None]),
        "curate_split_nulls": lambda r: curate(books, r.drop("part_key"), catalog_order=["seq"],
                                               split_nulls=True),
        "top_n": lambda r: top_n(r, 5000, A.REVIEW_ORDER),
        "top_n_ties": lambda r: top_n(r, 2000, ("line_no", *A.REVIEW_ORDER)),
        "audit_sections": lambda r: QA.fused_audit_report(books, r.drop("part_key")),
        "orphans": lambda r: QA.key_violations(r, "title"),
    }
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    verdict, failed = {}, {}
    for name, job in jobs.items():
        expected = _rows(job(clean))
        sc.setJobGroup(f"flaky-{name}", name)
        got = _rows(job(flaky))
        sc.setJobGroup("clean", "clean")
        verdict[name] = got == expected
        stages = {sid for jid in tracker.getJobIdsForGroup(f"flaky-{name}")
                  for sid in (tracker.getJobInfo(jid).stageIds if tracker.getJobInfo(jid) else [])}
        failed[name] = sum(tracker.getStageInfo(sid).numFailedTasks
                           for sid in stages if tracker.getStageInfo(sid))
    print(json.dumps({"all_equal": all(verdict.values()), "jobs": verdict,
                      "failed_task_attempts": failed}))
    spark.stop()


if __name__ == "__main__":
    main()
