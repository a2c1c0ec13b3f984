"""Write PLANS.md: the physical plan shape of every registered query.

    python scripts/plan_report.py [sf_dir]

For each query: table scans, exchanges (shuffles), broadcasts, join kinds,
partial limits before a shuffle, and Python evaluation nodes, taken from
``explain("formatted")`` of the plan Spark would run (before AQE re-plans).
Queries that write and read back show only their final read here.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from folio.plans import queries as Q  # noqa: E402
from folio.plans.inspect import plan_text  # noqa: E402
from folio.session import local_session  # noqa: E402

NODES = ("Scan parquet", "Scan csv", "Scan ExistingRDD", "Exchange", "BroadcastExchange", "SortMergeJoin",
         "BroadcastHashJoin", "WindowGroupLimit", "TakeOrderedAndProject", "HashAggregate",
         "Window", "BroadcastNestedLoopJoin", "CartesianProduct", "ArrowEvalPython",
         "BatchEvalPython")


def tree_of(text: str) -> str:
    return text.split("\n\n", 1)[0].replace("== Physical Plan ==\n", "")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    rows, trees = [], []
    for name, fn in Q.QUERIES.items():
        text = plan_text(fn(spark, sf_dir))
        tree = tree_of(text)
        counts = {n: len(re.findall(rf"(?<![A-Za-z]){re.escape(n)}(?![A-Za-z])", tree))
                  for n in NODES}
        partial = text.count(", Partial")
        scans = counts["Scan parquet"] + counts["Scan csv"]
        joins = ", ".join(f"{n} x{counts[n]}" for n in ("SortMergeJoin", "BroadcastHashJoin",
                                                         "BroadcastNestedLoopJoin",
                                                         "CartesianProduct") if counts[n]) or "-"
        python = counts["ArrowEvalPython"] + counts["BatchEvalPython"]
        rows.append(f"| `{name}` | {scans} | {counts['Scan ExistingRDD']} | {counts['Exchange']} "
                    f"| {counts['BroadcastExchange']} "
                    f"| {joins} | {partial} | {counts['TakeOrderedAndProject']} | {python} |")
        trees.append(f"### `{name}`\n\n```\n{tree.rstrip()}\n```\n")
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `scripts/plan_report.py {sf_dir}` on `local[8]` with the default",
           "broadcast threshold (so the small catalog side is broadcast here; a large catalog",
           "gives a sort-merge join, checked in `tests/test_plans_and_entry.py`). Counts are",
           "over the initial adaptive plan. *Partial limits* are `WindowGroupLimit (Partial)`",
           "nodes that cut rows per key before a shuffle.", "",
           "*Materialised reads* scan data built before the plan: the audit's checkpointed",
           "aggregates (`audit_report` scanned each table once while building them).", "",
           "| Query | Table scans | Materialised reads | Shuffles | Broadcasts | Joins | Partial limits "
           "| TakeOrdered | Python nodes |",
           "|---|---|---|---|---|---|---|---|---|", *rows, "", "## Plan trees", "", *trees]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
