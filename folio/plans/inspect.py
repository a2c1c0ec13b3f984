"""Plan inspection helpers (used by the tests and scripts/plan_report.py)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def count_nodes(df: DataFrame, node: str) -> int:
    """How many physical operators named ``node`` the (initial) plan has."""
    text = plan_text(df, "formatted")
    tree = text.split("\n\n", 1)[0]
    # After execution AQE prints its final and its initial tree; count one.
    if "== Initial Plan ==" in tree:
        tree = tree.split("== Initial Plan ==", 1)[1]
    return len(re.findall(rf"\b{re.escape(node)}\b", tree))


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas")


def forbidden_nodes(df: DataFrame) -> list[str]:
    """Nested-loop or cartesian joins and Python evaluation nodes in the plan."""
    text = plan_text(df, "simple")
    return [n for n in FORBIDDEN if n in text]
