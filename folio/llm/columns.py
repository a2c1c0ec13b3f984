"""Keep an input's own columns apart from those that an operator adds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shielded(frame: DataFrame, *known: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The frame with all columns but the ``known`` ones renamed, and what gives them their names back.

    The second takes a frame that still has these columns, and returns the
    input's columns in the input's order, and no others.
    """
    names = frame.columns
    aside = {c: f"__own{i}" for i, c in enumerate(names) if c not in known}

    def restored(out: DataFrame) -> DataFrame:
        return out.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in names])

    return frame.toDF(*[aside.get(c, c) for c in names]), restored


def without(frame: DataFrame, *added: str) -> DataFrame:
    """The frame without columns of the names that an operator is about to add."""
    lower = {a.lower() for a in added}
    return frame.select(*[F.col(f"`{c}`") for c in frame.columns if c.lower() not in lower])
