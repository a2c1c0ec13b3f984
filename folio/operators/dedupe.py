"""Distinct-on: keep the first row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__first_rn"


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per ``keys`` value: the first by ``order_by``; NULL is one key.

    ``order_by`` should be a total order, otherwise ties pick an arbitrary
    row.  Without it the pick depends on row content only: a 64-bit hash of
    the other columns orders the rows (cheap to compare even when rows carry
    long text), and the columns themselves break hash ties.

    Plan: ``row_number() ... = 1`` lets Spark insert a partial
    ``WindowGroupLimit`` before the shuffle, so every map task ships at most
    one row per key; a hot key (or the NULL key) never floods one reducer.
    """
    keys = list(keys)
    if order_by is None:
        rest = [c for c in df.columns if c not in keys]
        if not rest:   # rows sharing a key are identical
            return df.dropDuplicates(keys)
        order_by = [F.xxhash64(*[F.col(c) for c in rest]), *rest]
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
