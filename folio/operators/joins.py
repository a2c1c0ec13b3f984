"""Key joins: many-to-one lookup, referential (orphan) check, threshold lookup.

No join here is given a broadcast hint, but for the NULL-key rows of
``split_nulls``, whose number is checked first.  With AQE on, Spark turns a
sort-merge join into a broadcast join only after the smaller side has been
materialised and measured under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
(a checked size bound), and otherwise splits skewed partitions at run time.
Known hot keys can additionally be salted with ``hot_keys``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

_DIM_KEY = "__dim_key"
_SALT = "__salt"
#: Least share that find_hot_keys() takes: it bounds the keys that reach the driver.
MIN_SHARE = 0.0001
#: NULL-key dim rows that are broadcast at most.
MAX_NULL_ROWS = 100


def _key_match(left: Column, right: Column, null_keys: str) -> Column:
    if null_keys == "match":
        return left.eqNullSafe(right)
    if null_keys == "drop":
        return left == right
    raise ValueError(f"null_keys must be 'match' or 'drop', got {null_keys!r}")


def _is_hot(col: Column, hot_keys: Sequence[object]) -> Column:
    values = [k for k in hot_keys if k is not None]
    cond = col.isin(values) if values else F.lit(False)
    if any(k is None for k in hot_keys):
        cond = cond | col.isNull()
    return cond


def lookup_join(facts: DataFrame, dim: DataFrame, key: str, *, null_keys: str = "match",
                how: str = "inner", hot_keys: Sequence[object] | None = None,
                salt_buckets: int = 64, split_nulls: bool = False) -> DataFrame:
    """Join ``facts`` to ``dim`` (at most one row per ``key``) on ``key``.

    ``null_keys="match"`` pairs a NULL key with the dim's NULL-key row (the
    semantics of an in-memory merge); ``"drop"`` is SQL equality.  One key
    column is kept.  Dim columns that also exist in ``facts`` are dropped
    from the dim side.

    ``hot_keys`` lists keys known to be heavy on the fact side (``None`` is
    the NULL key).  Their fact rows are dealt round-robin over
    ``salt_buckets`` by row position (constant cost, even for long texts)
    and their dim rows replicated that many times; the replication is
    bounded by ``len(hot_keys) * salt_buckets`` rows because the dim holds
    one row per key.  Every replica is identical, so whichever salt a row
    gets -- also after a task retry -- it joins to the same values.

    ``split_nulls`` (with ``null_keys="match"``) joins non-NULL keys by plain
    equality -- which can reuse a ``key`` partitioning or bucketing of either
    side, so two tables bucketed by ``key`` join without any exchange -- and
    the NULL-key facts to the dim's NULL-key rows by broadcast, if a count
    finds ``MAX_NULL_ROWS`` of them at most (one, in a deduped dim).  It reads
    ``facts`` twice (each read filtered by the NULL test), so it pays for
    bucketed tables only.
    """
    extra = [c for c in dim.columns if c != key and c not in facts.columns]
    d = dim.select(F.col(key).alias(_DIM_KEY), *extra)
    cond = _key_match(F.col(key), F.col(_DIM_KEY), null_keys)
    if split_nulls and null_keys == "match":
        if hot_keys:
            raise ValueError("split_nulls and hot_keys are alternatives; give one")
        keyed = facts.filter(F.col(key).isNotNull()).join(
            d.filter(F.col(_DIM_KEY).isNotNull()), F.col(key) == F.col(_DIM_KEY), how)
        null_dim = d.filter(F.col(_DIM_KEY).isNull())
        if null_dim.limit(MAX_NULL_ROWS + 1).count() <= MAX_NULL_ROWS:
            null_dim = F.broadcast(null_dim)
        unkeyed = facts.filter(F.col(key).isNull()).join(null_dim, cond, how)
        return keyed.unionByName(unkeyed).drop(_DIM_KEY)
    if hot_keys:
        hot_f = _is_hot(F.col(key), hot_keys)
        f = facts.withColumn(
            _SALT, F.when(hot_f, F.pmod(F.monotonically_increasing_id(), F.lit(salt_buckets)))
            .otherwise(0))
        hot_d = _is_hot(F.col(_DIM_KEY), hot_keys)
        d = d.withColumn(
            _SALT, F.explode(F.when(hot_d, F.sequence(F.lit(0), F.lit(salt_buckets - 1)))
                             .otherwise(F.array(F.lit(0)))))
        d = d.withColumnRenamed(_SALT, _SALT + "_d")
        cond = cond & (F.col(_SALT) == F.col(_SALT + "_d"))
        return f.join(d, cond, how).drop(_DIM_KEY, _SALT, _SALT + "_d")
    return facts.join(d, cond, how).drop(_DIM_KEY)


def find_hot_keys(df: DataFrame, key: str, min_share: float = 0.01) -> list[object]:
    """Keys holding at least ``min_share`` of the rows (exact, one pass).

    At most ``1 / min_share`` keys can qualify, so they are all among the
    ``ceil(1 / min_share)`` most frequent keys: one job computes grouped
    counts (partial aggregation, so a hot key costs one row per map task),
    keeps that bounded top list, and counts all rows through an
    ``Observation``; the share test runs on the few returned rows.
    """
    if not MIN_SHARE <= min_share <= 1:
        raise ValueError(f"min_share must be in [{MIN_SHARE}, 1]")
    obs = Observation("rows_for_hot_keys")
    k = math.ceil(1 / min_share)
    top = (df.observe(obs, F.count(F.lit(1)).alias("rows"))
           .groupBy(key).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n")).limit(k).collect())
    if not top:   # no rows (an empty plan may be optimised away unobserved)
        return []
    total = obs.get["rows"]
    return [r[key] for r in top if r["n"] >= min_share * total]


def orphan_keys(facts: DataFrame, dim: DataFrame, key: str, count_col: str = "n_reviews") -> DataFrame:
    """Fact keys missing from ``dim`` with their row counts; NULL keys are exempt.

    Both sides are reduced to distinct keys first (partial aggregation
    before the shuffle), so a key repeated millions of times on either side
    reaches the anti join as one row.
    """
    per_key = (facts.filter(F.col(key).isNotNull())
               .groupBy(key).agg(F.count(F.lit(1)).alias(count_col)))
    dim_keys = dim.select(key).filter(F.col(key).isNotNull()).distinct()
    return per_key.join(dim_keys, on=key, how="left_anti")


def threshold_lookup(counts: DataFrame, thresholds: DataFrame, key: str, value: str,
                     minimum: str, flag: str = "ok") -> DataFrame:
    """Every threshold row with its observed value (absent -> 0) and a pass flag."""
    return (thresholds.join(counts, on=key, how="left")
            .select(key,
                    F.coalesce(F.col(value), F.lit(0).cast("long")).alias(value),
                    F.col(minimum).cast("long").alias(minimum))
            .withColumn(flag, F.col(value) >= F.col(minimum)))
