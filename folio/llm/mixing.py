"""Mixing (9): sources brought to target weights along a curriculum.

*Targets.*  Sources in code point order (null last) have weights 1, 2, 3,
repeating, and share all words by weight; no target exceeds ``MAX_EPOCHS``
times its source's words, and what is in excess is shared again by weight
until none does.

*Documents.*  A source of S words with target t is read t / S times: every
document ``floor(t / S)`` times, and once more those that come first in a
keyed hash order, up to the target's rest.

*Curriculum.*  A source's weight over training time u in [0, 1] is a straight
line, ``1 + slope * (2u - 1)`` of its mean; its integral is the demand for the
source's words up to u, so the word that is a share c of the target is read at
the u with ``u + slope * (u * u - u) = c``.  That is solved for every reading
of a document, and readings are range-sorted by position.

Only DataFrame functions are used.  Running sums within a source are sums
over buckets of the hash order, plus the running sum within a bucket; the
number of buckets grows with the rows, so a source with a third of them is no
single group.  Texts are not shuffled for the sums.

Defined results: a null text has size 0, is never read, and takes 0; a source
without words has target 0; without rows there is no result.  Rows that
repeat a doc_id and its text share their place in the order but are read one
by one.  Other columns pass through untouched, but for those that have the name
of an added one, which plan() leaves out and mix() keeps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.columns import shielded, without
from folio.session import scratch_path

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
#: Of the source's mean weight, by weight class: the first fades out, the third comes in.
SLOPES = (-0.6, 0.0, 0.6)
KEY = 71
ROWS_PER_BUCKET = 1_000
BROADCAST_SOURCES = 50_000

ADDED = ("_size", "_source_size", "_target", "_readings", "_before", "_source_no")


def n_words(text: str = "text") -> Column:
    """Words of a text; null: 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _order(doc_id: str, key: int) -> Column:
    """A document's place in its source: 32 hexadecimal digits."""
    return F.md5(F.concat(F.lit(f"{key}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))


def _bucket(order: Column, bits: int) -> Column:
    return F.shiftright(F.conv(F.substring(order, 1, 8), 16, 10).cast("long"), 32 - bits)


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_no, source_size, target) by water-filling, from (source, size) rows.

    There is a row a source from the first aggregate on.  Sources reach their
    cap in the order of size / weight, so the level at which the sources that
    are not capped share the rest is found by running sums in that order.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    k = len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("rank") % k + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.lit(float(MAX_EPOCHS)) * F.col("source_size"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    ranked = (ranked
              .withColumn("all_words", F.sum("source_size").over(whole))
              .withColumn("rest", F.col("all_words") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              .withColumn("weights", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("level", F.col("rest") / F.col("weights"))
              .withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
              .withColumn("final", F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "rank", "level")))
                          .over(whole)["level"]))
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("final") * F.col("weight"))
    return ranked.select("source", F.col("rank").alias("source_no"), "source_size", target.alias("target"))


def plan(docs: DataFrame, key: int = KEY) -> DataFrame:
    """``docs`` with ``_size``, ``_source_size``, ``_target``, ``_readings``, ``_before`` (words of its
    source that come before it in one reading of the source) and ``_source_no``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "mixing")
    docs = without(docs, *ADDED)
    bits = max(0, min(24, math.ceil(math.log2(max(1, docs.count()) / ROWS_PER_BUCKET))))
    sized = (docs.select("*", n_words().alias("_size"), _order("doc_id", key).alias("__order"))
             .withColumn("__bucket", _bucket(F.col("__order"), bits)))
    sized.groupBy("source", "__bucket").agg(F.sum("_size").alias("size")).write.parquet(f"{path}/buckets")
    buckets = spark.read.parquet(f"{path}/buckets")
    targets(buckets).write.parquet(f"{path}/targets")
    goal = spark.read.parquet(f"{path}/targets").select(
        F.col("source").alias("__source"), F.col("source_no").alias("_source_no"),
        F.col("source_size").alias("_source_size"), F.col("target").alias("_target"))
    same = F.col("source").eqNullSafe(F.col("__source"))
    goal = F.broadcast(goal) if goal.count() <= BROADCAST_SOURCES else goal.hint("merge")
    earlier = Window.partitionBy("_source_no").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (buckets.join(goal, same)
               .select(F.col("_source_no").alias("__no"), F.col("__bucket").alias("__b"),
                       F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("__offset")))
    inside = (Window.partitionBy("_source_no", "__bucket").orderBy("__order", "_size")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = (sized.join(goal, same)
            .withColumn("__inside", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
            .join(offsets, (F.col("_source_no") == F.col("__no")) & (F.col("__bucket") == F.col("__b")))
            .withColumn("_before", F.col("__offset") + F.col("__inside")))
    epochs = F.coalesce(F.floor(F.col("_target") / F.nullif(F.col("_source_size"), F.lit(0))), F.lit(0))
    rest = F.col("_target") - epochs * F.col("_source_size")
    # once more, if at least half of the document is within the rest
    more = F.when(F.col("_before") + F.col("_size") / 2 <= rest, 1).otherwise(0)
    readings = F.when(F.col("_size") > 0, epochs + more).otherwise(0).cast("int")
    return rows.withColumn("_readings", readings).select(*[F.col(f"`{c}`") for c in docs.columns], *ADDED)


def position(reading: Column) -> Column:
    """The place in [0, 1] of a reading (0, 1, ...) of a planned document: the inverse of its source's demand."""
    share = F.least(F.lit(1.0), (reading * F.col("_source_size") + F.col("_before") + F.col("_size") / 2)
                    / F.nullif(F.col("_target"), F.lit(0.0)))
    slope = F.element_at(F.array(*[F.lit(x) for x in SLOPES]), (F.col("_source_no") % len(SLOPES) + 1).cast("int"))
    root = F.sqrt((1 - slope) * (1 - slope) + 4 * slope * share)
    return F.when(slope == 0, share).otherwise((root - (1 - slope)) / (2 * slope))


def readings(docs: DataFrame, key: int = KEY, unread: bool = False) -> DataFrame:
    """A row for every reading of every document: plan()'s columns, ``_reading`` and ``_position``.

    With ``unread``, documents that are never read have a row as well, with nulls in these two.
    """
    planned = plan(without(docs, "_reading", "_position"), key)
    planned = planned if unread else planned.where("_readings > 0")
    return (planned.withColumn("_reading", F.explode_outer(F.expr("CASE WHEN _readings > 0 THEN sequence(0, _readings - 1) END")))
            .withColumn("_position", F.when(F.col("_reading").isNotNull(), position(F.col("_reading")))))


def schedule(docs: DataFrame, key: int = KEY) -> DataFrame:
    """What the mix takes of each document: doc_id, source, _size, _source_size, _target, _taken (words) and
    _positions (of its readings, ascending), range-sorted by the first of them, unread documents first.

    A row for every row of ``docs``: rows that repeat a doc_id and its text have a row each.
    """
    one = ["doc_id", "source", "_source_no", "_size", "_source_size", "_target", "_before"]
    # rows that repeat have their readings in common; each of them has a reading 0, or none
    rows = F.count_if(F.coalesce(F.col("_reading"), F.lit(0)) == 0).cast("int")
    order = ["_first", "_source_no", "doc_id"]
    return (readings(docs, key, unread=True)
            .groupBy(*one).agg(rows.alias("_rows"), F.count("_reading").alias("_n"),
                               F.array_sort(F.collect_set("_position")).alias("_positions"))
            .select("doc_id", "source", "_source_no", "_size", "_source_size", "_target",
                    (F.col("_size") * F.expr("_n div _rows")).alias("_taken"), "_positions",
                    F.get("_positions", F.lit(0)).alias("_first"), F.explode(F.array_repeat(F.lit(0), F.col("_rows"))).alias("_row"))
            .repartitionByRange(*order).sortWithinPartitions(*order)
            .drop("_first", "_row", "_source_no"))


def mix(docs: DataFrame, key: int = KEY) -> DataFrame:
    """The documents in training order: a row a reading, range-sorted by position, with the columns of ``docs``."""
    plain, restored = shielded(docs, "doc_id", "source", "text")
    order = ["_position", "_source_no", "doc_id", "_reading"]
    return restored(readings(plain, key).repartitionByRange(*order).sortWithinPartitions(*order))
