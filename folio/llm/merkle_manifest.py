"""Merkle dataset manifest (13): a hash tree per group of rows, by lag and lead windows.

Leaves are numbered within their group.  On each level, every ``FAN`` nodes in
a row are a run: lag and lead columns at fixed offsets, masked by a node's slot
in its run and by the run's length, give each node its siblings to the left and
right, and the first node of a run hashes it to the parent.  A level with one
node is the group's ``subroot``; the subroots, in the groups' order, are the
leaves of one more tree, whose top is ``root``.

*Scale.*  Runs never cross a block of ``BLOCK`` positions, so windows are
partitioned by (group, block) and a group that holds most rows is spread over
all tasks.  Rows are numbered by one range sort: positions within a partition
plus the counts of the partitions before it.  Every level is a written table,
an eighth of the one below, so a lost executor repeats part of one level; the
driver sees the two numbers that give the heights, and the root.  Paths go from
the top down, each joined to at most ``FAN`` children.

*Verification.*  ``proofs`` gives each row the siblings from its leaf to the
root, ``fold`` recomputes the root from a leaf and these.

Defined results: a null in a hashed column is ``-``, an empty text ``0:``; null
groups and null order values come first; rows that tie in the order column
ascend by leaf, and equal rows are equal leaves side by side; a table without
rows has no root (null) and no proofs.  Only the columns that are named are read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.session import scratch_path

FAN = 8
BLOCK = FAN ** 3


class Manifest(NamedTuple):
    """``levels[0]`` holds the leaves with their payload; ``top`` the same over the groups' subroots."""

    root: str | None
    groups: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]


def field(column: Column) -> Column:
    """A value as it enters a hash: ``-`` if null, else its UTF-8 length, a colon and itself."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*columns: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def _written(frame: DataFrame, name: str) -> DataFrame:
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _numbered(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``part``, ``at``; and for each (group, part) its first ``at``, and the group's rows before and in all."""
    keys = [F.col(c).asc_nulls_first() for c in [group, *order]]
    sorted_rows = _written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "merkle-order")
    parts = sorted_rows.groupBy(group, "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    own = Window.partitionBy(group)  # one row a partition of the sort
    before = F.sum("rows").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = _written(parts.select(group, "part", "first", F.coalesce(before, F.lit(0)).alias("before"),
                                  F.sum("rows").over(own).alias("n")), "merkle-parts")
    return sorted_rows, parts


def _positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, 0-based in their group, and ``n``, its rows."""
    numbered, parts = _numbered(rows, group, order)
    parts = parts.withColumnsRenamed({group: "__group", "part": "__part"})
    return (numbered.join(parts, F.col(group).eqNullSafe(F.col("__group")) & (F.col("part") == F.col("__part")))
            .withColumn("pos", F.col("at") - F.col("first") + F.col("before"))
            .drop("__group", "__part", "part", "at", "first", "before"))


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` (gid, pos, n, hash) with the hashes ``left`` and ``right`` of them in their run."""
    block = Window.partitionBy("gid", F.floor(F.col("pos") / BLOCK)).orderBy("pos")
    slot = F.pmod("pos", F.lit(FAN))
    run = F.least(F.lit(FAN), F.col("n") - (F.col("pos") - slot))

    def masked(near: Column, inside: Column) -> Column:
        return F.when(inside, near).otherwise("")

    left = [masked(F.lag("hash", j).over(block), slot >= j) for j in range(FAN - 1, 0, -1)]
    right = [masked(F.lead("hash", j).over(block), slot + j < run) for j in range(1, FAN)]
    return nodes.withColumn("left", F.concat(*left)).withColumn("right", F.concat(*right))


def _levels(nodes: DataFrame, most: int) -> list[DataFrame]:
    """The levels from ``nodes`` up, as written tables; ``most`` is the largest group's count."""
    out = []
    while True:
        out.append(_written(_with_siblings(nodes), f"merkle-level{len(out)}"))
        if most <= 1:
            return out
        most = -(-most // FAN)
        nodes = (out[-1].where((F.col("n") > 1) & (F.pmod("pos", F.lit(FAN)) == 0))
                 .select("gid", F.floor(F.col("pos") / FAN).alias("pos"), F.ceil(F.col("n") / FAN).alias("n"),
                         F.sha2(F.concat("hash", "right"), 256).alias("hash")))


def _tops(levels: list[DataFrame]) -> DataFrame:
    """(gid, hash): the one node that remains of each group."""
    out = levels[0].where("n = 1").select("gid", "hash")
    for level in levels[1:]:
        out = out.union(level.where("n = 1").select("gid", "hash"))
    return out


def build(rows: DataFrame, group: str, order: str, leaf: str, keep: list[str] | None = None) -> Manifest:
    """The manifest of ``rows`` by the hashes in column ``leaf``; columns in ``keep`` stay with the leaves."""
    keep = list(keep or [])
    narrow = rows.select(F.col(f"`{group}`").alias("__g"), F.col(f"`{order}`").alias("__o"),
                         F.col(f"`{leaf}`").alias("hash"),
                         F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row") if keep
                         else F.struct(F.lit(None).cast("int").alias("none")).alias("row"))
    placed = _positions(narrow, "__g", ["__o", "hash"])
    groups = placed.groupBy("__g", "n").agg(F.lit(0).alias("__all"))
    groups = _written(_positions(groups.withColumnRenamed("n", "rows"), "__all", ["__g"])
                      .select("__g", "rows", F.col("pos").alias("gid")), "merkle-groups")
    count, most = groups.agg(F.count("*"), F.max("rows")).first()
    named = groups.select(F.col("__g").alias("__name"), "gid")
    leaves = (placed.join(named, F.col("__g").eqNullSafe(F.col("__name")))
              .select("gid", "pos", "n", "hash", "row"))
    levels = _levels(leaves, most or 0)
    top = _levels(_tops(levels).select(F.lit(0).cast("long").alias("gid"), F.col("gid").alias("pos"),
                                       F.lit(count).cast("long").alias("n"), "hash"), count)
    last = _tops(top).first()
    return Manifest(last["hash"] if last else None, groups.withColumnRenamed("__g", group), levels, top)


def _paths(levels: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """(gid, pos, hash, subroot, path) of ``levels[0]``, with its ``row`` if it has one.

    ``above`` (gid, path) continues the path beyond a group's own top; without
    it the path ends there.
    """
    own = F.array(F.struct("left", "right"))
    none = F.array().cast("array<struct<left:string,right:string>>")
    out = None
    for at in range(len(levels) - 1, -1, -1):
        names = ["gid", "pos", "hash", *(["row"] if "row" in levels[at].columns else [])]
        tops = levels[at].where("n = 1").withColumn("subroot", F.col("hash"))
        tops = tops.withColumn("path", none) if above is None else tops.join(above, "gid")
        here = tops.select(*names, "subroot", "path")
        if out is not None:
            parent = out.select("gid", F.col("pos").alias("__run"), "subroot", F.col("path").alias("__up"))
            inner = levels[at].where("n > 1").withColumn("__run", F.floor(F.col("pos") / FAN))
            here = here.union(inner.join(parent, ["gid", "__run"])
                              .select(*names, "subroot", F.concat(own, "__up").alias("path")))
        out = here
    return out


def proofs(manifest: Manifest) -> DataFrame:
    """A row for each leaf: the kept columns, ``leaf``, ``subroot``, ``root`` and ``path`` (siblings, level by level)."""
    above = _paths(manifest.top, None).select(F.col("pos").alias("gid"), "path")
    return _paths(manifest.levels, above).select(
        "row.*", F.col("hash").alias("leaf"), "subroot", F.lit(manifest.root).cast("string").alias("root"), "path")


def path_hash(path: str) -> Column:
    """The hash of all siblings on a path, left to right, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: str, path: str) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, F.col(leaf),
                       lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))
