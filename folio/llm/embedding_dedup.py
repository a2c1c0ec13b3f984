"""Embedding near-dedup (11): sorted projection passes.

Two vectors link when their cosine, in double precision, is ``THRESHOLD`` or
more.  The result is every vector's number of links and its component.

1. *Classes.*  Equal vectors are one class, with the number of its rows; a
   class is known by a 64-bit hash of its vector.
2. *Passes.*  In each pass a vector gets ``KEY_BITS`` random hashes (the signs of
   random projections), concatenated to one key.  The classes are sorted by key
   over all tasks; each is compared with the next ``WINDOW`` ones, also across
   the borders of tasks, and what its task's verified pairs unite is written as edges.
   The number of passes follows from the number of classes, so that a pair at
   the threshold, away from other vectors, is missed in all of them with a chance of
   ``MISS`` at most (``passes_for``).  Closer pairs and those in groups are missed
   far less often.
3. *Components.*  The passes' edges are united (``components``).
4. *Links.*  Windows are bounded and groups are not, so links are counted by
   component: each member has an angle to its component's centre, and members
   whose angles add up to the threshold's at most link for certain.  So the core
   (half the threshold's angle) is counted by one sum; members
   beyond it are compared with all of their component, in tiles of ``TILE``
   classes, and counted without being listed.

*Scale.*  One shuffle of the vectors a pass, one pass after the other; tasks
stream their rows and hold a chunk and a window of them.  Groups of copies are
collapsed, a dense group of near copies costs linear time; only members outside a core
(wide, chained components) cost their number times the component's.
Keys of equal classes are split by class, so no key is a hot one.

Defined results: vectors that are null, empty, zero or hold a null or non-finite
component link with nothing, and neither do rows without an id: each is its own
component and kept (without an id: component null, kept).  Vectors of unlike
length do not link.  Rows that share an id are vectors of their own and link
if their vectors do; where rows of one id are in one component and it is the
smallest, all are kept.  Columns besides id and vector are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.components import connected_components
from folio.llm.words import give_back
from folio.session import scratch_path

THRESHOLD = 0.95
KEY_BITS = 62
WINDOW = 64
MISS = 0.02
MIN_PASSES = 4
TILE = 1024
SEED = 20_11
#: Angles are compared with this much to spare, so that rounding cannot make a pair certain.
MARGIN = 1e-6


def passes_for(classes: int, threshold: float = THRESHOLD, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold is missed with a chance of ``miss`` at most.

    Two vectors agree in one hash with the chance 1 - angle / pi, and meet in a
    window when they agree in as many as it takes to tell windows apart.
    """
    bits = max(1.0, math.log2(max(2, classes) / window))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return max(MIN_PASSES, math.ceil(math.log(miss) / math.log(1 - meet)))


def unit_rows(vectors: list[np.ndarray]) -> np.ndarray:
    """Vectors of one length as rows of length 1, in double precision."""
    out = np.array(vectors, dtype=np.float64)
    out /= np.abs(out).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> list[np.ndarray]:
    values = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(values, ends[:-1])


def _by_length(vectors: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) for each length that occurs."""
    lengths = np.array([len(v) for v in vectors])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, unit_rows([vectors[i] for i in at])


def classes(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, DataFrame]:
    """(rows with id and node, null where they can't link; classes with node, copies, low id and vector)."""
    v = F.col("vector")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(f"`{id_column}`").alias("id"),
                          F.col(f"`{vector_column}`").cast("array<double>").alias("vector"))
    rows = rows.withColumn("node", F.when(F.col("id").isNotNull() & sound, F.xxhash64("vector")))
    grouped = (rows.where("node IS NOT NULL").groupBy("node")
               .agg(F.count("*").alias("copies"), F.min("id").alias("low"), F.any_value("vector").alias("vector")))
    return rows.select("id", "node"), grouped


def key_maker(number: int, seed: int) -> Callable[[np.ndarray], np.ndarray]:
    """Keys of unit vectors for one pass: the signs of random projections as bits, the first one highest."""
    planes: dict[int, np.ndarray] = {}
    powers = 1 << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64)

    def keys(units: np.ndarray) -> np.ndarray:
        size = units.shape[1]
        if size not in planes:
            planes[size] = np.random.default_rng([seed, number, size]).standard_normal((size, KEY_BITS))
        return (units @ planes[size] > 0) @ powers

    return keys


def _forest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row reachable from each row over pairs (a, b)."""
    label = np.arange(size)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if np.array_equal(before, label):
            break
    while not np.array_equal(label, label[label]):
        label = label[label]
    return label


def _window_edges(nodes: np.ndarray, units: np.ndarray, begin: int, window: int,
                  threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges that unite what verified pairs unite; pairs lie ``window`` rows apart at most, the later row at ``begin`` or on."""
    first, second, step = [], [], 4 * window
    for low in range(max(0, begin - window), len(nodes), step):
        rows, near = units[low:low + step], units[low:low + step + window]
        i, j = np.nonzero(rows @ near.T >= threshold)
        pick = (j > i) & (j - i <= window) & (j + low >= begin)
        first.append(i[pick] + low)
        second.append(j[pick] + low)
    a = np.concatenate(first) if first else np.empty(0, dtype=np.int64)
    b = np.concatenate(second) if second else np.empty(0, dtype=np.int64)
    label = _forest(len(nodes), a, b)
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[moved]], nodes[moved]


PASS_SCHEMA = "a long, b long, part int, at long, border boolean, vector array<double>"


def run_pass(grouped: DataFrame, number: int, window: int = WINDOW, threshold: float = THRESHOLD,
             seed: int = SEED) -> DataFrame:
    """Edges (a, b) of one sorted pass."""
    spark = grouped.sparkSession
    make = key_maker(number, seed)

    def with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, dtype=np.int64)
            for at, units in _by_length(_matrix(batch.column(1))) if batch.num_rows else ():
                out[at] = make(units)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=["node", "vector", "key"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Edges within a task; and the rows near its borders, with their place and, negative, from the end."""
        names = ["a", "b", "part", "at", "border", "vector"]
        seen, part = 0, 0
        tail_nodes, tail = np.empty(0, dtype=np.int64), []
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = batch.column(0).to_numpy(zero_copy_only=False)
            part = batch.column(2)[0].as_py()
            nodes = np.r_[tail_nodes, fresh]
            vectors = tail + _matrix(batch.column(1))
            a, b = [], []
            for at, units in _by_length(vectors):
                x, y = _window_edges(nodes[at], units, int(np.searchsorted(at, len(tail))), window, threshold)
                a.append(x)
                b.append(y)
            a, b = np.concatenate(a), np.concatenate(b)
            n = len(a)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(np.full(n, part), pa.int32()),
                 pa.nulls(n, pa.int64()), pa.array(np.zeros(n, dtype=bool)), pa.nulls(n, pa.list_(pa.float64()))], names=names)
            head = max(0, min(len(fresh), window - seen))
            if head:
                yield border(fresh[:head], vectors[len(tail):len(tail) + head], part, np.arange(seen, seen + head))
            seen += len(fresh)
            tail_nodes, tail = nodes[-window:], vectors[-window:]
        if seen:
            yield border(tail_nodes, tail, part, np.arange(-len(tail), 0))
        give_back()

    def border(nodes: np.ndarray, vectors: list[np.ndarray], part: int, at: np.ndarray) -> pa.RecordBatch:
        n = len(nodes)
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.full(n, part), pa.int32()),
             pa.array(at, pa.int64()), pa.array(np.ones(n, dtype=bool)), pa.array(vectors, pa.list_(pa.float64()))],
            names=["a", "b", "part", "at", "border", "vector"])

    keyed = grouped.select("node", "vector").mapInArrow(with_keys, "node long, vector array<double>, key long")
    placed = keyed.repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    path = scratch_path(spark, f"pass{number}")
    (placed.select("node", "vector", F.spark_partition_id().alias("part"))
     .mapInArrow(compare, PASS_SCHEMA).write.parquet(path))
    out = spark.read.schema(PASS_SCHEMA).parquet(path)
    return out.where("NOT border").select("a", "b").union(_border_edges(out.where("border"), window, threshold))


def _border_edges(rows: DataFrame, window: int, threshold: float) -> DataFrame:
    """Edges between rows of different tasks: ``2 * window`` rows a task at most, grouped by the border they are near to.

    A border's group has the last rows before it and the first ones after it; where tasks
    hold fewer rows than a window, those of the tasks next to them, too.
    """
    sizes = [(r["part"], r["n"]) for r in
             rows.where("at >= 0").groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()]
    near: dict[int, list[int]] = {part: [] for part, _ in sizes}  # the borders that a task's rows may be compared over
    for i in range(len(sizes) - 1):
        for side in (range(i, -1, -1), range(i + 1, len(sizes))):
            reach = 0
            for j in side:
                near[sizes[j][0]].append(i)
                reach += sizes[j][1]
                if reach >= window:
                    break
    order = {part: i for i, (part, _) in enumerate(sizes)}
    spark = rows.sparkSession
    borders = spark.createDataFrame([(p, order[p], b) for p, bs in near.items() for b in bs],
                                    "part int, place int, border_no int")

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        after = group["place"] > key[0]
        group = group[(group["at"] >= 0) == after].sort_values(["place", "at"])
        after = (group["place"] > key[0]).to_numpy()
        cut = int((~after).sum())
        group = pd.concat([group[~after][-window:], group[after][:window]])
        vectors = [np.asarray(v, dtype=np.float64) for v in group["vector"]]
        nodes, cut, out = group["a"].to_numpy(), min(cut, window), []
        for at, units in _by_length(vectors) if len(vectors) else ():
            a, b = _window_edges(nodes[at], units, int(np.searchsorted(at, cut)), window, threshold)
            out.append(pd.DataFrame({"a": a, "b": b}))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []}, dtype="int64")

    return (rows.join(borders, "part").select("border_no", "place", "at", "a", "vector")
            .groupBy("border_no").applyInPandas(compare, "a long, b long"))


def link_counts(members: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(node, links): rows that link with a class's vector, its own rows included; of (component, node, copies, vector)."""
    spark = members.sparkSession
    half = math.acos(threshold) / 2 - MARGIN

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            component = batch.column(0).to_numpy(zero_copy_only=False)
            for at, units in _by_length(_matrix(batch.column(1))):
                keys, which = np.unique(component[at], return_inverse=True)
                total = np.zeros((len(keys), units.shape[1]))
                np.add.at(total, which, units)
                size = units.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(keys, size)), pa.array(np.tile(np.arange(size), len(keys))),
                     pa.array(total.ravel())], names=["component", "axis", "total"])

    centres = (members.select("component", "vector").mapInArrow(sums, "component long, axis long, total double")
               .groupBy("component", "axis").agg(F.sum("total").alias("total"))
               .groupBy("component").agg(F.sort_array(F.collect_list(F.struct("axis", "total"))).alias("c"))
               .select("component", F.col("c.total").alias("centre")))

    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.full(batch.num_rows, np.pi)
            vectors, centre = ((_matrix(batch.column(k)) for k in (3, 4)) if batch.num_rows else ([], []))
            for at, units in _by_length(vectors) if len(vectors) else ():
                mid = np.array([centre[i] for i in at])
                size = np.sqrt((mid * mid).sum(axis=1))
                cos = (units * mid).sum(axis=1) / np.where(size > 0, size, np.inf)
                out[at] = np.arccos(np.clip(cos, -1, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out <= half)],
                                             names=["component", "node", "copies", "vector", "core"])

    placed = _written(members.join(centres, "component").select("component", "node", "copies", "vector", "centre")
                      .mapInArrow(angles, "component long, node long, copies long, vector array<double>, core boolean"),
                      "placed")
    stats = _written(placed.groupBy("component").agg(
        F.sum(F.when(F.col("core"), F.col("copies")).otherwise(0)).alias("core_rows"),
        F.count("*").alias("size"), F.count_if(~F.col("core")).alias("outer_size")), "stats")
    certain = (placed.where("core").select("component", "node").join(stats, "component")
               .select("node", F.col("core_rows").alias("links")))

    # members outside a core against all of their component, tile by tile
    open_stats = stats.where("outer_size > 0").select(
        "component", F.ceil(F.col("size") / tile).alias("tiles"), F.ceil(F.col("outer_size") / tile).alias("outer_tiles"))
    open_rows = placed.join(open_stats, "component").withColumn("own", F.xxhash64("node", F.lit(SEED)))
    left = (open_rows.where("NOT core").withColumn("x", F.pmod("own", "outer_tiles"))
            .withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
            .select("component", "x", "y", "node", "copies", "vector", "core", F.lit(True).alias("query")))
    right = (open_rows.withColumn("y", F.pmod("own", "tiles"))
             .withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("outer_tiles") - 1)))
             .select("component", "x", "y", "node", "copies", "vector", "core", F.lit(False).alias("query")))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        units = unit_rows([np.asarray(v) for v in group["vector"]])
        query = group["query"].to_numpy(dtype=bool)
        core, nodes, copies = (group[c].to_numpy()[~query] for c in ("core", "node", "copies"))
        own, weight = group["node"].to_numpy()[query], group["copies"].to_numpy()[query]
        linked = units[query] @ units[~query].T >= threshold
        linked |= own[:, None] == nodes[None, :]
        out = pd.DataFrame({"node": np.r_[own, nodes[core]],
                            "links": np.r_[linked @ copies, weight @ linked[:, core]]})
        return out[out["links"] > 0]

    verified = left.union(right).groupBy("component", "x", "y").applyInPandas(compare, "node long, links long")
    return certain.union(verified).groupBy("node").agg(F.sum("links").alias("links"))


def _written(frame: DataFrame, name: str) -> DataFrame:
    spark = frame.sparkSession
    path = scratch_path(spark, f"embedding-{name}")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                    threshold: float = THRESHOLD, window: int = WINDOW, passes: int | None = None,
                    seed: int = SEED, tile: int = TILE) -> DataFrame:
    """(id_column, n_links, component_id, kept) for every row of ``vectors``."""
    spark = vectors.sparkSession
    rows, grouped = classes(vectors, id_column, vector_column)
    grouped = _written(grouped, "classes")
    passes = passes_for(grouped.count(), threshold, window) if passes is None else passes
    edges = None
    path = scratch_path(spark, "embedding-edges")
    for number in range(passes):
        run_pass(grouped, number, window, threshold, seed).distinct().write.parquet(f"{path}/pass={number}")
    edges = spark.read.schema("a long, b long").parquet(*[f"{path}/pass={n}" for n in range(passes)]).distinct()
    joined = _written(connected_components(edges), "components")
    members = _written(grouped.join(joined, "node").select("component", "node", "copies", "vector"), "members")
    links = link_counts(members, threshold, tile)
    low = (grouped.select("node", "low").join(joined, "node")
           .groupBy("component").agg(F.min("low").alias("component_id")))
    known = joined.join(links, "node").join(low, "component").select("node", "links", "component_id")
    alone = grouped.where("copies > 1").join(joined, "node", "left_anti").select(
        "node", F.col("copies").alias("links"), F.col("low").alias("component_id"))
    out = rows.join(known.union(alone), "node", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_column), F.coalesce(F.col("links") - 1, F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
