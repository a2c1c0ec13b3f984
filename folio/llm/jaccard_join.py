"""N-gram Jaccard join (7): a count-vector R-tree under rare shingles.

A document's set is its distinct ``SHINGLE``-word shingles (64-bit hashes);
two documents link when their Jaccard similarity is ``THRESHOLD_PCT`` percent
or more.  The result is the connected components of all links.

*Points.*  The shingles are hashed into groups and a document becomes the point
of its counts by group: in about as many groups as it has shingles, and, added
up, in ``GROUPS`` groups for the boxes.  For two points, and likewise for the
upper corners of two bounding boxes, the sum of the smaller coordinates bounds
the overlap of the sets from above.

*Tree.*  Bounding boxes over random texts overlap in every coordinate, so a
tree over all points would compare all with all.  The root therefore branches
by shingle: in the order "rare first" (a bounded list of frequent shingles
comes last; else by hash), documents that link share one of their first
``n - ceil(0.8 n) + 1`` shingles, so no pair is lost.  The branch of a shingle
is packed into leaves by component and size.

*Join.*  Documents with equal sets are one point.  In each branch every point
is first compared with the branch's first point only; most groups of copies
are one component after that, in linear time.  What is still to be known is
whether points of *different* components link.  For branches with three
points or more of several components, leaves of unlike components are
compared by their boxes, then the points, and the pairs that survive are
verified on the whole sets.  Large branches are cut into tiles and the tiles
joined pairwise, so that a task holds two tiles at most.

Defined results: a text without words, or null, has an empty set, links with
nothing and is its own component; a text of one to four words is one shingle;
rows that repeat a doc_id are one document; null ids are one document, whose
component is null if it links with no other.  Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm import bitfilter
from folio.llm.columns import shielded
from folio.llm.components import connected_components
from folio.llm.words import (as_bytes, blocks, mix, signed, split_words, whole_windows, window_hashes,
                             word_hashes)
from folio.session import scratch_path

SHINGLE = 5
THRESHOLD_PCT = 80
#: Groups of the boxes, and at most of a point.
GROUPS_LOG2 = 7
GROUPS = 1 << GROUPS_LOG2
MAX_GROUPS_LOG2 = 16
LEAF = 16
TILE = 1024
#: Frequent shingles come last in the order: those in so many documents, at most so many of them.
FREQUENT_DOCS = 100
FREQUENT_MAX = 1 << 16

_NULL_ID = -(1 << 63)
_ID = f"coalesce(cast(doc_id AS long), {_NULL_ID + 1}L - 1L)"
#: Ids that several texts share are broadcast up to this number, and merge-joined beyond it.
BROADCAST_IDS = 1_000_000


def shingle_sets(texts: list[bytes | None], shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = split_words(texts, lower=True)
    hashes = word_hashes(words)
    windows = window_hashes(hashes, shingle)
    out = []
    for low, high in zip(words.ptr[:-1], words.ptr[1:]):
        n = high - low
        if n >= shingle:
            out.append(np.unique(windows[low:high - shingle + 1]))
        elif n:
            out.append(window_hashes(hashes[low:high], n) + np.uint64(n))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def _prefix_sizes(n: np.ndarray) -> np.ndarray:
    return n - (THRESHOLD_PCT * n + 99) // 100 + 1


def _pack(tokens: np.ndarray) -> bytes:
    """A point: counts in a power of two of groups, as many as shingles or more; 4 bits each where that does.

    A group is the shingles with the same leading bits, so that neighbouring
    groups add up to those of a coarser point.
    """
    bits = min(MAX_GROUPS_LOG2, max(GROUPS_LOG2, (len(tokens) - 1).bit_length()))
    counts = np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    top = counts.max()
    if top < 16:
        return bytes([bits, 0]) + (counts[::2] | counts[1::2] << 4).astype("<u1").tobytes()
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4
    return bytes([bits, width]) + counts.astype(f"<u{width}").tobytes()


def _counts(point: bytes) -> np.ndarray:
    data = np.frombuffer(point, dtype=f"<u{point[1] or 1}", offset=2)
    if point[1]:
        return data
    out = np.empty(2 * len(data), dtype=np.uint8)
    out[::2], out[1::2] = data & 15, data >> 4
    return out


def _coarse(points: list[bytes]) -> np.ndarray:
    """The points in ``GROUPS`` groups each."""
    out = np.zeros((len(points), GROUPS), dtype=np.int32)
    for i, p in enumerate(points):
        out[i] = _counts(p).reshape(GROUPS, -1).sum(axis=1)
    return out


def _most(x: np.ndarray, y: np.ndarray) -> int:
    """The bound on the overlap of two points' sets, in the coarser's groups."""
    if len(x) > len(y):
        x, y = y, x
    if len(y) > len(x):
        y = y.reshape(len(x), -1).sum(axis=1)
    return int(np.minimum(x, y).sum(dtype=np.int64))


def _needed(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The smallest overlap with which sets of these sizes link."""
    return -(-THRESHOLD_PCT * (n_a + n_b) // (100 + THRESHOLD_PCT))


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of frequent shingles (``FREQUENT_MAX`` at most).

    They only order the shingles, so an inexact list is as right as an exact
    one.  Each block of texts reports shingles that several of its documents hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(0))
            for low, high in blocks(texts):
                values, counts = np.unique(np.concatenate(shingle_sets(texts[low:high])), return_counts=True)
                often = counts >= 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(values[often])), pa.array(counts[often], pa.int64())], names=["token", "docs"])

    rows = (docs.select("text").mapInArrow(run, "token long, docs long")
            .groupBy("token").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= FREQUENT_DOCS)
            .orderBy(F.desc("docs"), "token").limit(FREQUENT_MAX).select("token").toPandas())
    return np.sort(rows["token"].to_numpy(dtype=np.int64).view(np.uint64))


def document_points(docs: DataFrame, frequent: Broadcast) -> DataFrame:
    """One row a document: its set's size and fingerprint, its point and its branches (prefix shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for low, high in blocks(texts):
                sizes, digests, points, prefixes = [], [], [], []
                for tokens in shingle_sets(texts[low:high]):
                    n = len(tokens)
                    sizes.append(n)
                    digests.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                    points.append(_pack(tokens))
                    if len(often):
                        last = often[np.minimum(np.searchsorted(often, tokens), len(often) - 1)] == tokens
                        tokens = np.concatenate([tokens[~last], tokens[last]])
                    prefixes.append(tokens[:_prefix_sizes(np.int64(n))].tobytes() if n else b"")
                prints = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(sizes, pa.int64()),
                     pa.array(np.ascontiguousarray(prints[:, 0])), pa.array(np.ascontiguousarray(prints[:, 1])),
                     pa.array(points, pa.binary()), pa.array(prefixes, pa.binary())],
                    names=["doc_id", "n", "f1", "f2", "point", "prefix"])

    return docs.select(F.expr(_ID).alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, f1 long, f2 long, point binary, prefix binary")


def _branches(reps: DataFrame, held: Broadcast | None = None) -> DataFrame:
    """(token, rep, n) for each branch a representative belongs to; only of tokens in the filter, if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prefixes = b.column(2).to_pylist()
            sizes = np.array([len(p) // 8 for p in prefixes], dtype=np.int64)
            tokens, row = np.frombuffer(b"".join(prefixes), dtype=np.int64), np.repeat(np.arange(b.num_rows), sizes)
            if held is not None:
                go = bitfilter.holds(held.value, tokens)
                tokens, row = tokens[go], row[go]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens), *(pa.array(b.column(k).to_numpy(zero_copy_only=False)[row], pa.int64()) for k in (0, 1))],
                names=["token", "rep", "n"])

    return reps.select("rep", "n", "prefix").mapInArrow(run, "token long, rep long, n long")


def _bounded(pairs: DataFrame) -> DataFrame:
    """The pairs (a, b, n_a, n_b, p_a, p_b) whose points allow the overlap they need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_a, n_b = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            most = [_most(_counts(x), _counts(y)) for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist())]
            keep = pa.array(np.array(most, dtype=np.int64) >= _needed(n_a, n_b))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])

    return pairs.select("a", "b", "n_a", "n_b", "p_a", "p_b").mapInArrow(run, "a long, b long")


def _leaf_join(rep: np.ndarray, part: np.ndarray, n: np.ndarray, packed: list[bytes], side: np.ndarray,
               one_tile: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of unlike components that may link: by boxes of leaves, by coarse points, then by whole ones."""
    order = np.lexsort((n, part, side))
    rep, part, n, side = rep[order], part[order], n[order], side[order]
    packed = [packed[k] for k in order]
    points, whole = _coarse(packed), {}
    new = np.ones(len(rep), dtype=bool)
    new[1:] = (part[1:] != part[:-1]) | (side[1:] != side[:-1])
    run_start = np.maximum.accumulate(np.where(new, np.arange(len(rep)), 0))
    head = np.flatnonzero((np.arange(len(rep)) - run_start) % LEAF == 0)
    tail = np.append(head[1:], len(rep))
    upper = np.maximum.reduceat(points, head, axis=0)
    low, high = n[head], n[tail - 1]
    left, right = [], []
    for i in range(len(head)):
        others = np.arange(i + 1, len(head)) if one_tile else np.flatnonzero(side[head] > side[head[i]])
        others = others[part[head[others]] != part[head[i]]]
        others = others[(100 * high[i] >= THRESHOLD_PCT * low[others]) & (100 * high[others] >= THRESHOLD_PCT * low[i])]
        if not len(others):
            continue
        most = np.minimum(upper[others], upper[i]).sum(axis=1)
        others = others[most >= _needed(low[others], low[i])]
        for j in others:
            x, y = points[head[i]:tail[i]], points[head[j]:tail[j]]
            n_x, n_y = n[head[i]:tail[i], None], n[None, head[j]:tail[j]]
            overlap = np.minimum(x[:, None, :], y[None, :, :]).sum(axis=2)
            fits = ((overlap >= _needed(n_x, n_y)) & (100 * n_x >= THRESHOLD_PCT * n_y)
                    & (100 * n_y >= THRESHOLD_PCT * n_x))
            for a, b in np.argwhere(fits) + (head[i], head[j]):
                for k in (a, b):
                    if k not in whole:
                        whole[k] = _counts(packed[k])
                if _most(whole[a], whole[b]) >= _needed(n[a], n[b]):
                    left.append(rep[a])
                    right.append(rep[b])
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


def _tree_pairs(members: DataFrame) -> DataFrame:
    """Candidate pairs of unlike components, from members (token, i, j, tile, rep, part, n, point).

    Rows arrive sorted by (token, i, j): a group is the members of two tiles
    of one branch, TILE rows each on average.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def join(rows: pa.Table) -> pa.RecordBatch:
            c = [rows.column(k).to_numpy() for k in range(7)]
            a, b = _leaf_join(c[4], c[5], c[6], rows.column(7).to_pylist(), c[3], bool(c[1][0] == c[2][0]))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            keys = [rows.column(k).to_numpy() for k in range(3)]
            new = np.zeros(rows.num_rows, dtype=bool)
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            if held and any(k[0] != held[0].column(i)[0].as_py() for i, k in enumerate(keys)):
                yield join(pa.concat_tables(held))
                held = []
            cuts = [0, *np.flatnonzero(new).tolist(), rows.num_rows]
            for low, high in zip(cuts[:-1], cuts[1:]):
                held.append(rows.slice(low, high - low))
                if high < rows.num_rows:
                    yield join(pa.concat_tables(held))
                    held = []
        if held:
            yield join(pa.concat_tables(held))

    return members.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, path: str) -> DataFrame:
    """The pairs (a, b) of documents whose sets link; written to ``path``."""
    spark = docs.sparkSession
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    held = bitfilter.build(nodes.select(F.xxhash64("node").alias("key")), "key")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.ascontiguousarray(b.column(1).to_numpy(zero_copy_only=False))
            rows = b.filter(pa.array(bitfilter.holds(held.value, keys)))
            texts = as_bytes(rows.column(2))
            for low, high in blocks(texts):
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).slice(low, high - low),
                     pa.array([s.tobytes() for s in shingle_sets(texts[low:high])], pa.binary())],
                    names=["node", "tokens"])

    (docs.select(F.expr(_ID).alias("node"), F.xxhash64(F.expr(_ID)).alias("key"), "text")
     .mapInArrow(sets, "node long, tokens binary").write.parquet(f"{path}/sets"))
    tokens = spark.read.parquet(f"{path}/sets")
    both = (pairs.join(tokens.select(F.col("node").alias("a"), F.col("tokens").alias("t_a")), "a")
            .join(tokens.select(F.col("node").alias("b"), F.col("tokens").alias("t_b")), "b"))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * shared >= THRESHOLD_PCT * (len(x) + len(y) - shared))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])

    both.select("a", "b", "t_a", "t_b").mapInArrow(test, "a long, b long").write.parquet(f"{path}/links")
    held.unpersist()
    return spark.read.parquet(f"{path}/links")


def similar_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "jaccard")

    def saved(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    often = spark.sparkContext.broadcast(frequent_shingles(docs))  # FREQUENT_MAX longs at most
    rows = saved(document_points(docs, often), "rows")
    reps = saved(rows.where("n > 0").groupBy("f1", "f2")
                 .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("point").alias("point"),
                      F.first("prefix").alias("prefix")), "reps")
    points = reps.select("rep", "n", "point")

    # branches that several representatives share, one of each set of members
    all_branches = _branches(reps)
    shared = all_branches.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    held = bitfilter.build(shared, "token")
    branches = saved(_branches(reps, held), "branches")
    first = F.min(F.struct("rep", "n"))
    heads = (branches.groupBy("token")
             .agg(F.count("*").alias("c"), first.alias("head"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("s1"),
                  F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("s2"))
             .where("c > 1").groupBy("c", "head", "s1", "s2").agg(F.min("token").alias("token")))
    heads = saved(heads.select("token", "c", F.col("head.rep").alias("center"), F.col("head.n").alias("n_c")), "heads")
    held.unpersist()

    # every member against its branch's first
    star = (branches.join(heads.hint("merge"), "token").where("rep <> center")
            .where(f"100 * least(n, n_c) >= {THRESHOLD_PCT} * greatest(n, n_c)")
            .select(F.col("rep").alias("b"), F.col("center").alias("a"), F.col("n").alias("n_b"),
                    F.col("n_c").alias("n_a")).distinct())
    star = _bounded(star.join(points.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("point").alias("p_a")),
                              ["a", "n_a"])
                    .join(points.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("point").alias("p_b")),
                          ["b", "n_b"]))
    links = _verified(saved(star.distinct(), "star"), docs, f"{path}/first")
    parts = saved(connected_components(links), "parts")

    # branches with points of several components
    placed = saved(branches.join(heads.where("c > 2").select("token", "c").hint("merge"), "token")
                   .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
                   .select("token", "c", "rep", "n", F.coalesce("component", "rep").alias("part")), "placed")
    open_ = (placed.groupBy("token").agg(F.min("part").alias("p0"), F.max("part").alias("p1")).where("p0 < p1")
             .select("token"))
    tiles = F.ceil(F.col("c") / TILE).cast("int")
    open_ = saved(open_, "open")
    members = (placed.join(open_.hint("merge"), "token")
               .withColumn("tiles", tiles)
               .withColumn("tile", F.expr("CAST(pmod(xxhash64(rep), tiles) AS INT)"))
               .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
               .withColumn("i", F.least("tile", "other")).withColumn("j", F.greatest("tile", "other"))
               .join(points, ["rep", "n"])
               .select("token", "i", "j", "tile", "rep", "part", "n", "point"))
    part = F.coalesce("component", "rep")
    classes = (reps.select("f1", "f2", "rep").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
               .select("f1", "f2", part.alias("component")))
    if not open_.isEmpty():
        pairs = _tree_pairs(members.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j"))
        late = _verified(saved(pairs.distinct(), "late"), docs, f"{path}/second")
        # late links are between components of the first, or documents without any
        for end in ("a", "b"):
            late = (late.join(parts.select(F.col("node").alias(end), "component"), end, "left")
                    .withColumn(end, F.coalesce("component", end)).drop("component"))
        merged = saved(connected_components(late).withColumnRenamed("component", "merged"), "merged")
        classes = (classes.join(merged.withColumnRenamed("node", "component"), "component", "left")
                   .select("f1", "f2", F.coalesce("merged", "component").alias("component")))
    named = rows.select("doc_id", "n", "f1", "f2").join(classes, ["f1", "f2"], "left")
    null_id = F.lit(_NULL_ID + 1) - 1
    return named.select(
        F.nullif("doc_id", null_id).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.nullif(F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")), null_id).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, that of the smallest doc_id, with all its columns.

    Of rows that repeat a doc_id and its text, one stays.  Rows with the doc_id of
    another text are judged by their own text, after all documents with ids of
    their own.  A row without an id goes by its text: copies of a document that
    has an id give way to it.  Documents without words stay.
    """
    plain, restored = shielded(docs, "doc_id", "text")
    # ids of its own, above all others, for a row that has none or shares it with another text
    own = (1 << 62) + F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 62))
    shared = (plain.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__shared"))
              .agg(F.min(F.xxhash64("text")).alias("__least"), F.max(F.xxhash64("text")).alias("__most"))
              .where("__least <> __most").drop("__most"))
    shared.write.parquet(path := scratch_path(docs.sparkSession, "shared-ids"))
    shared = docs.sparkSession.read.parquet(path)
    shared = F.broadcast(shared) if shared.count() <= BROADCAST_IDS else shared.hint("merge")
    plain = plain.join(shared, F.col("doc_id") == F.col("__shared"), "left")
    plain = plain.withColumn("__id", F.when(
        F.col("doc_id").isNull() | (F.xxhash64("text") != F.col("__least")), own).otherwise(F.col("doc_id").cast("long")))
    plain = plain.drop("__shared", "__least")
    similar = similar_documents(plain.select(F.col("__id").alias("doc_id"), "text"))
    losers = similar.where("component_id <> doc_id").select(F.col("doc_id").alias("__loser")).distinct()
    kept = plain.join(losers, F.col("__id") == F.col("__loser"), "left_anti")
    again = F.row_number().over(Window.partitionBy("__id", F.xxhash64("text")).orderBy(F.lit(0)))
    return restored(kept.withColumn("__again", again).where("__again = 1"))
