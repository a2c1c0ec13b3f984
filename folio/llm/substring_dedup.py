"""Substring dedup (5): seed and extend on winnowed anchors.

A window is ``WINDOW`` consecutive words of one text.  Every window has one
anchor: of its ``SEED``-word seeds, the one with the smallest hash (the first
of equals), so equal windows have equal anchors at equal offsets, and about
one seed in twenty is an anchor at all.

1. *Seeds.*  Seeds of anchors in two documents at least are found by a grouped
   count; a bit filter of fixed size over them keeps the other anchors from
   being shuffled with their windows.
2. *Extend.*  Each such anchor carries the hashes of the windows that have it
   as anchor, by offset: where two anchors' hashes agree at an offset, the
   match extends that far to the left and right.  Every anchor is extended
   against one occurrence only, the seed's first one in its smallest
   document, so a group of n copies costs n comparisons and not n * n.
3. *The rest.*  Windows that differ from that occurrence, or stand in its
   document, may still repeat elsewhere; they are grouped by window hash for
   the smallest document holding them.  This is exact whatever the size of a
   group, and the partial aggregates keep hot windows small.
4. *Maximal repeats.*  A document's matched windows are merged into maximal
   spans, and the words they cover are removed.

A word goes if a matched window covers it: one whose words also stand, in
that order, in a document with a smaller doc_id.  Windows are judged on the
input.  Windows are compared by 64-bit hashes of 64-bit word hashes, and only
among those with equal seeds' hashes.

Defined results: a text with fewer than ``WINDOW`` words, an empty or a null
text loses nothing; null ids count as the smallest id; rows that repeat a
doc_id are one document, which never loses words to itself, and each row is
cut on its own.  Other columns pass through untouched, but for those that have
the name of an added one, which are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.llm import bitfilter
from folio.llm.columns import without
from folio.llm.words import (as_bytes, blocks, signed, split_words, whole_windows, window_hashes,
                             word_hashes)
from folio.session import scratch_path

WINDOW = 50
SEED = 10

#: Null ids sort first.
_ID = "coalesce(cast(doc_id AS long), -9223372036854775808L)"


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, a key that tells rows of one doc_id with unlike texts apart, and the text."""
    return docs.select(F.expr(_ID).alias("doc_id"), F.xxhash64("text").alias("row_key"), F.col("text"))


def _argmin_windows(x: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values, the position of its first smallest value."""
    n = len(x) - width + 1
    best = np.arange(len(x))
    span = 1
    while span < width:
        step = min(span, width - span)
        left, right = best[:len(best) - step], best[step:]
        best = np.where(x[right] < x[left], right, left)
        span += step
    return best[:n]


def _anchors(docs: DataFrame, schema: str, window: int, seed: int, make) -> DataFrame:
    """Runs ``make(ids, keys, Found)`` on each block of texts that has whole windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            texts = as_bytes(batch.column(2))
            for low, high in blocks(texts):
                found = _find(texts[low:high], window, seed)
                if found is not None:
                    out = make(ids[low:high], keys[low:high], found)
                    if out.num_rows:
                        yield out

    return _rows(docs).mapInArrow(run, schema)


class _Found(NamedTuple):
    """Anchors of a block of texts, in order; the windows of anchor a are those from begin[a] to end[a]."""

    seed: np.ndarray
    doc: np.ndarray
    pos: np.ndarray
    first: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    windows: np.ndarray


def _find(texts: list[bytes | None], window: int, seed: int) -> _Found | None:
    words = split_words(texts)
    inside = np.flatnonzero(whole_windows(words.ptr, len(words.starts), window))
    if not len(inside):
        return None
    hashes = word_hashes(words)
    seeds = window_hashes(hashes, seed)
    at = _argmin_windows(seeds, window - seed + 1)[inside]
    doc = words.doc[inside]
    new = np.ones(len(inside), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    own = words.ptr[doc[begin]]
    return _Found(seeds[at[begin]], doc[begin], at[begin] - own, inside[begin] - own, begin,
                  np.append(begin[1:], len(inside)), window_hashes(hashes, window)[inside])


def seed_documents(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(seed, doc_id) of every anchor."""

    def make(ids: np.ndarray, keys: np.ndarray, found: _Found) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(signed(found.seed)), pa.array(ids[found.doc], pa.int64())], names=["seed", "doc_id"])

    return _anchors(docs, "seed long, doc_id long", window, seed, make)


def shared_anchors(docs: DataFrame, shared: Broadcast, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """The anchors whose seed passes the filter, with the hashes of their windows.

    ``windows[i]`` is the hash of the window that starts at word ``first + i``.
    """

    def make(ids: np.ndarray, keys: np.ndarray, found: _Found) -> pa.RecordBatch:
        go = bitfilter.holds(shared.value, found.seed)
        sizes = (found.end - found.begin)[go]
        offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
        np.cumsum(sizes * 8, out=offsets[1:])
        kept = found.windows[np.repeat(go, found.end - found.begin)]
        windows = pa.BinaryArray.from_buffers(
            pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(kept.tobytes())])
        doc = found.doc[go]
        return pa.RecordBatch.from_arrays(
            [pa.array(signed(found.seed[go])), pa.array(ids[doc], pa.int64()), pa.array(keys[doc], pa.int64()),
             pa.array(found.pos[go], pa.int32()), pa.array(found.first[go], pa.int32()), windows],
            names=["seed", "doc_id", "row_key", "pos", "first", "windows"])

    return _anchors(docs, "seed long, doc_id long, row_key long, pos int, first int, windows binary",
                    window, seed, make)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All window hashes of a binary column, and each row's number of them."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=np.int64), np.array([len(v) // 8 for v in values], dtype=np.int64)


def extend(pairs: DataFrame) -> DataFrame:
    """Extend each anchor against its seed's owner, both ways.

    Gives the matched runs (``n`` windows from word ``start``, hash null) and,
    one row each, the windows that the owner does not settle (with hash).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            num = {n: c[n].to_numpy(zero_copy_only=False) for n in c if not n.endswith("windows")}
            mine, n_mine = _flat(c["windows"])
            theirs, n_theirs = _flat(c["o_windows"])
            row = np.repeat(np.arange(b.num_rows), n_mine)
            at = np.arange(len(mine)) - np.repeat(np.cumsum(n_mine) - n_mine, n_mine)
            start = num["first"][row] + at
            # windows align by their distance from the anchor
            shift = (num["o_pos"] - num["o_first"]) - (num["pos"] - num["first"])
            partner = at + shift[row]
            aligned = (partner >= 0) & (partner < n_theirs[row])
            place = (np.cumsum(n_theirs) - n_theirs)[row] + np.where(aligned, partner, 0)
            same = aligned & (mine == theirs[np.minimum(place, len(theirs) - 1)])
            same_doc = num["doc_id"] == num["o_doc"]
            owner = same_doc & (num["row_key"] == num["o_key"]) & (num["pos"] == num["o_pos"])
            matched = same & ~same_doc[row]
            edge = np.ones(len(mine), dtype=bool)
            edge[1:] = (row[1:] != row[:-1]) | (matched[1:] != matched[:-1])
            heads = np.flatnonzero(edge)
            sizes = np.diff(np.append(heads, len(mine)))
            runs, sizes = heads[matched[heads]], sizes[matched[heads]]
            rest = np.flatnonzero(~matched & ~owner[row])
            pick = np.concatenate([runs, rest])
            hashes = pa.array(mine[pick], pa.int64(), mask=np.arange(len(pick)) < len(runs))
            yield pa.RecordBatch.from_arrays(
                [pa.array(num["doc_id"][row[pick]], pa.int64()), pa.array(num["row_key"][row[pick]], pa.int64()),
                 pa.array(start[pick], pa.int32()),
                 pa.array(np.concatenate([sizes, np.ones(len(rest), dtype=np.int64)]), pa.int32()), hashes],
                names=["doc_id", "row_key", "start", "n", "hash"])

    return pairs.mapInArrow(run, "doc_id long, row_key long, start int, n int, hash long")


def repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc_id, row_key, start, n): n windows from word ``start`` on also stand in a smaller doc_id."""
    spark = docs.sparkSession
    twice = (seed_documents(docs, window, seed).groupBy("seed")
             .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high"))
    shared = bitfilter.build(twice.select("seed"), "seed")
    path = scratch_path(spark, "anchors")
    shared_anchors(docs, shared, window, seed).write.parquet(f"{path}/anchors")
    found = spark.read.parquet(f"{path}/anchors")
    place = F.struct("doc_id", "row_key", "pos")
    (found.groupBy("seed")
     .agg(F.min_by(F.struct("doc_id", "row_key", "pos", "first", "windows"), place).alias("o"),
          F.max("doc_id").alias("high"))
     .where("o.doc_id < high")
     .select("seed", F.col("o.doc_id").alias("o_doc"), F.col("o.row_key").alias("o_key"),
             F.col("o.pos").alias("o_pos"), F.col("o.first").alias("o_first"), F.col("o.windows").alias("o_windows"))
     .write.parquet(f"{path}/owners"))
    pairs = found.join(spark.read.parquet(f"{path}/owners").hint("merge"), "seed").drop("seed")
    extend(pairs).write.parquet(f"{path}/extended")
    shared.unpersist()
    extended = spark.read.parquet(f"{path}/extended")
    rest = extended.where("hash IS NOT NULL")
    smallest = (rest.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
                .where("low < high").select("hash", "low"))
    late = rest.join(smallest.hint("merge"), "hash").where("doc_id > low")
    columns = ["doc_id", "row_key", "start", "n"]
    return extended.where("hash IS NULL").select(*columns).union(late.select(*columns))


def cut_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``docs`` with ``_kept_text`` (kept words joined by one space), ``_n_words``, ``_n_removed``
    and ``_spans``, the removed maximal spans as [first word, end) pairs."""
    docs = without(docs, "_kept_text", "_n_words", "_n_removed", "_spans")
    runs = (repeats(docs, window, seed).groupBy("doc_id", "row_key")
            .agg(F.collect_list(F.struct("start", "n")).alias("__runs"))  # bounded by the text's words
            .select(F.col("doc_id").alias("__cut_id"), F.col("row_key").alias("__cut_key"), "__runs"))
    joined = docs.join(runs, (F.expr(_ID) == F.col("__cut_id")) & (F.xxhash64("text") == F.col("__cut_key")), "left")
    names = docs.columns
    joined = joined.select(*[F.col(f"`{c}`") for c in names], F.col("__runs.start").alias("__starts"),
                           F.col("__runs.n").alias("__ns"))
    at = names.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("_kept_text", T.StringType()),
                           T.StructField("_n_words", T.LongType()), T.StructField("_n_removed", T.LongType()),
                           T.StructField("_spans", T.ArrayType(T.ArrayType(T.IntegerType())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            starts, ns = b.column(len(names)), b.column(len(names) + 1)
            texts, n_words, n_removed, spans = [], [], [], []
            for i, text in enumerate(as_bytes(b.column(at))):
                words = (text or b"").split()
                n_words.append(len(words))
                gone = []
                if starts[i].is_valid:
                    first, n = (np.array(x[i].values) for x in (starts, ns))
                    depth = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(depth, first, 1)
                    np.add.at(depth, first + n - 1 + window, -1)
                    inside = np.cumsum(depth) > 0
                    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
                    gone = edges.reshape(-1, 2).tolist()
                    words = [w for w, x in zip(words, inside) if not x]
                texts.append(b" ".join(words))
                n_removed.append(n_words[-1] - len(words))
                spans.append(gone)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(names)], pa.array(texts, pa.binary()).cast(pa.string()),
                 pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.list_(pa.int32())))], names=schema.names)

    return joined.mapInArrow(run, schema)
