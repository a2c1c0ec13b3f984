"""LM scoring (10): a bigram model in a log-frequency Bloom filter.

*Counting.*  Tasks over the training texts count words and pairs of words and
send them, sorted and pre-aggregated, to partitions by hash range; a
partition merges what it gets.  The number of partitions grows with the
number of documents.

*Filter.*  A count c is kept as level ``1 + floor(log2 c)``, by inserting the
key once for each level up to it.  Each hash range is a segment of its own,
``BITS_PER_INSERT`` bits an insertion, and its keys stay within one 64-bit
word.  Reading a count means probing level after level until one is missing;
errors only ever raise a level.  The filter is broadcast; where it exceeds
``MAX_FILTER_MB``, it is cut into parts of that size, and the texts are probed
in as many passes, one part at a time.

*Score.*  log10 of ``w * q(h, t) / q(h) + (1 - w) * (q(t) + 1) / (N + V + 1)``,
q being the level's mean count, h the previous token or the text's begin.

*Base.*  The add-one unigram score needs exact counts: the ``TOP_WORDS`` most
frequent are broadcast, the others of each text are joined by hash.

Tokens are the words of the text, A-Z lower-cased, and one end.  Documents
whose crc32(doc_id) mod 7 is 2 are held out: scored, but not learned from.

Defined results: a null or empty text is one end token; a null id is not held
out; without training texts N and V are 0 and every score is that of unseen
tokens (the base is 0, as (0 + 1) / (0 + 0 + 1) is 1).  Repeated rows are
counted and scored one by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.words import as_bytes, blocks, mix, signed, split_words, word_hashes
from folio.session import scratch_path

BITS_PER_INSERT = 10
PROBES = 4
MAX_FILTER_MB = 256
TOP_WORDS = 1 << 18
DOCS_PER_RANGE = 2_000
WEIGHT = 0.7
FLUSH_TOKENS = 2_000_000
MAX_LEVEL = 62

END = np.uint64(0x5851F42D4C957F2D)
BEGIN = np.uint64(0x14057B7EF767814F)
_PAIR = np.uint64(0xA24BAED4963EE407)
_LEVEL = np.uint64(0x9FB21C651E98DF25)
_SIX = np.uint64(63)
_ONE = np.uint64(1)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """All tokens' hashes (each text's words, then its end), and where each text begins."""
    words = split_words(texts, lower=True)
    hashes = word_hashes(words)
    ptr = words.ptr + np.arange(len(words.ptr))
    tokens = np.full(ptr[-1], END, dtype=np.uint64)
    tokens[np.arange(len(hashes)) + words.doc] = hashes
    return tokens, ptr


def _pairs(tokens: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """The hash of each token after the one before it."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[ptr[:-1]] = BEGIN
    return mix(before * _PAIR + tokens)


def _count(keys: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their summed counts."""
    every = np.concatenate(keys) if keys else np.empty(0, dtype=np.uint64)
    if counts is None:
        values, n = np.unique(every, return_counts=True)
        return values, n.astype(np.int64)
    order = np.argsort(every)
    every = every[order]
    head = np.flatnonzero(np.append(True, every[1:] != every[:-1])[:len(every)])
    n = np.concatenate(counts)[order] if counts else np.empty(0, dtype=np.int64)
    return every[head], np.add.reduceat(n, head) if len(head) else n


def _count_blobs(docs: DataFrame, range_bits: int) -> DataFrame:
    """Counts of words (kind 0) and of pairs (kind 1), as blobs by hash range."""

    def flush(kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        part = (keys >> np.uint64(63 - range_bits) >> _ONE).astype(np.int64)
        head = np.flatnonzero(np.append(True, part[1:] != part[:-1])[:len(part)])
        tail = np.append(head[1:], len(part))
        return pa.RecordBatch.from_arrays(
            [pa.array(part[head], pa.int64()), pa.array(np.full(len(head), kind), pa.int32()),
             pa.array([keys[a:b].tobytes() for a, b in zip(head, tail)], pa.binary()),
             pa.array([counts[a:b].tobytes() for a, b in zip(head, tail)], pa.binary())],
            names=["part", "kind", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[np.ndarray] = []
        pairs: list[np.ndarray] = []
        size = 0
        for batch in batches:
            texts = as_bytes(batch.column(0))
            for low, high in blocks(texts):
                tokens, ptr = _tokens(texts[low:high])
                words.append(tokens)
                pairs.append(_pairs(tokens, ptr))
                size += len(tokens)
                if size >= FLUSH_TOKENS:
                    yield flush(0, *_count(words))
                    yield flush(1, *_count(pairs))
                    words, pairs, size = [], [], 0
        if size:
            yield flush(0, *_count(words))
            yield flush(1, *_count(pairs))

    return docs.select("text").mapInArrow(run, "part long, kind int, keys binary, counts binary")


def _levels_of(counts: np.ndarray) -> np.ndarray:
    return (np.frexp(counts.astype(np.float64))[1]).astype(np.int64)  # 1 + floor(log2(count))


def _masks(keys: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    x = mix(keys + np.asarray(level).astype(np.uint64) * _LEVEL)
    out = np.zeros_like(x)
    for i in range(PROBES):
        out |= _ONE << ((x >> np.uint64(6 * i)) & _SIX)
    return out


def _word_in_segment(keys: np.ndarray, range_bits: int, n_words: np.ndarray | int) -> np.ndarray:
    rest = (keys << np.uint64(range_bits)) >> np.uint64(32)
    return ((rest * np.asarray(n_words).astype(np.uint64)) >> np.uint64(32)).astype(np.int64)


def _segment(keys: np.ndarray, counts: np.ndarray, range_bits: int) -> np.ndarray:
    """The 64-bit words of one hash range's filter; keys are sorted."""
    levels = _levels_of(counts)
    out = np.zeros(max(1, -(-int(levels.sum()) * BITS_PER_INSERT // 64)), dtype=np.uint64)
    at = _word_in_segment(keys, range_bits, len(out))
    for level in range(1, int(levels.max(initial=0)) + 1):
        has = levels >= level
        where, masks = at[has], _masks(keys[has], level)
        head = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
        out[where[head]] |= np.bitwise_or.reduceat(masks, head)
    return out


def train(docs: DataFrame) -> tuple[DataFrame, int]:
    """The model's partitions (part, word_keys, word_counts, segment), written to shared storage, and the range bits."""
    spark = docs.sparkSession
    range_bits = max(0, min(20, math.ceil(math.log2(max(1, docs.count()) / DOCS_PER_RANGE))))

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        got = []
        for kind in (0, 1):
            own = rows[rows["kind"] == kind]
            got.append(_count([np.frombuffer(k, dtype=np.uint64) for k in own["keys"]],
                              [np.frombuffer(c, dtype=np.int64) for c in own["counts"]]))
        (words, n_words), (pairs, n_pairs) = got
        keys, counts = np.concatenate([words, pairs]), np.concatenate([n_words, n_pairs])
        order = np.argsort(keys)
        segment = _segment(keys[order], counts[order], range_bits)
        return pd.DataFrame({"part": [key[0]], "words": [words.tobytes()], "counts": [n_words.tobytes()],
                             "n": [int(n_words.sum())], "v": [len(words)], "segment": [segment.tobytes()]})

    path = scratch_path(spark, "lm-model")
    (_count_blobs(docs.where(~held_out()), range_bits).groupBy("part")
     .applyInPandas(merge, "part long, words binary, counts binary, n long, v long, segment binary")
     .write.parquet(path))
    return spark.read.parquet(path), range_bits


def word_counts(model: DataFrame) -> DataFrame:
    """(word, c): exact training counts by the word's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for words, counts in zip(b.column(0), b.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(words.as_buffer(), dtype=np.int64)),
                     pa.array(np.frombuffer(counts.as_buffer(), dtype=np.int64))], names=["word", "c"])

    return model.select("words", "counts").mapInArrow(run, "word long, c long")


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words whose counts reach a bound that at most ``most`` of them reach."""
    step = F.floor(F.log2("c") * 16)
    bound = None
    room = most
    # a row for each sixteenth of a doubling
    for row in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        room -= row["count"]
        if room < 0:
            break
        bound = row["step"]
    return counts.where(F.lit(False) if bound is None else step >= bound)


class FilterPart:
    """Consecutive hash ranges of the filter: what one broadcast holds."""

    def __init__(self, sizes: dict[int, int], segments: Iterator[tuple[int, bytes]], range_bits: int) -> None:
        """``sizes``: 64-bit words of each range; the segments come in any order and are not kept."""
        self.range_bits = range_bits
        n = 1 << range_bits
        self.size = np.zeros(n, dtype=np.int64)
        self.size[list(sizes)] = list(sizes.values())
        self.start = np.cumsum(self.size) - self.size
        self.bits = np.zeros(int(self.size.sum()), dtype=np.uint64)
        for part, data in segments:
            self.bits[self.start[part]:self.start[part] + self.size[part]] = np.frombuffer(data, dtype=np.uint64)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Each key's level by repeated probes; 0 if it is absent or of another part."""
        out = np.zeros(len(keys), dtype=np.uint8)
        part = (keys >> np.uint64(63 - self.range_bits) >> _ONE).astype(np.int64)
        live = np.flatnonzero(self.size[part] > 0)
        part = part[live]
        found = self.bits[self.start[part] + _word_in_segment(keys[live], self.range_bits, self.size[part])] \
            if len(live) else np.empty(0, dtype=np.uint64)
        for level in range(1, MAX_LEVEL):
            masks = _masks(keys[live], level)
            hit = (found & masks) == masks
            live, found = live[hit], found[hit]
            if not len(live):
                break
            out[live] = level
        return out


def filter_parts(model: DataFrame, range_bits: int, max_mb: int = MAX_FILTER_MB) -> Iterator[FilterPart]:
    """The filter in parts of at most ``max_mb`` (one hash range at least)."""
    sizes = model.select("part", F.octet_length("segment").alias("size")).orderBy("part").collect()
    groups: list[dict[int, int]] = [{}]
    for row in sizes:
        if groups[-1] and 8 * sum(groups[-1].values()) + row["size"] > max_mb << 20:
            groups.append({})
        groups[-1][row["part"]] = row["size"] // 8
    for own in groups:
        rows = model.where(F.col("part").between(min(own, default=0), max(own, default=-1))).select("part", "segment")
        # a few segments at a time
        yield FilterPart(own, ((r["part"], r["segment"]) for r in rows.toLocalIterator()), range_bits)


#: Mean count of a level's bin [2**(l - 1), 2**l).
_MEAN = np.concatenate([[0.0], (2.0 ** np.arange(MAX_LEVEL) + 2.0 ** (np.arange(MAX_LEVEL) + 1) - 1) / 2])

_STATE = "doc_id long, held_out boolean, text string, uni binary, duo binary"
_SCORED = ("row long, doc_id long, held_out boolean, n_tokens long, top_known long, top_sum double, score double, "
           "tail array<struct<word:long,tf:long>>")
_TAIL = pa.struct([("word", pa.int64()), ("tf", pa.int64())])


def _lookup(words: np.ndarray, top: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Exact counts of the words among the broadcast ones, else 0."""
    keys, counts = top
    if not len(keys):
        return np.zeros(len(words), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
    return np.where(keys[at] == words, counts[at], 0)


def _scores(tokens: np.ndarray, ptr: np.ndarray, uni: np.ndarray, duo: np.ndarray,
            top: tuple[np.ndarray, np.ndarray], n: int, v: int, begins: int) -> dict[str, object]:
    """The columns of _SCORED from n_tokens on, for texts whose tokens' levels are known."""
    texts = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    context = np.empty_like(uni)
    context[1:] = uni[:-1]
    context[ptr[:-1]] = _levels_of(np.array([begins]))[0]
    q_context, q_pair = _MEAN[context], _MEAN[duo]
    follows = np.where(context > 0, np.minimum(q_pair / np.maximum(q_context, 1.0), 1.0), 0.0)
    p = WEIGHT * follows + (1 - WEIGHT) * (_MEAN[uni] + 1) / (n + v + 1)
    words, at = np.unique(tokens, return_inverse=True)
    exact = _lookup(words, top)[at]
    # known words that are not broadcast: a level of 0 proves that a word is not known
    tail = np.flatnonzero((exact == 0) & (uni > 0))
    key = at[tail] + texts[tail] * len(words)
    distinct, tf = np.unique(key, return_counts=True)
    ends = np.searchsorted(distinct, np.arange(len(ptr)) * len(words)).astype(np.int32)
    structs = pa.StructArray.from_arrays(
        [pa.array(signed(words[distinct % max(1, len(words))])), pa.array(tf, pa.int64())], fields=list(_TAIL))
    starts = ptr[:-1]  # no text is without tokens
    return {"n_tokens": np.diff(ptr), "top_known": np.add.reduceat((exact > 0).astype(np.int64), starts),
            "top_sum": np.add.reduceat(np.log10(exact + 1.0), starts), "score": np.add.reduceat(np.log10(p), starts),
            "tail": pa.ListArray.from_arrays(pa.array(ends), structs)}


def _probe(docs: DataFrame, part: Broadcast, last: tuple[Broadcast, int, int, int] | None) -> DataFrame:
    """One pass over the texts: the levels that a part of the filter knows; in the last pass, the scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_, row = part.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = as_bytes(batch.column(2))
            for low, high in blocks(texts):
                tokens, ptr = _tokens(texts[low:high])
                words, at = np.unique(tokens, return_inverse=True)
                levels = [filter_.levels(words)[at], filter_.levels(_pairs(tokens, ptr))]
                own = batch.slice(low, high - low)
                for now, before in zip(levels, own.columns[3:]):
                    if before.null_count < len(before):  # of the passes before this one
                        np.maximum(now, np.frombuffer(b"".join(before.to_pylist()), dtype=np.uint8), out=now)
                if last is None:
                    cut = [pa.array([x[a:b].tobytes() for a, b in zip(ptr[:-1], ptr[1:])], pa.binary()) for x in levels]
                    yield pa.RecordBatch.from_arrays([*own.columns[:3], *cut], names=own.schema.names)
                    continue
                top, n, v, begins = last
                scored = _scores(tokens, ptr, *levels, top.value, n, v, begins)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + high - low)), own.column(0), own.column(1),
                     *(x if isinstance(x, pa.Array) else pa.array(x) for x in scored.values())],
                    names=["row", "doc_id", "held_out", *scored])
                row += high - low

    return docs.mapInArrow(run, _STATE if last is None else _SCORED)


def score_documents(docs: DataFrame, max_filter_mb: int = MAX_FILTER_MB, top_words: int = TOP_WORDS) -> DataFrame:
    """Every document's scores under the model of those that are not held out."""
    spark = docs.sparkSession
    path = scratch_path(spark, "lm-score")
    begins = docs.where(~held_out()).count()
    model, range_bits = train(docs)
    n, v = model.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    counts = word_counts(model)
    frequent = most_frequent(counts, top_words).toPandas()
    keys = frequent["word"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(keys)
    top = spark.sparkContext.broadcast((keys[order], frequent["c"].to_numpy(dtype=np.int64)[order]))

    state = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text",
                        F.lit(None).cast("binary").alias("uni"), F.lit(None).cast("binary").alias("duo"))
    waiting = None
    for turn, part in enumerate(filter_parts(model, range_bits, max_filter_mb)):
        if waiting is not None:
            _probe(state, waiting, None).write.parquet(f"{path}/pass{turn}")
            waiting.unpersist()
            state = spark.read.parquet(f"{path}/pass{turn}")
        waiting = spark.sparkContext.broadcast(part)
        del part
    _probe(state, waiting, (top, n, v, begins)).write.parquet(f"{path}/scored")
    scored = spark.read.parquet(f"{path}/scored")

    tail = (scored.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.tf")
            .join(counts, "word").groupBy("row")
            .agg(F.sum("tf").alias("tail_known"), F.sum(F.col("tf") * F.log10(F.col("c") + 1.0)).alias("tail_sum")))
    known = F.col("top_known") + F.coalesce("tail_known", F.lit(0))
    total = F.col("top_sum") + F.coalesce("tail_sum", F.lit(0.0))
    return (scored.join(tail, "row", "left")
            .select("doc_id", "held_out", "n_tokens", known.alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
                    (total - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"), "score"))
