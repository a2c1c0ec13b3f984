"""Periodic run detection (12): descending-LCP Kruskal over a text's suffixes.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), of ``max(MIN_LENGTH, MIN_REPEATS * q)`` words or more, that no
neighbouring word extends keeping that period.

1. The suffixes of a text are sorted by prefix doubling over word ranks, only
   those that still share a prefix being sorted again; the ranks of every
   doubling give the longest common prefix (LCP) of neighbours.
2. The neighbours are united by decreasing LCP: union-find over classes of
   suffixes, each with its ordered set of positions.  Positions that become
   adjacent at distance q <= LCP share that many words and nothing nearer does,
   so q is the smallest period of the stretch they span.
3. Such a pair seeds a run if the word before does not keep the period; the run
   then is LCP + q words long.

*Scale.*  A text is worked on in one task, whole; texts are independent, so
there is no shuffle at all.  Texts without a repeated window of ``_least_lcp``
words hold no run and are left out before the sort, and a task works on blocks
of a few megabytes, or one text.  Sorting takes O(n log^2 n); unions move each
set's smaller part.  Words are compared by 64-bit hashes.

Defined results: a null or empty text has no words and no runs; texts with too
few words have none; repeated rows are judged each on their own; columns named
like an added one are left out, all others pass through untouched.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.llm.columns import without
from folio.llm.words import as_bytes, blocks, mix, split_words, whole_windows, window_hashes, word_hashes

MIN_LENGTH = 6
MIN_REPEATS = 4

_RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
ADDED = T.StructType([T.StructField("_n_words", T.LongType()), T.StructField("_runs", T.ArrayType(_RUN)),
                      T.StructField("_collapsed", T.StringType())])


def _least_lcp(min_length: int, min_repeats: int) -> int:
    """The least LCP that any run's seed has: over periods q, max(min_length, repeats * q) - q."""
    return min(max(min_length, min_repeats * q) - q for q in range(1, min_length + 1))


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions in lexicographic order of their suffixes, and the ranks by first 1, 2, 4, ... symbols.

    Ranks of prefixes that no other position shares stay as they are once they
    are unique; suffixes that differ nowhere do not occur (ends are unique symbols).
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    values = symbols[order]
    new = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.repeat(new, np.diff(np.r_[new, n])).astype(np.int32)
    levels, k = [rank], 1
    while True:
        group = rank[order]
        same = group[1:] == group[:-1]
        at = np.flatnonzero(np.r_[same, False] | np.r_[False, same])
        if not len(at):
            return order, levels
        live = order[at]
        key = (rank[live].astype(np.int64) << 32) | rank[live + k]
        turn = np.argsort(key, kind="stable")
        live, key = live[turn], key[turn]
        order[at] = live
        first = np.r_[True, key[1:] != key[:-1]]
        rank = rank.copy()
        rank[live] = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))].astype(np.int32)
        levels.append(rank)
        k *= 2


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], least: int) -> np.ndarray:
    """LCP of each suffix with the next in order; those below ``least`` may be given as less than they are."""
    a, b = order[:-1].copy(), order[1:].copy()
    out = np.zeros(len(a), dtype=np.int64)
    floor = min(int(least).bit_length() - 1, len(levels) - 1)
    live = np.flatnonzero(levels[floor][a] == levels[floor][b])
    for at in range(len(levels) - 1, -1, -1):
        x, y = a[live], b[live]
        same = levels[at][x] == levels[at][y]
        hit = live[same]
        out[hit] += 1 << at
        a[hit] += 1 << at
        b[hit] += 1 << at
    return out


def _seeds(order: list[int], edges: list[int], lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(position, distance, LCP) of positions that become adjacent, at most LCP apart, as classes unite.

    ``edges`` are indexes of neighbours in ``order``, by decreasing LCP and then ascending.
    """
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    at, n = 0, len(edges)
    while at < n:
        level, i = lcp[edges[at]], edges[at]
        roots = []
        while True:  # a chain of neighbours with this LCP unites in one step
            for node in (i, i + 1):
                if node not in parent:
                    parent[node] = node
                    members[node] = [order[node]]
            if not roots:
                roots.append(find(i))
            roots.append(find(i + 1))
            at += 1
            if at == n or lcp[edges[at]] != level:
                break
            nxt = edges[at]
            if nxt not in parent or find(nxt) != roots[-1]:
                break
            i = nxt
        big = max(roots, key=lambda r: len(members[r]))
        base = members[big]
        small = sorted((p, r) for r in roots if r != big for p in members.pop(r))
        before, owner = -1, big
        for x, (p, r) in enumerate(small):
            spot = bisect_left(base, p)
            if spot and base[spot - 1] > before:
                before, owner = base[spot - 1], big
            if before >= 0 and owner != r and p - before <= level:
                yield before, p - before, level
            if spot < len(base) and (x + 1 == len(small) or small[x + 1][0] > base[spot]) and base[spot] - p <= level:
                yield p, base[spot] - p, level
            before, owner = p, r
        for r in roots:
            parent[r] = big
        if len(small) * 16 > len(base):
            base += [p for p, _ in small]
            base.sort()
        else:
            for p, _ in small:
                insort(base, p)


def runs_of(hashes: np.ndarray, ptr: np.ndarray, min_length: int = MIN_LENGTH,
            min_repeats: int = MIN_REPEATS) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, by start and period; ``ptr`` bounds the texts' words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(ptr) - 1)]
    least = _least_lcp(min_length, min_repeats)
    sizes = np.diff(ptr)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    own = mix(hashes + mix(doc.astype(np.uint64)))  # equal only for equal words of one text
    windows = window_hashes(own, least)
    whole = np.flatnonzero(whole_windows(ptr, len(own), least)[:len(windows)])
    order = whole[np.argsort(windows[whole], kind="stable")]
    twice = np.flatnonzero(windows[order[1:]] == windows[order[:-1]]) if len(order) else order
    texts = np.unique(doc[order[twice]])
    if not len(texts):
        return out
    # the words of these texts, an end symbol after each
    lens = sizes[texts] + 1
    starts = np.r_[0, np.cumsum(lens)]
    ends = starts[1:] - 1
    text_of = np.repeat(np.arange(len(texts)), lens)
    source = np.arange(starts[-1]) - starts[text_of] + ptr[:-1][texts][text_of]
    source[ends] = 0
    symbols = np.unique(own[source], return_inverse=True)[1] + len(texts)
    symbols[ends] = np.arange(len(texts))
    order, levels = suffix_order(symbols)
    lcp = common_prefixes(order, levels, least)
    edges = np.flatnonzero(lcp >= least)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    found = np.array(list(_seeds(order.tolist(), edges.tolist(), lcp.tolist())), dtype=np.int64).reshape(-1, 3)
    at, q, length = found[:, 0], found[:, 1], found[:, 1] + found[:, 2]
    first = starts[text_of[at]]
    long_enough = length >= np.maximum(min_length, min_repeats * q)
    before = np.maximum(at - 1, first)
    maximal = (at == first) | (symbols[before] != symbols[before + q])
    pick = np.flatnonzero(long_enough & maximal)
    for i in pick[np.lexsort((q[pick], at[pick]))]:
        out[texts[text_of[at[i]]]].append((int(at[i] - first[i]), int(length[i]), int(q[i])))
    return out


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """``docs`` with ``_n_words``, ``_runs`` (by start, then period) and ``_collapsed``.

    ``_collapsed`` is the text's words joined by one space, without those that
    stand in some run after that run's first period.
    """
    docs = without(docs, *ADDED.names)
    names = docs.columns
    at = names.index("text")
    schema = T.StructType([*docs.schema.fields, *ADDED.fields])
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(at))
            for low, high in blocks(texts):
                words = split_words(texts[low:high])
                runs = runs_of(word_hashes(words), words.ptr, min_length, min_repeats)
                collapsed = []
                for d, own in enumerate(runs):
                    begin, end = words.ptr[d], words.ptr[d + 1]
                    gone = np.zeros(end - begin + 1, dtype=np.int64)
                    for start, length, period in own:
                        gone[start + period] += 1
                        gone[start + length] -= 1
                    keep = begin + np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                    data = words.data
                    collapsed.append(b" ".join(data[s:e].tobytes() for s, e in zip(
                        words.starts[keep].tolist(), (words.starts[keep] + words.lens[keep]).tolist())))
                rows = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(np.diff(words.ptr), pa.int64()),
                     pa.array([[{"start": s, "length": n, "period": q} for s, n, q in own] for own in runs], runs_type),
                     pa.array(collapsed, pa.binary()).cast(pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)


def longest(runs: str) -> Column:
    """The run of greatest length (ties: smallest start, then period); null without runs."""
    ranked = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"),
                                                  (-r["period"]).alias("short"), r.alias("run")))
    return F.array_max(ranked)["run"]


def listing(runs: str) -> Column:
    """``start,length,period`` and a line feed for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")),
        F.lit("\n"))), "")
