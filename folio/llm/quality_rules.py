"""Quality rules (3): a learned decision list over document statistics.

Sequential covering: rules that reject are grown one at a time from the
labelled documents that no earlier rule covers (a conjunction of thresholds,
each chosen by information gain), pruned on held-back rows, and kept while
they are precise there and on the whole.  The list is small and readable; ``verdict`` turns it
into an ordered ``CASE WHEN`` that Spark evaluates on every document.

The statistics come from one pass over the whole texts with no shuffle.  The
fit reads a bounded sample of labelled rows (``sample_rows``, those whose
hashed ids are smallest); nothing else here is sampled.

Defined results: a null or empty text has no words, fails the base rule and
is rejected; documents without a label are judged like any other; labels
that contradict each other count as bad; without usable labels (no rows, or
one class only) the list is empty and only the base rule rejects.  Repeated
rows are judged one by one.  The input's other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.llm.columns import shielded, without
from folio.llm.words import (as_bytes, blocks, mix, per_text, split_words, whole_windows,
                             window_hashes, word_hashes)

SAMPLE_ROWS = 20_000
MIN_PRECISION = 0.97
MIN_HELD_BACK_PRECISION = 0.9
MAX_RULES = 16
MAX_CONDITIONS = 4
BASE_MIN_WORDS = 50
BASE_MAX_REPEAT_PCT = 50

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the rules may test, as a function of the statistics' columns (arrays or Spark columns).
FEATURES = {
    "symbols_per_word": lambda s: s["n_symbols"] / s["n_words"],
    "repeat_share": lambda s: s["n_repeat_words"] / s["n_words"],
    "dup_lines": lambda s: s["n_dup_lines"] * 1.0,
    "mean_word_chars": lambda s: s["word_chars"] / s["n_words"],
    "n_words": lambda s: s["n_words"] * 1.0,
}
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _block_stats(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    words = split_words(texts)
    n = len(words.starts)
    shared = np.zeros(n + 2, dtype=bool)
    if n >= 3:
        # windows of one text that hash alike; the text's number is part of the key
        key = mix(window_hashes(word_hashes(words), 3) + mix(words.doc[:n - 2].astype(np.uint64)))
        whole = np.flatnonzero(whole_windows(words.ptr, n, 3))
        order = np.argsort(key[whole])
        ranked = key[whole][order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(whole), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        at = whole[order[twice]]
        shared[at] = shared[at + 1] = shared[at + 2] = True
    dup_lines = []
    for t in texts:
        lines = (t or b"").split(b"\n")
        if len(set(lines)) < len(lines):
            lines = [x for x in lines if x.strip()]
        dup_lines.append(len(lines) - len(set(lines)))
    bounds = words.text_starts.copy()
    bounds[-1] = min(bounds[-1], len(words.data))
    letters = (words.data & 0xC0) != 0x80
    letters &= ~np.isin(words.data, np.frombuffer(b"\t\n\x0b\x0c\r ", np.uint8))
    return {
        "n_words": np.diff(words.ptr),
        "word_chars": per_text(letters, bounds),
        "n_symbols": per_text(_SYMBOL[words.data], bounds),
        "n_dup_lines": np.array(dup_lines, dtype=np.int64),
        "n_repeat_words": per_text(shared[:n], words.ptr),
    }


def with_stats(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) and the statistics of each whole text.

    The statistics' columns are named as in ``STATS``, with a leading
    underscore; input columns of those names are left out.
    """
    docs = without(docs, *(f"_{s}" for s in STATS))
    keep = docs.columns if keep is None else keep
    frame = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in keep]).schema.fields,
                           *(T.StructField(f"_{s}", T.LongType()) for s in STATS)])
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(n_keep))
            for low, high in blocks(texts):
                stats = _block_stats(texts[low:high])
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n_keep], *(pa.array(stats[s], pa.int64()) for s in STATS)],
                    names=schema.names)

    return frame.mapInArrow(run, schema)


# -- the learner ---------------------------------------------------------------

def _holds(c: Condition, x: dict[str, np.ndarray]) -> np.ndarray:
    return x[c.feature] > c.threshold if c.above else x[c.feature] <= c.threshold


def _covered(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, dtype=bool)
    for c in rule:
        out &= _holds(c, x)
    return out


def _candidates(x: dict[str, np.ndarray], rows: np.ndarray, features: Iterable[str]) -> Iterator[Condition]:
    for name in features:
        values = np.unique(x[name][rows])
        if len(values) > 65:
            values = np.unique(np.quantile(values, np.linspace(0, 1, 65)))
        for t in (values[1:] + values[:-1]) / 2:
            yield Condition(name, True, float(t))
            yield Condition(name, False, float(t))


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray, first: str) -> Rule:
    """A conjunction whose first condition is on the feature ``first``, the others on any."""
    rule: Rule = ()
    inside = rows.copy()
    while len(rule) < MAX_CONDITIONS and (bad & inside).any() and (~bad & inside).any():
        p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
        base, best, chosen = np.log2(p0 / (p0 + n0)), 1e-9, None
        for c in _candidates(x, inside, FEATURES if rule else (first,)):
            held = _holds(c, x) & inside
            p, n = (bad & held).sum(), (~bad & held).sum()
            gain = p * (np.log2(p / (p + n)) - base) if p else 0.0
            if gain > best:
                best, chosen = gain, c
        if chosen is None:
            break
        rule += (chosen,)
        inside &= _holds(chosen, x)
    return rule


def _precision(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> float:
    inside = _covered(rule, x, len(bad)) & rows
    return float(bad[inside].mean()) if inside.any() else 0.0


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
    """The shortest of the rule's prefixes that are most precise on held-back rows."""
    return max((rule[:k] for k in range(1, len(rule) + 1)), default=(),
               key=lambda r: (_precision(r, x, bad, rows), -len(r)))


def learn_list(stats: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Ordered rejecting rules from labelled statistics (arrays, in any fixed order)."""
    usable = stats["n_words"] > 0
    stats = {k: v[usable] for k, v in stats.items()}
    bad = bad[usable]
    x = {name: f(stats) for name, f in FEATURES.items()}
    left, rules = np.ones(len(bad), dtype=bool), []
    held_back = np.arange(len(bad)) % 3 == 2
    while len(rules) < MAX_RULES and (bad & left & ~held_back).any():
        # one rule from each feature; the precise one that covers most goes on the list
        grown = (_prune(_grow(x, bad, left & ~held_back, name), x, bad, left & held_back) for name in FEATURES)
        precise = [r for r in grown if r and _precision(r, x, bad, left) >= MIN_PRECISION
                   and _precision(r, x, bad, left & held_back) >= MIN_HELD_BACK_PRECISION]
        if not precise:
            break
        rules.append(max(precise, key=lambda r: (bad & left & _covered(r, x, len(bad))).sum()))
        left &= ~_covered(rules[-1], x, len(bad))
    return rules


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn the list from at most ``sample_rows`` labelled documents."""
    sample = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    picked = (docs.select("doc_id", "text")
              .join(F.broadcast(sample), "doc_id")  # bounded by sample_rows
              .select("doc_id", "quality", "text"))
    rows = (with_stats(picked, keep=["doc_id", "quality"])
            .orderBy(F.xxhash64("doc_id"), *[f"_{s}" for s in STATS], "quality")
            .limit(sample_rows).toPandas())
    stats = {s: rows[f"_{s}"].to_numpy(dtype=np.int64) for s in STATS}
    return learn_list(stats, rows["quality"].to_numpy(dtype=np.int64) <= 0)


def verdict(rules: list[Rule]) -> Column:
    """The decision list over with_stats()' columns: number of the first rule that rejects, or null."""
    stats = {s: F.col(f"_{s}") for s in STATS}
    stats["n_words"] = F.nullif(F.col("_n_words"), F.lit(0))
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules))):
        test = F.lit(True)
        for c in rule:
            value = FEATURES[c.feature](stats)
            test = test & (value > c.threshold if c.above else value <= c.threshold)
        out = F.when(test, F.lit(i)).otherwise(out)
    return out


def base_failed() -> Column:
    return ((F.col("_n_words") < BASE_MIN_WORDS)
            | (100 * F.col("_n_repeat_words") > BASE_MAX_REPEAT_PCT * F.col("_n_words")))


def judge(docs: DataFrame, rules: list[Rule], keep: list[str] | None = None) -> DataFrame:
    """``with_stats`` plus ``_base_failed``, ``_rule`` (first rejecting rule) and ``_kept``."""
    return (with_stats(docs, keep=keep)
            .withColumn("_base_failed", base_failed())
            .withColumn("_rule", verdict(rules))
            .withColumn("_kept", ~F.col("_base_failed") & F.col("_rule").isNull()))


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that neither the base rule nor the learned list rejects."""
    rules = fit(docs, labels, sample_rows)
    plain, restored = shielded(docs, "doc_id", "text")
    return restored(judge(plain, rules).where("_kept"))
