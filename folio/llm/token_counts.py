"""Token counts (2) that follow edits: a segment tree of pre-token runs per document.

A text is cut into segments of about ``SEGMENT_CHARS`` characters, only where
a letter, one space and a letter meet.  The tokenizer's pre-token pattern
always parts a text before such a space, whatever stands around those three
characters, and pairs are merged within pre-tokens only; so a text's token
count is the sum over its segments, and a cut stays valid as long as its
three characters do.  The counts are the leaves of a binary tree (in heap
order) whose root is the text's count.

An edit makes the cuts invalid whose three characters it touches.  Segments
between the remaining cuts that no edit falls into keep their counts; the
others are joined with the boundary context they lost, cut and encoded
again, and the sums above them updated.

Defined results: a null or empty text has one empty segment and no tokens;
edits are positions in code points of the old text, sorted and disjoint, and
null edits change nothing.  Rows are handled one by one, whatever their ids;
other columns pass through untouched, but for those that have the name of an
added one (these start with an underscore), which are left out.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from folio.llm import tokens
from folio.llm.columns import without
from folio.llm.words import as_bytes

SEGMENT_CHARS = 512
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_CUT = re.compile(f"[{_LETTER}] (?=[{_LETTER}])")

Edit = tuple[int, int, str]
Count = Callable[[str], int]

EDITS_TYPE = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                       T.StructField("text", T.StringType())]))
_EDITS_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))

#: What the query's edits mask: personal data and secrets, by a placeholder.
MASKS = (
    ("<EMAIL>", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    ("<KEY>", r"\b(?=[A-Za-z0-9_-]*[0-9])(?=[A-Za-z0-9_-]*[A-Za-z])[A-Za-z0-9_-]{20,}\b"),
    ("<IP>", r"\b\d{1,3}(?:\.\d{1,3}){3}\b"),
    ("<NUMBER>", r"\+?\d[\d ()-]{5,}\d"),
)
_MASK = re.compile("|".join(f"({pattern})" for _, pattern in MASKS))


def cut(text: str, size: int = SEGMENT_CHARS) -> list[str]:
    """The text's segments: each at least ``size`` characters, but for the last."""
    out, start = [], 0
    while True:
        found = _CUT.search(text, start + size)
        if found is None:
            out.append(text[start:])
            return out
        out.append(text[start:found.start() + 1])
        start = found.start() + 1


def tree_of(leaves: list[int]) -> list[int]:
    """Heap-ordered sums: node i has children 2i and 2i + 1, the root is node 1, leaves come last."""
    width = 1 << (len(leaves) - 1).bit_length()
    tree = [0] * width + leaves + [0] * (width - len(leaves))
    for i in range(width - 1, 0, -1):
        tree[i] = tree[2 * i] + tree[2 * i + 1]
    return tree


def set_leaf(tree: list[int], leaf: int, value: int) -> None:
    """Change one leaf and the sums on its way to the root."""
    node = len(tree) // 2 + leaf
    change = value - tree[node]
    while change and node:
        tree[node] += change
        node //= 2


def apply_edits(text: str, edits: list[Edit]) -> str:
    out, at = [], 0
    for start, end, new in edits:
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]])


def update(text: str, chars: list[int], tree: list[int], edits: list[Edit], count: Count) -> tuple[str, list[int], list[int], int]:
    """The new text, segment lengths and tree, and how many segments were encoded again."""
    chars, tree = list(chars), list(tree)
    cuts, at = [], 0
    for n in chars[:-1]:
        at += n
        cuts.append(at)
    # leaf numbers after which a cut survives; a region is what lies between two of them
    starts, bounds, e = [0], [0], 0
    for leaf, b in enumerate(cuts):
        while e < len(edits) and edits[e][1] <= b - 1:
            e += 1
        if e == len(edits) or edits[e][0] >= b + 2:
            starts.append(leaf + 1)
            bounds.append(b)
    regions: dict[int, list[Edit]] = {}
    for edit in edits:
        regions.setdefault(bisect_right(bounds, edit[0]) - 1, []).append(edit)
    encoded, grown = 0, {}
    for r, own in regions.items():
        low = bounds[r]
        high = bounds[r + 1] if r + 1 < len(bounds) else len(text)
        first = starts[r]
        last = starts[r + 1] if r + 1 < len(starts) else len(chars)
        pieces = cut(apply_edits(text[low:high], [(s - low, t - low, new) for s, t, new in own]))
        counts = [count(p) for p in pieces]
        encoded += len(pieces)
        sizes = [len(p) for p in pieces]
        if len(pieces) > last - first:
            grown[first, last] = (sizes, counts)
            continue
        # leaves that are left over stay, empty, behind the others
        spare = [0] * (last - first - len(pieces))
        for leaf, value in enumerate(counts + spare, first):
            set_leaf(tree, leaf, value)
        chars[first:last] = sizes + spare
    if grown:
        leaves = tree[len(tree) // 2:][:len(chars)]
        for (first, last), (sizes, counts) in sorted(grown.items(), reverse=True):
            chars[first:last], leaves[first:last] = sizes, counts
        tree = tree_of(leaves)
    return apply_edits(text, edits), chars, tree, encoded


def find_masks(text: str) -> list[Edit]:
    return [(m.start(), m.end(), MASKS[m.lastindex - 1][0]) for m in _MASK.finditer(text)]


def _map_rows(frame: DataFrame, add: list[T.StructField], arrow: list[pa.DataType],
              row: Callable[[], Callable[..., tuple]], inputs: list[str], replace_text: bool = False) -> DataFrame:
    """Append columns computed row by row from ``inputs`` (the first being the text)."""
    frame = without(frame, *(f.name for f in add))
    names = frame.columns
    at = [names.index(c) for c in inputs]
    schema = T.StructType([*frame.schema.fields, *add])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = row()
        for b in batches:
            texts = [(t or b"").decode("utf-8", "replace") for t in as_bytes(b.column(at[0]))]
            rows = [make(*values) for values in zip(texts, *(b.column(i).to_pylist() for i in at[1:]))]
            columns = list(b.columns)
            if replace_text:
                columns[at[0]] = pa.array([r[0] for r in rows], columns[at[0]].type)
                rows = [r[1:] for r in rows]
            made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(arrow)]
            yield pa.RecordBatch.from_arrays([*columns, *made], names=schema.names)

    return frame.mapInArrow(run, schema)


def build_trees(docs: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """``docs`` with ``_chars`` (segment lengths) and ``_tree`` (token counts; node 1 is the text's)."""
    shared = tokens.share(docs.sparkSession, vocabulary)

    def row() -> Callable[[str], tuple]:
        encode = tokens.encoder(shared.value).encode_ordinary

        def make(text: str) -> tuple:
            pieces = cut(text)
            return [len(p) for p in pieces], tree_of([len(encode(p)) for p in pieces])

        return make

    ints = T.ArrayType(T.IntegerType())
    return _map_rows(docs, [T.StructField("_chars", ints), T.StructField("_tree", ints)],
                     [pa.list_(pa.int32())] * 2, row, ["text"])


def mask_edits(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_edits``, which mask personal data and secrets."""
    return _map_rows(docs, [T.StructField("_edits", EDITS_TYPE)], [_EDITS_ARROW],
                     lambda: lambda text: ([dict(zip(("start", "end", "text"), e)) for e in find_masks(text)],), ["text"])


def update_trees(trees: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """Trees with ``_edits``: the edited text, its ``_new_chars`` and ``_new_tree``, and ``_encoded``,
    the number of segments that were encoded again."""
    shared = tokens.share(trees.sparkSession, vocabulary)

    def row() -> Callable[..., tuple]:
        encode = tokens.encoder(shared.value).encode_ordinary

        def make(text: str, chars: list[int], tree: list[int], edits: list[dict] | None) -> tuple:
            script = [(e["start"], e["end"], e["text"] or "") for e in edits or ()]
            return update(text, chars, tree, script, lambda s: len(encode(s)))

        return make

    ints = T.ArrayType(T.IntegerType())
    return _map_rows(trees, [T.StructField("_new_chars", ints), T.StructField("_new_tree", ints),
                             T.StructField("_encoded", T.LongType())],
                     [pa.list_(pa.int32())] * 2 + [pa.int64()], row, ["text", "_chars", "_tree", "_edits"], replace_text=True)
