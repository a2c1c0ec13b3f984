"""A file layout for lookups by any of several columns (Z-order).

Sorting by one column lets readers skip row groups for that column alone.
Here each column's value becomes its bucket among the column's quantiles, and the
buckets' bits are interleaved, highest first, to one number.  Rows sorted by it are
near each other in every column, so the minimum and maximum of a row group are
narrow in each, and a lookup by any of them skips most row groups.

The driver sees the quantiles, ``2**BITS`` numbers a column at most; rows move once,
in one range shuffle.  A value that most rows share is split by the other columns.
NULLs are a bucket of their own, the first.  The order only decides which row groups
are skipped, so approximate quantiles do.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions.exprs import column

#: Bits of a column's bucket, and the accuracy of the quantiles.
BITS = 6
ACCURACY = 2000
#: Bytes of a text, after what all texts begin with, that order it.
_BYTES = 6
Z = "__z"


def _common_prefix(a: bytes, b: bytes) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def _numbers(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Each column as a number that keeps its order, approximately for texts."""
    types = {f.name: f.dataType for f in df.schema.fields}
    texts = [c for c in columns if isinstance(types[c], T.StringType)]
    shared: dict[str, int] = {}
    if texts:
        ends = df.agg(*[f(column(c)).cast("binary") for c in texts for f in (F.min, F.max)]).first()
        for i, c in enumerate(texts):
            low, high = ends[2 * i], ends[2 * i + 1]
            shared[c] = 0 if low is None else _common_prefix(bytes(low), bytes(high))

    def number(c: str) -> Column:
        v = column(c)
        if c in shared:
            digits = F.substring(F.hex(v.cast("binary")), 2 * shared[c] + 1, 2 * _BYTES)
            return F.conv(F.rpad(digits, 2 * _BYTES, "0"), 16, 10).cast("double")
        if isinstance(types[c], (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.unix_timestamp(v.cast("timestamp")).cast("double")
        return v.cast("double")

    return [number(c) for c in columns]


def z_ordered(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """``df`` range-partitioned and sorted along the Z-order of ``columns``."""
    if not columns or bits * len(columns) > 62:
        raise ValueError(f"the Z-order takes 1 to {62 // bits} columns of {bits} bits")
    numbers = _numbers(df, columns)
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    cuts = df.agg(*[F.percentile_approx(n, shares, ACCURACY) for n in numbers]).first()
    out = df.withColumns({f"__n{i}": n for i, n in enumerate(numbers)})
    out = _bucketed(out, [cuts[i] or [] for i in range(len(columns))], bits)
    z = " | ".join(f"shiftleft(shiftright(__b{i}, {bit}) & 1L, {bit * len(columns) + len(columns) - 1 - i})"
                   for i in range(len(columns)) for bit in range(bits))
    keys = [F.col(Z), *[column(c) for c in columns]]
    out = out.withColumn(Z, F.expr(z)).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return out.select(*[column(c) for c in df.columns])


def _bucketed(df: DataFrame, cuts: Sequence[Sequence[float]], bits: int) -> DataFrame:
    """``df`` with ``__b{i}``: how many of the cuts are not above the number ``__n{i}``; 0 for NULL.

    Found by halving, a column for each step: a single expression of all comparisons
    makes a method too large for the JVM to compile.
    Few different values make few buckets; these take the high bits, so that they count as much.
    """
    own = [sorted({c for c in some if math.isfinite(c)}) for some in cuts]
    sizes = [len(o).bit_length() for o in own]
    # filled up with NaN, which is above all other numbers
    tables = ["array(" + ", ".join(f"double('{c!r}')" for c in o + [math.nan] * (2 ** n - 1 - len(o))) + ")"
              for o, n in zip(own, sizes)]
    df = df.withColumns({f"__b{i}": F.lit(0) for i in range(len(own))})
    for bit in reversed(range(bits)):
        half = 1 << bit
        df = df.withColumns({f"__b{i}": F.expr(f"__b{i} + IF(__n{i} >= {table}[__b{i} + {half - 1}], {half}, 0)")
                             for i, (table, n) in enumerate(zip(tables, sizes)) if bit < n})
    return df.withColumns({f"__b{i}": F.expr(f"shiftleft(CAST(least(__b{i}, {len(o)}) AS BIGINT), {bits - n})")
                           for i, (o, n) in enumerate(zip(own, sizes))})


def bloom_options(columns: Sequence[str], distinct: int) -> dict[str, str]:
    """Writer options for a Bloom filter of each column in every row group."""
    out = {}
    for c in columns:
        out[f"parquet.bloom.filter.enabled#{c}"] = "true"
        out[f"parquet.bloom.filter.expected.ndv#{c}"] = str(distinct)
    return out
