"""A fixed-size bit filter over 64-bit keys, built by the tasks and broadcast.

It has no false negatives, so it may only ever spare work: what passes is
checked again by the caller.  Its size is a parameter and does not grow with
the keys; past that size it lets more rows through, and results stay the
same.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_LOG2 = 27
_SEGMENT_LOG2 = 19  # bits in a segment: 64 KiB


def _slot(keys: np.ndarray, bits_log2: int) -> np.ndarray:
    return keys.view(np.uint64) >> np.uint64(64 - bits_log2)


def build(keys: DataFrame, column: str, bits_log2: int = BITS_LOG2) -> Broadcast:
    """Broadcast filter (2**bits_log2 bits) over a long column; the driver sees only its segments."""
    spark = keys.sparkSession
    slots = keys.select(F.shiftrightunsigned(F.col(column), 64 - bits_log2).alias("slot"))

    def segment(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << _SEGMENT_LOG2, dtype=np.uint8)
        bits[rows["slot"].to_numpy() & ((1 << _SEGMENT_LOG2) - 1)] = 1
        return pd.DataFrame({"segment": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    segments = (slots.distinct()  # at most 2**19 rows a segment
                .groupBy(F.shiftright("slot", _SEGMENT_LOG2).alias("segment"))
                .applyInPandas(segment, "segment long, bits binary"))
    out = np.zeros(1 << (bits_log2 - 3), dtype=np.uint8)
    size = 1 << (_SEGMENT_LOG2 - 3)
    for row in segments.collect():  # as large as the filter
        out[row["segment"] * size:(row["segment"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return spark.sparkContext.broadcast(out)


def holds(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Marks the keys that may be in the filter."""
    slot = _slot(keys, int(len(bits)).bit_length() + 2)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0

