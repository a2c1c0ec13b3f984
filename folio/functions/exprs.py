"""Column expressions (all built-in, so they stay inside whole-stage codegen)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.config import NA_TOKENS

_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"

# Unix seconds of the first and last second a Spark timestamp can hold
# (0001-01-01 00:00:00 and 9999-12-31 23:59:59).
_EPOCH0 = _dt.datetime(1970, 1, 1)
MIN_EPOCH_SECONDS = int((_dt.datetime(1, 1, 1) - _EPOCH0).total_seconds())
MAX_EPOCH_SECONDS = int((_dt.datetime(9999, 12, 31, 23, 59, 59) - _EPOCH0).total_seconds())


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def column(name: str) -> Column:
    """A column by its exact name, whatever characters it holds (dots, spaces, backticks)."""
    return F.col("`" + name.replace("`", "``") + "`")


def epoch_in_range(col: str | Column) -> Column:
    """True where Unix seconds fall inside the representable timestamp range."""
    return _c(col).cast("long").between(MIN_EPOCH_SECONDS, MAX_EPOCH_SECONDS)


def epoch_to_timestamp(col: str | Column) -> Column:
    """Unix seconds -> naive (zone-free) timestamp; NULL stays NULL.

    Adds seconds to the NTZ epoch, so the result does not depend on the
    session time zone; negative values land before 1970.  Values outside
    years 1-9999 become NULL instead of failing the job.
    """
    seconds = _c(col).cast("long")
    return F.when(epoch_in_range(seconds),
                  F.timestamp_add("SECOND", seconds, F.expr(_EPOCH_NTZ)))


def epoch_to_date(col: str | Column) -> Column:
    """Unix seconds -> calendar date in UTC."""
    return epoch_to_timestamp(col).cast("date")


def null_tokens(col: str | Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """NULL where the text equals one of ``tokens`` exactly, else unchanged.

    Text longer (in UTF-8 bytes) than every token is kept without hashing
    it for the set lookup, so long review texts cost a length check only.
    """
    tokens = list(tokens)
    c = _c(col)
    if not tokens:
        return c
    longest = max(len(t.encode("utf-8")) for t in tokens)
    return F.when((F.octet_length(c) > longest) | ~c.isin(tokens), c)


def round_half_up(value: Column, scale: int = 2) -> Column:
    """Round a decimal half away from zero and return a double."""
    return F.round(value, scale).cast("double")


def ratio_percent(part: Column, total: Column, scale: int = 2) -> Column:
    """``round(part * 100.0 / total, scale)`` in exact decimal arithmetic."""
    quotient = F.try_divide(part.cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)"),
                            total.cast("decimal(20,0)"))
    return round_half_up(quotient, scale)


# What most values of an exact mean are added in: below 10**10, with 14 decimals (exactmean has the others).
EXACT = T.DecimalType(24, 14)


def exact_value(col: str | Column) -> Column:
    """The value as a decimal, NULL where it has no such form (huge, infinite or NaN)."""
    return _c(col).try_cast(EXACT)


def inexact_values(col: str | Column, weight: str | Column | None = None) -> Column:
    """Aggregate: how many non-NULL values ``exact_value`` cannot hold."""
    unfit = _c(col).isNotNull() & exact_value(col).isNull()
    rows = F.lit(1) if weight is None else _c(weight)
    return F.coalesce(F.sum(F.when(unfit, rows)), F.lit(0)).cast("long")


def safe_cast(col: str | Column, dtype: T.DataType) -> Column:
    """Text -> ``dtype`` without raising: unparsable text becomes NULL.

    Integral targets also accept integral decimal text (``"1234567890.0"``);
    text with a fractional part is rejected instead of silently truncated.
    Floating targets take plain decimal text only, with an exponent or as
    inf or nan, but no suffixes (``1d``) and no hexadecimal form.
    """
    c = _c(col)
    if isinstance(dtype, T.StringType):
        return c.cast("string")
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        name = dtype.simpleString()
        as_dec = F.when(c.rlike("[.eE]"), F.trim(c)).try_cast(T.DecimalType(38, 18))
        integral = F.when(as_dec == F.floor(as_dec), as_dec.try_cast(name))
        return F.coalesce(c.try_cast(name), integral)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        # a suffix or a hexadecimal form has one of these letters; few values need the second look
        odd = c.rlike("[dDfFxXpP]") & ~c.rlike(r"(?i)^\s*[+-]?inf")
        return F.when(~odd, c).try_cast(dtype)
    return c.try_cast(dtype)


def rejected(raw: str | Column, typed: str | Column) -> Column:
    """True where a non-NULL input became NULL in the typed column."""
    return _c(raw).isNotNull() & _c(typed).isNull()
