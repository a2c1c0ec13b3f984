"""The exact mean of doubles, whatever their size, in whatever order they come.

A double counts as the shortest decimal number that names it (0.1 is a tenth).
Most values have up to 14 decimals and are below 10**10: these are added as
decimals.  All others are added as integers by exponent: a value is ``m * 10**e``,
and bin ``e // 10`` sums ``m * 10**(e % 10)``.  There are 66 bins for all doubles, so
the first aggregation makes 67 rows at most, and the second holds them in one.
There the bins become the digits of one long number, which is divided by the
count, digit group by digit group, and rounded half up.  Nothing is rounded before.

NaN, or infinities of both signs, make the mean NaN; of one sign, that infinity.
Sums hold 10**11 rows in a bin, and in all 10**24 as a decimal; beyond it is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions.exprs import exact_value

#: Digits in a bin; its first and last number, with room for carries.
_GROUP, _LOW, _HIGH = 10, -34, 36
_WIDE = "DECIMAL(38,0)"
_BASE = f"CAST(1{'0' * _GROUP} AS {_WIDE})"
_ZERO = f"CAST(0 AS {_WIDE})"


def _with_parts(rows: DataFrame, odd: str, scale: int) -> DataFrame:
    """``rows`` with ``__bin``, and ``__amount`` that is added to it, of the ``odd`` ones' ``__v`` times ``10**scale``.

    Each step is a column of its own, so that it is computed once: the text of a double is slow to make.
    """
    text, mantissa = F.col("__text"), F.col("__mantissa")
    rows = rows.withColumn("__text", F.when(F.col(odd), F.col("__v").cast("string")))
    rows = rows.withColumn("__e", F.locate("E", text))
    rows = rows.withColumns({
        "__mantissa": F.when(F.col("__e") > 0, F.substr(text, F.lit(1), F.col("__e") - 1)).otherwise(text),
        "__exponent": F.when(F.col("__e") > 0, F.substr(text, F.col("__e") + 1).try_cast("int")).otherwise(0)})
    decimals = F.length(mantissa) - F.locate(".", mantissa)
    rows = rows.withColumn("__place", F.col("__exponent") - decimals + scale)
    rows = rows.withColumn("__bin", F.floor(F.col("__place") / _GROUP).cast("int"))
    # a double has at most 17 digits
    digits = F.replace(mantissa, F.lit("."), F.lit("")).try_cast("long").cast(T.DecimalType(18, 0))
    power = F.get(F.array(*[F.lit(10 ** k).cast(T.DecimalType(10, 0)) for k in range(_GROUP)]),
                  F.col("__place") - F.col("__bin") * _GROUP)
    return rows.withColumn("__amount", (digits * power).cast(T.DecimalType(27, 0)))


def _carried(groups: str) -> str:
    """SQL: (carry, groups), groups between 0 and the base, lowest first, and what is left at the top."""
    rest = f"pmod(CAST(x + a.carry AS {_WIDE}), {_BASE})"
    return (f"aggregate({groups}, struct({_ZERO} AS carry, CAST(array() AS ARRAY<{_WIDE}>) AS groups), (a, x) -> "
            f"struct(CAST(CAST(x + a.carry - {rest} AS {_WIDE}) / {_BASE} AS {_WIDE}) AS carry, "
            f"concat(a.groups, array(CAST({rest} AS {_WIDE}))) AS groups))")


def _divided(groups: str, by: str) -> str:
    """SQL: the digits of the integer that ``groups`` (highest first) are, divided by ``by``."""
    total = f"CAST(a.rest * {_BASE} + x AS {_WIDE})"
    rest = f"CAST(pmod({total}, {by}) AS {_WIDE})"
    return (f"aggregate({groups}, struct({_ZERO} AS rest, '' AS digits), (a, x) -> struct({rest} AS rest, "
            f"concat(a.digits, lpad(CAST(CAST(CAST({total} - {rest} AS {_WIDE}) / {by} AS {_WIDE}) AS STRING), "
            f"{_GROUP}, '0')) AS digits)).digits")


def aggregate_with_mean(frame: DataFrame, value: str, name: str, weight: str | None = None, scale: int = 2,
                        others: Mapping[str, tuple[Column, Callable[[str], Column]]] | None = None) -> DataFrame:
    """One row: ``others``, and the mean of ``value`` rounded half up to ``scale`` decimals.

    ``weight`` counts a row's value so many times.  ``others`` maps a name to an
    aggregate of the rows and the function that merges such aggregates.  The mean is NULL without values.
    """
    others = dict(others or {})
    v = F.col("__v")
    size = F.abs(v)
    finite = v.isNotNull() & ~F.isnan(v) & (size < float("inf"))
    fit = exact_value(F.when((size < 1e10) & ((size >= 1e-14) | (v == 0)), v))  # the cast of others is slow
    weights = F.lit(1) if weight is None else F.col(weight)
    rows = frame.withColumn("__v", F.col(value).cast("double")).withColumns(
        {"__fit": fit, "__finite": finite, "__w": weights.cast(T.DecimalType(11, 0))})
    rows = rows.withColumn("__odd", F.col("__finite") & ~F.coalesce(F.col("__fit").cast("double") == v, F.lit(False)))
    rows = _with_parts(rows, "__odd", scale)

    def counted(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, weights)), F.lit(0)).cast("long")

    def times(c: str) -> Column:
        return F.col(c) if weight is None else F.col(c) * F.col("__w")

    binned = rows.groupBy("__bin").agg(
        F.sum(F.when(~F.col("__odd"), times("__fit"))).cast("decimal(38,14)").alias("__plain"),
        F.sum(times("__amount").cast(_WIDE)).alias("__sum"),
        counted(F.col("__finite")).alias("__n"), counted(F.isnan(v)).alias("__nan"),
        counted(v == float("inf")).alias("__up"), counted(v == float("-inf")).alias("__down"),
        *[first.alias(f"__o{i}") for i, (first, _) in enumerate(others.values())])
    one = binned.agg(
        F.collect_list(F.when(F.col("__bin").isNotNull(), F.struct("__bin", "__sum"))).alias("bins"),
        F.coalesce(F.sum("__plain"), F.lit(0)).cast("decimal(38,14)").alias("plain"),
        *[F.coalesce(F.sum(f"__{c}"), F.lit(0)).alias(c) for c in ("n", "nan", "up", "down")],
        *[merge(f"__o{i}").alias(f"__o{i}") for i, (_, merge) in enumerate(others.values())])

    # the plain sum, shifted by the scale, joins bin 0 and, with its decimals, bin -2
    shift = f"CAST(1{'0' * scale} AS {_WIDE})"
    whole, below = "CAST(floor(plain) AS DECIMAL(38,0))", f"CAST(1{'0' * 2 * _GROUP} AS DECIMAL(21,0))"
    extra = (f"CASE b WHEN 0 THEN CAST({whole} * {shift} AS {_WIDE}) WHEN -2 THEN CAST(CAST(CAST(plain - {whole} AS "
             f"DECIMAL(15,14)) * {below} AS {_WIDE}) * {shift} AS {_WIDE}) ELSE {_ZERO} END")
    total = f"aggregate(filter(bins, p -> p.__bin = b), {_ZERO}, (a, p) -> CAST(a + p.__sum AS {_WIDE}))"
    one = one.selectExpr("*", f"transform(sequence({_LOW}, {_HIGH}), b -> CAST({total} + {extra} AS {_WIDE})) AS sums")
    one = one.selectExpr("*", f"{_carried('sums')}.carry < 0 AS negative")
    # half up: the floor of (2 * sum + n) / (2 * n)
    doubled = (f"transform(sums, (x, i) -> CAST(x * IF(negative, -2, 2) + IF(i = {-_LOW}, n, 0) AS {_WIDE}))")
    one = one.selectExpr("*", f"reverse(slice({_carried(doubled)}.groups, {1 - _LOW}, {_HIGH + 1})) AS groups")
    one = one.selectExpr("*", f"""IF(n > 0, {_divided("groups", f"CAST(2 * greatest(n, 1) AS {_WIDE})")}, NULL) AS digits""")
    point = (_HIGH + 1) * _GROUP - scale
    text = (f"concat(IF(negative AND digits RLIKE '[1-9]', '-', ''), substring(digits, 1, {point}), '.', "
            f"substring(digits, {point + 1}, {scale}))")
    return one.selectExpr(
        *[f"__o{i} AS `{n}`" for i, n in enumerate(others)],
        f"CASE WHEN nan > 0 OR (up > 0 AND down > 0) THEN double('NaN') WHEN up > 0 THEN double('Infinity') "
        f"WHEN down > 0 THEN double('-Infinity') ELSE CAST({text} AS DOUBLE) END AS `{name}`")
