"""The exact mean against fractions of decimal texts, under any partitioning."""

from __future__ import annotations

import math
import random
import re
from decimal import ROUND_HALF_UP, Decimal, getcontext

import pytest

from folio.functions.exactmean import aggregate_with_mean

getcontext().prec = 2000


def _expected(values, scale=2):
    values = [v for v in values if v is not None]
    if not values:
        return None
    if any(math.isnan(v) for v in values) or {float("inf"), float("-inf")} <= set(values):
        return float("nan")
    for inf in (float("inf"), float("-inf")):
        if inf in values:
            return inf
    total = sum((Decimal(repr(v)) for v in values), Decimal(0))
    # one rounding, of the exact quotient
    number = (total * 10 ** scale / len(values)).quantize(Decimal(1), ROUND_HALF_UP)
    return float(number / 10 ** scale)


def _cases():
    rng = random.Random(6)
    yield from ([1e300, 1.0, -1e300], [1e300, 1.0], [5e-324], [-5e-324, 5e-324], [1.7976931348623157e308] * 3,
                [0.1, 0.2, 0.30000000000000004], [1.005], [2.675, 2.675], [-1.005], [-0.004], [-0.005], [0.005, -0.0],
                [1e22, 3.14, -1e22], [], [None], [None, 2.0], [float("inf"), 1.0], [float("-inf"), None],
                [float("inf"), float("-inf")], [float("nan"), float("inf")], [9999999999.99, 1e10, -1e10],
                [123456789012345.67] * 7, [1e16, 1.0, 1.0, -1e16], [0.0], [1e-20] * 5)
    for _ in range(4):
        yield [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randrange(-320, 308) for _ in range(rng.randrange(1, 40))]
        some = [round(rng.uniform(-50, 50), rng.randrange(1, 17)) for _ in range(rng.randrange(1, 40))]
        huge = [10.0 ** rng.randrange(15, 300) for _ in range(5)]
        yield some + huge + [-x for x in huge]


@pytest.mark.parametrize("parts", [1, 5])
def test_mean_is_exact_in_any_partitioning(spark, parts):
    cases = list(_cases())
    rng, wrong = random.Random(parts), []
    for values in cases:
        rng.shuffle(values)
        frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        got, want = aggregate_with_mean(frame, "v", "mean").first()["mean"], _expected(values)
        if str(got) != str(want) and got != want:
            wrong.append((values, got, want))
    assert not wrong


def test_weights_repeat_values(spark):
    rows = [(1e300, 3), (-1e300, 3), (0.30000000000000004, 2), (2.5, 4), (None, 9)]
    frame = spark.createDataFrame(rows, "v double, w long")
    want = _expected([v for v, w in rows for _ in range(w)])
    assert aggregate_with_mean(frame, "v", "mean", "w").first()["mean"] == want
    assert aggregate_with_mean(frame, "v", "mean", "w", scale=5).first()["mean"] == _expected(
        [v for v, w in rows for _ in range(w)], 5)


def test_the_text_of_a_value_is_made_once(spark):
    frame = spark.range(3).selectExpr("id * 1.5D AS v")
    plan = aggregate_with_mean(frame, "v", "mean")._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"cast\(\w+#\d+ as string\)", plan.split("collect_list")[-1])) == 1
