"""Operator 11: sorted projection passes against all pairs, edge rows and plan bounds."""

import random

import numpy as np
import pytest

import brute
from folio.llm import embedding_dedup as E

VECTORS = "vec_id long, embedding array<float>, label int"


def near(rng, base, noise):
    return [float(np.float32(x + rng.gauss(0, noise))) for x in base]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    fresh = lambda: near(rng, [0.0] * 24, 1.0)
    out = [(i, fresh()) for i in range(120)]
    for group in range(8):  # pairs and small groups, some at the threshold's edge
        base = fresh()
        out += [(1000 + 20 * group + i, near(rng, base, 0.15)) for i in range(group + 2)]
    dense, chain = fresh(), fresh()
    out += [(2000 + i, near(rng, dense, 0.08)) for i in range(180)]
    for i in range(60):  # ends of the chain do not link
        chain = near(rng, chain, 0.12)
        out.append((3000 + i, chain))
    same = fresh()
    out += [(4000 + i, same) for i in range(150)] + [(4500 + i, [2 * x for x in same]) for i in range(3)]
    out += [(5000, None), (5001, []), (5002, [0.0] * 24), (5003, [None, *same[1:]]), (5004, [float("nan"), *same[1:]]),
            (5005, [float("inf"), *same[1:]]), (5006, same[:23]), (5007, same[:23]), (5008, [-x for x in same]),
            (5009, [1.0]), (5010, [5.0]), (5011, [-1.0]), (None, same), (None, None), (7, fresh()), (0, out[0][1])]
    rng.shuffle(out)
    return out


def test_equals_all_pairs(spark, rows):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(5)
    got = E.near_duplicates(frame)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute.near_vectors(rows)))


def test_small_windows_tiles_and_tasks_lose_nothing_in_groups(spark, rows):
    """Windows over the borders of many small tasks, and links counted over many tiles."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
        got = E.near_duplicates(frame, window=24, passes=10, tile=16).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute.near_vectors(rows)))


def test_extra_and_clashing_columns_huge_and_tiny_values(spark):
    frame = spark.createDataFrame(
        [(1, [1e300, 1e300], 1, 2, 3), (2, [1e-300, 1e-300], 1, 2, 3), (3, [1e300, -1e300], 1, 2, 3)],
        "vec_id long, embedding array<double>, node int, n_links int, component_id int")
    assert sorted(map(tuple, E.near_duplicates(frame).collect())) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_no_rows(spark):
    assert E.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []


def test_recall_of_pairs_at_the_threshold():
    """The passes a number of classes asks for find at least 0.9 of lone pairs just above the threshold."""
    rng = np.random.default_rng(5)
    n, size = 4000, 64
    base = rng.standard_normal((n, size))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = rng.standard_normal((n, size))
    other -= (other * base).sum(axis=1, keepdims=True) * base
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    units = np.vstack([base, 0.951 * base + np.sqrt(1 - 0.951 ** 2) * other])
    found = np.zeros(n, dtype=bool)
    for number in range(E.passes_for(2 * n)):
        place = np.empty(2 * n, dtype=int)
        place[np.argsort(E.key_maker(number, E.SEED)(units), kind="stable")] = np.arange(2 * n)
        found |= np.abs(place[:n] - place[n:]) <= E.WINDOW
    assert found.mean() >= 0.95


def test_passes_grow_slowly_with_the_input():
    assert E.passes_for(0) == E.passes_for(64) == E.MIN_PASSES
    assert E.passes_for(50_000) <= 12 and E.passes_for(10 ** 9) <= 60


def test_forest_unites_chains():
    label = E._forest(7, np.array([0, 1, 5, 3]), np.array([1, 2, 4, 5]))
    assert label.tolist() == [0, 0, 0, 3, 3, 3, 6]
