import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import clashing
from lapwise.llm.negatives import hard_negatives, window

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def table(spark, rows):
    return clashing(spark.createDataFrame(rows, SCHEMA), "row", "vector", "rank", "asks", "nth", "wanted", "_a", "_c", "score")


def brute(rows, each, positives=5, negatives=10, low=30, high=90, scale=256):
    """Rows that take part, told apart by place; ties by id, then place."""
    part = [
        (k, [int(np.floor(scale * float(np.float32(x)))) for x in v], n) for k, v, n in rows
        if k is not None and n is not None and v is not None and None not in v and np.isfinite(v).all()
    ]
    out = []
    for i, (key, vector, label) in enumerate(part):
        if key % each:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, w)), k, j, n) for j, (k, w, n) in enumerate(part) if j != i)
        best = [(k, -s) for s, k, _, n in scored if n == label][:positives]
        for k, s in best:
            fit = [(m, -t) for t, m, _, n in scored if n != label and low * s <= -100 * t <= high * s][:negatives]
            out += [(key, k, r + 1, m, s, t) for r, (m, t) in enumerate(fit)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def mined(spark, rows, each=10, **more):
    return got(hard_negatives(table(spark, rows), "vec_id", "embedding", F.col("label"), F.col("vec_id") % each == 0, **more))


@pytest.mark.parametrize("seed", range(4))
def test_against_all_pairs(spark, seed):
    dice = np.random.default_rng(seed)
    dims = (3, 16, 33, 64)[seed]
    centers = dice.normal(size=(6, dims))
    rows = [(i, [float(x) for x in (centers[i % 6] * 0.5 + dice.normal(size=dims)).astype(np.float32)], int(i % 3)) for i in range(400)]
    want = brute(rows, 10)
    assert len(want) > 500
    assert mined(spark, rows) == want
    assert mined(spark, rows, candidates_per_task=60, anchors_per_task=13) == want


def test_ties_copies_and_few_values(spark):
    dice = np.random.default_rng(9)
    rows = [(i, [float(x) for x in dice.integers(-1, 2, 3)], int(dice.integers(0, 3))) for i in range(200)]
    rows += [(20, [1.0, 1.0, 0.0], 1)] * 2
    assert mined(spark, rows) == brute(rows, 10)


def test_odd_rows(spark):
    good = [1.0, 0.5, 0.25]
    rows = [(i, [1.0, 0.5 + i / 64, 0.25], i % 2) for i in range(12)] + [
        (20, good, None), (30, None, 1), (40, [1.0, None, 0.5], 1), (50, [NAN, 1.0, 1.0], 1), (60, [INF, 1.0, 1.0], 1), (None, good, 1),
        (70, [], 1), (80, [0.0] * 3, 1), (90, good, 7), (100, [0.25], 0), (110, [1.0, 0.5, 0.25, 3.0], 0), (120, [-1.0, -0.5, -0.25], 0),
    ]
    assert mined(spark, rows) == brute(rows, 10)


def test_large_components(spark):
    """Beyond what floats, then doubles hold exactly."""
    for size in (3e4, 5e5):
        rows = [(i, [size * (1 + i / 7), 1.0 + i, -size / (1 + i)], i % 2) for i in range(30)]
        assert mined(spark, rows) == brute(rows, 10)
    rows = [(i, [3e30, 1.0], i % 2) for i in range(4)]
    found = mined(spark, rows)
    assert found == [] and brute(rows, 10) == []


def test_none_and_alone(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []
    assert mined(spark, [(1, [1.0], 1), (2, [0.5], 2)]) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)]) == [(0, 1, 1, 2, 65536, 32768)]


def test_windows():
    for score in range(-20, 40):
        low, high = window(score, 30, 90)
        assert [s for s in range(-50, 50) if low <= s <= high] == [s for s in range(-50, 50) if 30 * score <= 100 * s <= 90 * score]
