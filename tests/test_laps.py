import random

import numpy as np
import pytest

from lapwise.operators.intensity import align_intensity
from lapwise.operators.skew import MEASURED
from lapwise.operators.laps import assign_laps, first_row, number_in_order, renumber_lengths


@pytest.mark.parametrize("min_rows", [None, 30])
def test_points_fall_in_the_lap_numpy_finds(spark, min_rows):
    rnd = random.Random(2)
    laps = {a: [float(rnd.choice([0, 50, 100, 120])) for _ in range(rnd.randrange(0, 6))] for a in range(12)}
    points = {a: [float(rnd.choice([0, 50, 100, 100, 170, rnd.randrange(400)])) for _ in range(60)] for a in range(12)}
    lap_df = spark.createDataFrame(
        [(a, n, d) for a, ls in laps.items() for n, d in enumerate(ls, 1)] + [(0, 99, None)],
        "activity_id long, number int, total_distance double",
    )
    rows = [(a, i, d) for a, ps in points.items() for i, d in enumerate(ps)] + [(a, 99, None) for a in range(12)]
    point_df = spark.createDataFrame(rows, "activity_id long, i int, distance double")
    got = {(r[0], r[1]): r[2] for r in assign_laps(point_df, lap_df, min_rows=min_rows).select("activity_id", "i", "lap").collect()}
    for a in range(12):
        bounds = np.cumsum(laps[a])
        want = np.searchsorted(bounds, points[a]) + 1
        assert [got[(a, i)] for i in range(60)] == list(want)
        assert got[(a, 99)] == len(bounds) + 1


@pytest.mark.parametrize("min_rows", [None, 4])
def test_swim_lengths(spark, min_rows):
    kinds = ["active", "active", "idle", "active", None, "active"]
    df = spark.createDataFrame([(1, i, i, k) for i, k in enumerate(kinds)], "activity_id long, seq long, message_index long, length_type string")
    out = renumber_lengths(df, min_rows=min_rows).orderBy("seq").collect()
    assert [r["message_index"] for r in out] == [1, 2, 2, 3, 3, 4]


def test_numbers_and_first_row(spark):
    df = spark.createDataFrame([("a", 30, "z"), ("a", 10, "x"), ("b", 5, "q"), ("a", 20, None)], "file string, seq long, v string")
    out = number_in_order(df, "file", ["seq"]).orderBy("file", "seq").collect()
    assert [r["number"] for r in out] == [1, 2, 3, 1]
    assert {tuple(r) for r in first_row(df, ["file"], ["seq"]).collect()} == {("a", 10, "x"), ("b", 5, "q")}


def expected_intensity(intensities, steps, laps):
    """The rule worked by hand: ``None`` in ``steps`` is a lap without a step number."""
    words = [w for w in intensities if w is not None]
    order = list(dict.fromkeys(steps))
    slots = dict(enumerate(words))
    matches_none = order == [None]
    length = len(words)
    if len(words) < len(order) and None in order and order != [None]:
        gap = order.index(None)
        slots = {(j if j < gap else j + 1): w for j, w in enumerate(words)}
        length = max(len(words), gap) + 1
        matches_none = True
    by_step = {s: slots.get(p) for p, s in enumerate(order) if p < length and (s is not None or matches_none)}
    found = [by_step[s] for s in steps if s in by_step]
    return found if len(found) == laps else [None] * laps


@pytest.mark.parametrize("min_rows", [None, 3])
def test_intensities(spark, min_rows):
    rnd = random.Random(9)
    cases = [
        (["warmup", "active", "rest"], [0, 1, 2]),
        (["warmup", "active"], [None, 0, 1, 0]),
        (["active"], [0, None, 0]),
        ([], [0, 1]),
        ([None, "active"], [4]),
        (["active"], [None, None]),
        (["active", "rest"], [0, 1, 2]),
        (["active", "rest", "active"], [0, None]),
        (["a"], [0, 1, 2, None]),
    ]
    for _ in range(60):
        words = [rnd.choice(["warmup", "active", "rest", None]) for _ in range(rnd.randrange(0, 5))]
        cases.append((words, [rnd.choice([0, 1, 2, 3, None]) for _ in range(rnd.randrange(1, 6))]))
    messages, laps = [], []
    for f, (words, steps) in enumerate(cases):
        seq = 0
        for w in words:
            messages.append((f, seq, True, w, False, None))
            seq += 1
        for n, s in enumerate(steps, 1):
            messages.append((f, seq, False, None, True, s))
            laps.append((f, n))
            seq += 1
    m = spark.createDataFrame(messages, "file int, seq long, has_intensity boolean, intensity string, has_step boolean, step long")
    l = spark.createDataFrame(laps, "file int, number int")  # noqa: E741
    got = align_intensity(m, l, min_rows=min_rows).orderBy("file", "number").collect()
    for f, (words, steps) in enumerate(cases):
        want = expected_intensity(words, steps, len(steps)) if words else [None] * len(steps)
        assert [r["intensity"] for r in got if r["file"] == f] == want, cases[f]


def test_intensities_take_one_exchange_of_the_messages(spark):
    """Without hot files all steps stay within files; only laps and what they take meet by number."""
    m = spark.createDataFrame([], "file string, seq long, has_intensity boolean, intensity string, has_step boolean, step long")
    l = spark.createDataFrame([], "file string, number int, seq long")  # noqa: E741
    plan = align_intensity(m.repartition(3), l.repartition(3), min_rows=MEASURED)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(file") <= 4, plan


@pytest.mark.parametrize("min_rows", [None, 2])
def test_intensities_of_messages_with_both_fields(spark, min_rows):
    """A message may carry an intensity and a step; files may be null."""
    m = spark.createDataFrame(
        [("a", 1, True, "warmup", True, 5), ("a", 2, True, "rest", True, None), ("a", 3, False, "odd", True, 5),
         (None, 1, True, "warmup", True, 5), ("b", 1, True, None, True, 5)],
        "file string, seq long, has_intensity boolean, intensity string, has_step boolean, step long",
    )
    l = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), (None, 1), ("b", 1)], "file string, number int")  # noqa: E741
    got = {(r["file"], r["number"]): r["intensity"] for r in align_intensity(m, l, min_rows=min_rows).collect()}
    # Words are as many as steps, so the missing step takes no part, and two places are not three laps.
    assert got == {("a", 1): None, ("a", 2): None, ("a", 3): None, (None, 1): None, ("b", 1): None}
