"""Scans over hot groups agree with plain windows, whatever the spread of the order column."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lapwise.operators.skew import MEASURED, counted, dealing, heavy_groups, heavy_join, previous, running, slice_groups
from lapwise.queries.stores import power
from lapwise.sinks.load import backfill_power


def rows(spread: str, seed: int):
    rnd = random.Random(seed)
    out = []
    for i in range(900):
        g = 1 if rnd.random() < 0.7 else rnd.randrange(2, 6)
        at = {
            "even": rnd.randrange(10_000),
            "clustered": 5 if rnd.random() < 0.9 else rnd.randrange(1_000_000_000),
            "steep": 2 ** rnd.randrange(14),
        }[spread]
        out.append((g if rnd.random() > 0.02 else None, at, i, rnd.randrange(-50, 50) if rnd.random() > 0.1 else None))
    return out


@pytest.fixture(params=[4096, 2])
def few(request, monkeypatch):
    """With hot groups that may be broadcast, and with more of them than that."""
    from lapwise.operators import skew

    monkeypatch.setattr(skew, "FEW_GROUPS", request.param)
    monkeypatch.setattr(skew, "FEW_SLICES", 10 * request.param)


def by_id(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("spread", ["even", "clustered", "steep"])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_and_previous(spark, spread, inclusive, few):
    df = spark.createDataFrame(rows(spread, 7), "g int, at long, i long, v int")
    order, keys = ["at", "i"], ["g"]
    w = Window.partitionBy("g").orderBy("at", "i").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    lag = Window.partitionBy("g").orderBy("at", "i")
    want = df.select(
        "i", F.sum("v").over(w).alias("s"), F.count("v").over(w).alias("n"), F.min("v").over(w).alias("lo"),
        F.max("v").over(w).alias("hi"), F.lag("v").over(lag).alias("p"), F.lag("at").over(lag).alias("pa"),
    )
    parts = slice_groups(df, keys, order, min_rows=25)
    assert parts.cuts
    biggest = parts.hot.groupBy(*keys, *parts.cuts).count().agg(F.max("count")).first()[0]
    assert biggest <= 25
    got = running(
        df, keys, order, {"s": ("sum", "v"), "n": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v")},
        inclusive, min_rows=25,
    )
    before = previous(df, keys, order, {"p": "v", "pa": "at"}, min_rows=25)
    assert by_id(got.select("i", "s", "n", "lo", "hi")) == by_id(want.select("i", "s", "n", "lo", "hi"))
    assert by_id(before.select("i", "p", "pa")) == by_id(want.select("i", "p", "pa"))


def test_no_hot_group_means_one_exchange(spark):
    df = spark.createDataFrame(rows("even", 1), "g int, at long, i long, v int")
    plan = running(df, ["g"], ["at", "i"], {"s": ("sum", "v")})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_heavy_join(spark, how, few):
    left = spark.createDataFrame([(k, i) for i in range(300) for k in [1, 1, 1, 2, i, None]], "k int, i int")
    right = spark.createDataFrame([(k, k * 10) for k in range(0, 50, 2)] + [(1, 7)], "k int, v int")
    want = left.join(right, ["k"], how)
    got = heavy_join(left, right, ["k"], how, min_rows=50)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert {r["k"] for r in heavy_groups(left, ["k"], 50).frame.collect()} == {1, 2, None}


@pytest.mark.parametrize("buckets", [1, 4, 65_536])
def test_groups_are_found_by_buckets(spark, few, monkeypatch, buckets):
    """Other groups in the bucket of a hot one are not taken for hot, and all rows count."""
    from lapwise.operators import skew

    monkeypatch.setattr(skew, "BUCKETS", buckets)
    df = spark.createDataFrame([(k, -0.0 if i % 2 else 0.0) for i in range(60) for k in [1, 2, None, i]], "k int, x double")
    rows, hot = counted(df, ["k", "x"], 50)
    assert rows == 240 and {tuple(r) for r in hot.frame.collect()} == {(1, 0.0, 61), (2, 0.0, 61), (None, 0.0, 60)}
    assert counted(df, ["k"], 61) == (240, None)
    assert counted(df.limit(0), ["k"], 0) == (0, None)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("limit", [20, 50, 100_000])
def test_heavy_join_dealt(spark, how, limit, few, monkeypatch):
    """With heavy keys on either side, on both and on none; the right side repeats its keys."""
    from lapwise.operators import skew

    monkeypatch.setattr(skew, "ROWS_PER_TASK", 30)
    left = spark.createDataFrame([(k, i) for i in range(100) for k in [1, 1, 2, i, None]], "k int, i int")
    right = spark.createDataFrame([(k, i) for i in range(40) for k in [2, i, i + 1, None]], "k int, v int")
    once = lambda rows: rows.groupBy("k").agg(F.min("v").alias("v"))
    want = left.join(once(right), ["k"], how)
    key = lambda r: tuple((x is None, x) for x in r)
    for given in ({"min_rows": limit}, {"min_rows": MEASURED, "tasks": 5}):
        got = heavy_join(left, right, ["k"], how, once=once, **given)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def exchanges(df):
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [x for x in lines if "Exchange hashpartitioning" in x]


def test_power_is_dealt_by_rows(spark, monkeypatch):
    """Tasks follow the rows of both sides, whatever the shuffle setting; a lap decoded very often is combined before its shuffle."""
    from lapwise.operators import skew

    monkeypatch.setattr(skew, "ROWS_PER_TASK", 100)
    kinds = "activity_id long, number int, start_time long, avg_power long, max_power long, normalized_power long"
    laps = spark.createDataFrame([(i, n, 0, None if i % 2 else 5, None, None) for i in range(200) for n in (1, 2, None)], kinds)
    often = [(i, n, at, 10 * at + n, None if at else 7, i) for i in range(0, 240, 3) for n in (1, 2) for at in range(4)]
    decoded = spark.createDataFrame(often, kinds)
    want = {(i, n): ((5 if i % 2 == 0 else n if n and i % 3 == 0 else None), *((7, i) if n and i % 3 == 0 else (None, None))) for i in range(200) for n in (1, 2, None)}
    for min_rows, tasks in ((None, 13), (3, None)):
        got = backfill_power(laps, decoded, ["start_time"], min_rows=min_rows)
        planned = exchanges(got)
        dealt = [x for x in planned if "REPARTITION_BY_NUM" in x]
        assert len(planned) == 2 and (len(dealt) == 2 and all(f", {tasks})" in x for x in dealt) if tasks else not dealt)
        assert {(r["activity_id"], r["number"]): (r["avg_power"], r["max_power"], r["normalized_power"]) for r in got.collect()} == want
        assert got.count() == len(want)


def test_power_query_has_one_exchange_a_side(spark, tmp_path, monkeypatch):
    """Laps are made and filled in the same tasks, which follow the lines; heavy lines go the plain way, to the same result."""
    from lapwise.operators import skew

    lines = [(i % 90, i % 3 if i % 7 else None, i % 5, i, float(i), "AN"[i % 2], "FO"[i % 4 > 2]) for i in range(600)]
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, names).write.parquet(str(tmp_path / "lineitem.parquet"))
    plain = power(spark, str(tmp_path))
    assert not any("REPARTITION" in x for x in exchanges(plain))
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 100)
    dealt = power(spark, str(tmp_path))
    assert len(exchanges(dealt)) == 2 and all(", 12), REPARTITION_BY_NUM" in x for x in exchanges(dealt))
    monkeypatch.setattr(skew, "DEFAULT_MIN_ROWS", 4)
    assert dealing(spark.read.parquet(str(tmp_path / "lineitem.parquet")), ["l_orderkey", "l_linenumber"]) == (4, None)
    heavy = power(spark, str(tmp_path))
    want = sorted(map(str, plain.collect()))
    assert sorted(map(str, dealt.collect())) == sorted(map(str, heavy.collect())) == want and len(want) == 176


def test_many_hot_groups_are_sliced_without_joining_their_rows(spark, monkeypatch):
    from lapwise.operators import skew

    monkeypatch.setattr(skew, "FEW_GROUPS", 2)
    df = spark.createDataFrame(rows("even", 3), "g int, at long, i long, v int")
    for scan in (
        running(df, ["g"], ["at", "i"], {"s": ("sum", "v")}, min_rows=25),
        previous(df, ["g"], ["at", "i"], {"p": "v"}, min_rows=25),
    ):
        plan = scan._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == plan.count("rightHint=(strategy=broadcast)") == 1


def test_null_order_across_cuts(spark):
    """Rows without a place in the order come first, in slices too."""
    data = [(i % 3, None if i % 13 == 0 else 1_706_000_000_000_000 + i * 977 % 5000, i, i % 5) for i in range(400)]
    df = spark.createDataFrame(data, "g int, at long, i long, v int")
    w = Window.partitionBy("g").orderBy("at", "i").rowsBetween(Window.unboundedPreceding, 0)
    got = running(df, ["g"], ["at", "i"], {"s": ("sum", "v")}, min_rows=20)
    assert by_id(got.select("i", "s")) == by_id(df.select("i", F.sum("v").over(w).alias("s")))
