"""Fastest efforts against all pairs, on tracks that rise, stand still, fall back or repeat times."""

import datetime
import random
import re
from math import ceil, log2

import pytest

from pyspark.sql import functions as F

from lapwise.operators import efforts, skew
from lapwise.operators.efforts import fastest_effort, fastest_efforts_by, point_deltas
from lapwise.plans.functions import register_functions


def track(rnd, kind):
    t, d, out = 0, 0.0, []
    for _ in range(rnd.randrange(1, 30)):
        if kind != "ties" or rnd.random() < 0.6:
            t += rnd.randrange(1, 5)
        d += rnd.choice([0, 0, 10, 25, 40])
        if kind == "reset" and rnd.random() < 0.1:
            d = 0.0
        if kind == "noise":
            d = float(rnd.randrange(0, 300))
        out.append((t, d if rnd.random() > 0.05 else None))
    rnd.shuffle(out)
    return out


def by_pairs(points, distance):
    pairs = [
        (ta - tb, tb) for ta, da in points for tb, db in points
        if da is not None and db is not None and ta > tb and da - db >= distance
    ]
    best = min((p[0] for p in pairs), default=None)
    return {p for p in pairs if p[0] == best}


@pytest.fixture(scope="module")
def tracks():
    rnd = random.Random(5)
    kinds = ["steady", "reset", "noise", "ties"]
    return {i: track(rnd, kinds[i % 4]) for i in range(160)}


@pytest.mark.parametrize("min_rows", [None, 12])
@pytest.mark.parametrize("distance", [50, 62.5])
def test_matches_all_pairs(spark, tracks, min_rows, distance):
    rows = [(i, t * 1_000_000, d) for i, points in tracks.items() for t, d in points]
    df = spark.createDataFrame(rows, "activity_id long, timestamp long, distance double")
    got = fastest_effort(df, distance, min_rows=min_rows).select("activity_id", "duration_us", "start_time").collect()
    want = {(i, dur * 1_000_000, start) for i, p in tracks.items() for dur, start in by_pairs(p, distance)}
    epoch = datetime.datetime(1970, 1, 1)
    utc = lambda t: int((t.astimezone(datetime.timezone.utc).replace(tzinfo=None) - epoch).total_seconds())
    assert {(r[0], r[1], utc(r[2])) for r in got} == want
    assert len(got) == len(want)


@pytest.mark.parametrize("min_rows", [None, 12])
def test_a_distance_per_activity(spark, tracks, min_rows):
    """Several goals of one activity, one named twice, none, null and impossible ones."""
    rows = [(i, t * 1_000_000, d) for i, points in tracks.items() for t, d in points]
    df = spark.createDataFrame(rows, "activity_id long, timestamp long, distance double")
    goals = [(i, g) for i in tracks if i % 5 for g in ((50.0, 62.5) if i % 2 else (25.0 * (i % 7 + 1),))]
    odd = [(1, 50.0), (2, None), (3, -1.0), (4, 0.0), (6, 1e6), (999, 50.0), (None, 50.0)]
    asked = spark.createDataFrame(goals + odd, "activity_id long, event_distance double")
    got = fastest_efforts_by(df, asked, min_rows=min_rows).select("activity_id", "event_distance", "duration_us", F.unix_micros("start_time"))
    want = sorted({(i, g, dur * 1_000_000, start * 1_000_000) for i, g in goals for dur, start in by_pairs(tracks[i], g)})
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


def test_sql_function(spark, tracks):
    rows = [(i, t, d) for i, points in tracks.items() for t, d in points]
    points = spark.createDataFrame(rows, "activity_id long, t long, distance double").withColumn("timestamp", F.timestamp_seconds("t"))
    points.createOrReplaceTempView("points_of_tracks")
    goals = [(i, 50 + i % 3 * 20) for i in tracks]
    spark.createDataFrame(goals, "activity long, metres int").createOrReplaceTempView("goals_of_tracks")
    register_functions(spark, "points_of_tracks")
    each = spark.sql(
        "SELECT activity, unix_seconds(start_time), s.shortest_duration FROM goals_of_tracks, "
        "LATERAL shortest_duration_for_distance(metres, activity) s"
    )
    plan = each._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    got = sorted((a, int(took.total_seconds()), start) for a, start, took in each.collect())
    assert got == sorted((i, dur, start) for i, g in goals for dur, start in by_pairs(tracks[i], g))
    one = spark.sql("SELECT unix_seconds(start_time), shortest_duration FROM shortest_duration_for_distance(50, 1)").collect()
    assert {(int(took.total_seconds()), start) for start, took in one} == by_pairs(tracks[1], 50)
    assert spark.sql("SELECT * FROM shortest_duration_for_distance(0, 1)").isEmpty()


def test_rows_count_as_the_search_widens_them(spark, monkeypatch):
    """An activity whose distance falls has log2(points) rows per point, and counts with them."""
    rows = [(a, t, float(d)) for a, fall in ((1, False), (2, True), (3, True)) for t in range(60 if a < 3 else 10) for d in [t * 10 - 15 * (fall and t % 20 == 7)]]
    rows += [(4, t, float(t)) for t in range(150)]
    df = spark.createDataFrame(rows, "activity_id long, timestamp long, distance double")
    sliced = []
    across = efforts._across_tasks
    monkeypatch.setattr(
        efforts, "_across_tasks",
        lambda points, *a: (sliced.extend(r[0] for r in points.select("activity_id").distinct().collect()), across(points, *a))[1],
    )
    got = fastest_effort(df, 50, min_rows=100)
    assert sorted(sliced) == [2, 4]
    want = fastest_effort(df, 50)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_one_activity_and_bad_distance(spark, tracks):
    rows = [(i, t * 1_000_000, d) for i, points in tracks.items() for t, d in points]
    df = spark.createDataFrame(rows, "activity_id long, timestamp long, distance double")
    assert {r[0] for r in fastest_effort(df, 50, activity_id=3).select("activity_id").collect()} <= {3}
    with pytest.raises(ValueError):
        fastest_effort(df, 0)


def test_plan_has_one_exchange_and_no_join(spark):
    df = spark.createDataFrame([(1, 1, 1.0)], "activity_id long, timestamp long, distance double")
    plan = fastest_effort(df, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "Join" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_time_column_and_deltas(spark):
    df = spark.sql(
        "SELECT 1L AS activity_id, timestamp_seconds(s) AS timestamp, double(d) AS distance "
        "FROM VALUES (0, 0), (10, 50), (15, 100), (30, 130) AS t(s, d)"
    )
    best = fastest_effort(df, 50).first()
    assert best["duration_us"] == 5_000_000
    assert best["shortest_duration"] == datetime.timedelta(seconds=5)
    rows = point_deltas(df).orderBy("timestamp").collect()
    assert [r["start_distance"] for r in rows] == [None, 0.0, 50.0, 100.0]


def test_tasks_follow_the_rows_the_search_makes(spark, tracks, monkeypatch):
    """Exchanges have a number of tasks that adaptive execution leaves alone, by points times their halvings."""
    df = spark.createDataFrame([(i, t * 1_000_000, d) for i, points in tracks.items() for t, d in points], "activity_id long, timestamp long, distance double")
    want = fastest_effort(df, 50)
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 400)
    halved = sum(len(p) * max(1, ceil(log2(len(p)))) for p in tracks.values())
    assert skew.widened_rows(df, "activity_id") == halved
    got = fastest_effort(df, 50)
    spread = f"hashpartitioning(activity_id#\\d+L, {ceil(halved / 400)}\\), REPARTITION_BY_NUM".replace("(act", "\\(act")
    assert re.search(spread, got._jdf.queryExecution().executedPlan().toString())
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    goals = spark.createDataFrame([(i, 50.0) for i in tracks], "activity_id long, event_distance double")
    by_goal = fastest_efforts_by(df, goals).drop("event_distance")
    assert re.search(spread, by_goal._jdf.queryExecution().executedPlan().toString())
    assert by_goal.exceptAll(want).isEmpty() and want.exceptAll(by_goal).isEmpty()


def test_sql_function_deals_activities_to_tasks(spark, tracks):
    rows = [(i, t, d) for i, points in tracks.items() for t, d in points]
    points = spark.createDataFrame(rows, "activity_id long, t long, distance double").withColumn("timestamp", F.timestamp_seconds("t"))
    points.createOrReplaceTempView("points_dealt")
    spark.createDataFrame([(i, 50) for i in tracks], "activity long, metres int").createOrReplaceTempView("goals_dealt")
    query = "SELECT activity, unix_seconds(start_time) FROM goals_dealt, LATERAL shortest_duration_for_distance(metres, activity) s"
    register_functions(spark, "points_dealt")
    want = sorted(spark.sql(query).collect())
    register_functions(spark, "points_dealt", tasks=7)
    each = spark.sql(query)
    assert re.search(r"hashpartitioning\(activity_id#\d+L, 7\), REPARTITION_BY_NUM", each._jdf.queryExecution().executedPlan().toString())
    assert sorted(each.collect()) == want


def test_goals_of_many_hot_activities_move_few_rows(spark, monkeypatch):
    """Points meet their activity's shape and goals in one join, and the winners in another."""
    from lapwise.operators import efforts, skew

    monkeypatch.setattr(skew, "FEW_GROUPS", 2)
    monkeypatch.setattr(efforts, "FEW_GROUPS", 2, raising=False)
    points = spark.createDataFrame([(a, i, float(i * 7 % 40)) for a in range(6) for i in range(60)], "activity_id long, timestamp long, distance double")
    goals = spark.createDataFrame([(a, 20.0) for a in range(6)], "activity_id long, event_distance double")
    best = efforts.fastest_efforts_by(points, goals, min_rows=20)
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    # Once for each of the two kinds of pieces, in the search and in the minimum it is compared with; and the broadcasts of slices.
    assert plan.count("Join ") - plan.count("rightHint=(strategy=broadcast)") <= 9
    sliced = sorted(map(tuple, best.collect()))
    monkeypatch.undo()
    assert sliced == sorted(map(tuple, efforts.fastest_efforts_by(points, goals).collect())) != []
