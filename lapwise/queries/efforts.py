"""Fastest efforts and point deltas on ``events``: a user is an activity, time is ``ts``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.operators.efforts import fastest_effort, fastest_efforts, fastest_efforts_by, point_deltas
from lapwise.operators.skew import measured, running, tasks_for, widened_rows
from lapwise.plans.functions import register_functions
from lapwise.queries.tables import cents, micros, read

NAMES = {"key": "user_id", "time": "us", "distance": "d"}


def tracks(spark: SparkSession, sf_dir: str, min_rows: float | None = None) -> tuple[DataFrame, float]:
    """Distance covered so far, in cents of ``value``; and the row limit, counted once."""
    steps = read(spark, sf_dir, "events").select(
        "user_id", "event_id", micros("ts").alias("us"), cents("value").alias("step")
    )
    limit = measured(steps, ["user_id"], min_rows)
    return running(steps, ["user_id"], ["us", "event_id"], {"d": ("sum", "step")}, min_rows=limit), limit


def _result(df: DataFrame, *extra: str) -> DataFrame:
    return df.select("user_id", *extra, "duration_us", F.unix_micros("start_time").alias("start_us"))


def effort(spark, sf_dir, min_rows=None):
    points, limit = tracks(spark, sf_dir, min_rows)
    return _result(fastest_effort(points, 20000, min_rows=limit, **NAMES))


def effort_sliced(spark, sf_dir):
    """Every user taken for a hot group."""
    return effort(spark, sf_dir, 20)


def effort_ladder(spark, sf_dir):
    points, limit = tracks(spark, sf_dir)
    best = fastest_efforts(points, [5000, 20000, 100000], min_rows=limit, **NAMES)
    return _result(best, "event_distance")


def effort_uneven(spark, sf_dir):
    """Distances that rise and fall."""
    points = read(spark, sf_dir, "events").select("user_id", micros("ts").alias("us"), cents("value").alias("d"))
    return _result(fastest_effort(points, 5000, **NAMES))


def effort_fractional(spark, sf_dir):
    """Distances in fractions of a metre, as devices give them."""
    points, limit = tracks(spark, sf_dir)
    points = points.withColumn("d", F.col("d") / 100)
    return _result(fastest_effort(points, 200.07, min_rows=limit, **NAMES))


def effort_one(spark, sf_dir):
    """One activity, picked before anything is counted."""
    points = read(spark, sf_dir, "events").where("user_id = 7").select(
        "user_id", micros("ts").alias("us"), cents("value").alias("d")
    )
    return _result(fastest_effort(points, 5000, activity_id=7, **NAMES))


def _goals(points: DataFrame) -> DataFrame:
    """A distance per user: 40 to 200 metres."""
    users = points.select("user_id").distinct()
    return users.withColumn("event_distance", ((F.col("user_id") % 5 + 1) * 40).cast("double"))


def effort_by_goal(spark, sf_dir, min_rows=None):
    """Each user's own distance, on steady tracks and on uneven ones."""
    steady, limit = tracks(spark, sf_dir, min_rows)
    uneven = read(spark, sf_dir, "events").select("user_id", micros("ts").alias("us"), cents("value").alias("d"))
    out = []
    for kind, points in (("steady", steady), ("uneven", uneven)):
        metres = points.withColumn("d", F.col("d") / 100)
        best = fastest_efforts_by(metres, _goals(points), min_rows=limit, **NAMES)
        out.append(_result(best, "event_distance").withColumn("kind", F.lit(kind)))
    return out[0].unionByName(out[1])


def effort_by_goal_sliced(spark, sf_dir):
    return effort_by_goal(spark, sf_dir, 20)


def effort_sql(spark, sf_dir):
    """The same through the SQL function, once per user by a lateral join."""
    steady, _ = tracks(spark, sf_dir)
    tasks = tasks_for(spark, widened_rows(read(spark, sf_dir, "events"), "user_id"))
    uneven = read(spark, sf_dir, "events").select("user_id", micros("ts").alias("us"), cents("value").alias("d"))
    out = []
    for kind, points in (("steady", steady), ("uneven", uneven)):
        named = points.select(
            F.col("user_id").alias("activity_id"), F.timestamp_micros("us").alias("timestamp"), (F.col("d") / 100).alias("distance")
        )
        named.createOrReplaceTempView(f"{kind}_points")
        _goals(points).createOrReplaceTempView("goals")
        register_functions(spark, f"{kind}_points", tasks)
        out.append(spark.sql(f"""
            SELECT g.user_id, g.event_distance, s.start_time,
                   CAST(extract(SECOND FROM s.shortest_duration) * 1000000
                        + 60000000L * (extract(MINUTE FROM s.shortest_duration) + 60L * (extract(HOUR FROM s.shortest_duration)
                        + 24L * extract(DAY FROM s.shortest_duration))) AS BIGINT) AS duration_us, '{kind}' AS kind
            FROM goals g, LATERAL shortest_duration_for_distance(g.event_distance, g.user_id) s
        """))
    return _result(out[0].unionByName(out[1]), "event_distance", "kind")


def deltas(spark, sf_dir):
    points, limit = tracks(spark, sf_dir)
    out = point_deltas(points, tie=["event_id"], min_rows=limit, **NAMES)
    return out.select(
        "user_id", "event_id", "us", "d", F.col("start_timestamp").alias("start_us"), F.col("start_distance").alias("start_d")
    )


_TRACKS = """
    SELECT user_id, event_id, epoch_us(ts) AS us,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS d
    FROM events
"""
_PAIRS = """
    SELECT a.user_id, a.us - b.us AS duration_us, b.us AS start_us
    FROM points a JOIN points b ON a.user_id = b.user_id AND a.us > b.us AND a.d - b.d >= {distance}
"""
_BEST = """
    SELECT DISTINCT user_id, duration_us, start_us FROM (
        SELECT *, min(duration_us) OVER (PARTITION BY user_id) AS best FROM pairs
    ) WHERE duration_us = best
"""
_EFFORT = f"WITH points AS ({_TRACKS}), pairs AS ({_PAIRS.format(distance=20000)}) {_BEST}"

_LADDER = f"""
    WITH points AS ({_TRACKS}), rungs(event_distance) AS (VALUES (5000.0::DOUBLE), (20000.0), (100000.0)), pairs AS (
        SELECT a.user_id, event_distance, a.us - b.us AS duration_us, b.us AS start_us
        FROM rungs, points a JOIN points b ON a.user_id = b.user_id AND a.us > b.us
        WHERE a.d - b.d >= event_distance
    )
    SELECT DISTINCT user_id, event_distance, duration_us, start_us FROM (
        SELECT *, min(duration_us) OVER (PARTITION BY user_id, event_distance) AS best FROM pairs
    ) WHERE duration_us = best
"""

_BY_GOAL = f"""
    WITH points AS (
        SELECT 'steady' AS kind, user_id, us, d FROM ({_TRACKS})
        UNION ALL SELECT 'uneven', user_id, epoch_us(ts), CAST(round(value * 100) AS BIGINT) FROM events
    ),
    pairs AS (
        SELECT a.kind, a.user_id, a.us - b.us AS duration_us, b.us AS start_us
        FROM points a JOIN points b ON a.kind = b.kind AND a.user_id = b.user_id AND a.us > b.us
        WHERE a.d - b.d >= (a.user_id % 5 + 1) * 4000
    )
    SELECT DISTINCT kind, user_id, ((user_id % 5 + 1) * 40)::DOUBLE AS event_distance, duration_us, start_us FROM (
        SELECT *, min(duration_us) OVER (PARTITION BY kind, user_id) AS best FROM pairs
    ) WHERE duration_us = best
"""

QUERIES = {
    "fastest_effort_by_goal": (effort_by_goal, _BY_GOAL),
    "fastest_effort_by_goal_sliced": (effort_by_goal_sliced, _BY_GOAL),
    "fastest_effort_sql": (effort_sql, _BY_GOAL),
    "fastest_effort": (effort, _EFFORT),
    "fastest_effort_sliced": (effort_sliced, _EFFORT),
    "fastest_effort_ladder": (effort_ladder, _LADDER),
    "fastest_effort_uneven": (
        effort_uneven,
        "WITH points AS (SELECT user_id, epoch_us(ts) AS us, CAST(round(value * 100) AS BIGINT) AS d FROM events), "
        f"pairs AS ({_PAIRS.format(distance=5000)}) {_BEST}",
    ),
    "fastest_effort_fractional": (
        effort_fractional, f"WITH points AS ({_TRACKS}), pairs AS ({_PAIRS.format(distance=20007)}) {_BEST}",
    ),
    "fastest_effort_one": (
        effort_one,
        "WITH points AS (SELECT user_id, epoch_us(ts) AS us, CAST(round(value * 100) AS BIGINT) AS d FROM events "
        f"WHERE user_id = 7), pairs AS ({_PAIRS.format(distance=5000)}) {_BEST}",
    ),
    "point_deltas": (
        deltas,
        f"""SELECT user_id, event_id, us, d, lag(us) OVER w AS start_us, lag(d) OVER w AS start_d
            FROM ({_TRACKS}) WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)""",
    ),
}
