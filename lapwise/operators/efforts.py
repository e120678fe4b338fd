"""Fastest effort: the shortest time in which an activity covers a distance.

A pair (start, end) of points of one activity counts when ``end.time > start.time`` and
``end.distance - start.distance >= D``. Pairs are never formed. When distance does not
fall over time, the end for a start is the earliest point at ``start.distance + D`` or
beyond: one running minimum in order of distance. An activity whose distance falls
somewhere (a reset, a correction) is first split by rank in time into halves, quarters
and so on; any two points lie in the two halves of exactly one of those pieces, and there
the earlier half holds the starts and the later half the ends, so the same minimum works.
That costs log2(points) rows per point, for such activities only; they count with all these rows where
it is decided what one task may take.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.operators.skew import (
    FEW_GROUPS, MEASURED, Groups, as_groups, attach, heavy_groups, min_rows_for, part_hot, previous, running,
    tasks_for, widened_rows,
)
from lapwise.session import durable

PIECE = ["_level", "_node"]


def point_deltas(
    records: DataFrame,
    key: str = "activity_id",
    time: str = "timestamp",
    distance: str = "distance",
    tie: list[str] = (),
    min_rows: float | None = None,
) -> DataFrame:
    """Each point with time and distance of the point before it.

    ``time`` is numeric or a timestamp; ``tie`` orders points of equal time.
    """
    df = records
    order = time
    if not _is_numeric(df, time):
        order = "_micros"
        df = df.withColumn(order, F.unix_micros(time))
    out = previous(
        df, [key], [order, *tie], {"start_timestamp": time, "start_distance": distance}, min_rows=min_rows
    )
    return out.drop("_micros")


def fastest_effort(
    records: DataFrame,
    distance_m: float,
    activity_id: int | None = None,
    key: str = "activity_id",
    time: str = "timestamp",
    distance: str = "distance",
    min_rows: float | None = None,
    clustered: bool = False,
) -> DataFrame:
    """Columns ``key, shortest_duration, duration_us, start_time``, for every activity or one.

    All starts that reach the shortest time are kept, one row each; an activity that never
    covers the distance has none. ``distance_m`` must be positive.
    """
    if distance_m <= 0:
        raise ValueError("distance must be positive")
    best = fastest_efforts(records, [distance_m], activity_id, key, time, distance, min_rows, clustered)
    return best.drop("event_distance")


def fastest_efforts(
    records: DataFrame,
    distances_m: list[float],
    activity_id: int | None = None,
    key: str = "activity_id",
    time: str = "timestamp",
    distance: str = "distance",
    min_rows: float | None = None,
    clustered: bool = False,
) -> DataFrame:
    """``fastest_effort`` for several distances at once, with ``event_distance`` as a column.

    One exchange and one sort serve all distances; none where ``records`` come ``clustered`` by ``key``, as a
    bucketed store has them.
    """
    if not distances_m or min(distances_m) <= 0:
        raise ValueError("distances must be positive")
    points = records if activity_id is None else records.where(F.col(key) == activity_id)
    whole = all(float(d).is_integer() for d in distances_m) and not _has_fractions(records, distance)
    scale = 1 if whole else 1000
    wanted = {float(d): round(d * scale) for d in distances_m}
    tasks = None if clustered else tasks_for(records.sparkSession, widened_rows(points, key))
    points = _points(points, key, time, distance, scale)

    limit = min_rows_for(points.sparkSession, min_rows)
    hot_keys = _too_wide(points, key, limit)
    if hot_keys is not None:
        cold, hot = part_hot(points, [key], hot_keys)
        best = _within_task(cold, key, wanted, clustered, tasks).unionByName(_across_tasks(hot, key, wanted, limit, hot_keys))
    else:
        best = _within_task(points, key, wanted, clustered, tasks)
    return _efforts(best, key)


def fastest_efforts_by(
    records: DataFrame,
    goals: DataFrame,
    key: str = "activity_id",
    time: str = "timestamp",
    distance: str = "distance",
    min_rows: float | None = None,
    clustered: bool = False,
) -> DataFrame:
    """``fastest_efforts`` for the distances that ``goals (key, event_distance)`` name for each activity.

    A frame's reach must be a literal, so points and goals are put on one line instead: every start adds its goal
    beyond it, and a running minimum from the far end says which end is the earliest at a goal or beyond. Goals that are
    null, or not positive, have no effort; a goal named twice counts once.
    """
    scale = 1000 if _has_fractions(records, distance) or _has_fractions(goals, "event_distance") else 1
    steps = F.round(F.col("event_distance").cast("double") * scale).cast("long")
    asked = goals.select(key, F.col("event_distance").cast("double").alias("event_distance"), steps.alias("_step"))
    asked = asked.where("_step > 0").distinct()
    tasks = None if clustered else tasks_for(records.sparkSession, widened_rows(records, key))
    points = _points(records, key, time, distance, scale)

    limit = min_rows_for(points.sparkSession, min_rows)
    hot_keys = _too_wide(points, key, limit)
    if hot_keys is None:
        return _efforts(_goals_within_task(_with_goals(points, asked, key), asked, key, clustered, tasks), key)
    cold, hot = part_hot(points, [key], hot_keys)
    hot_asked = part_hot(asked, [key], hot_keys)[1]
    best = _goals_within_task(_with_goals(cold, asked, key), asked, key, clustered, tasks).unionByName(
        # Without a broadcast this would move all points once more; the search itself leaves out what has no goal.
        _goals_across_tasks(_with_goals(hot, hot_asked, key) if hot_keys.few else hot, hot_asked, key, limit, hot_keys)
    )
    return _efforts(best, key)


def _with_goals(points: DataFrame, asked: DataFrame, key: str) -> DataFrame:
    return points.join(asked.select(key).distinct(), key, "left_semi")


def _has_fractions(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() in {"double", "float", "decimal"}


def _points(records: DataFrame, key: str, time: str, distance: str, scale: int) -> DataFrame:
    """``key, _us, _d``: whole distances are compared as they are, others in whole millimetres, so differences are exact."""
    us = F.col(time) if _is_numeric(records, time) else F.unix_micros(time)
    covered = F.round(F.col(distance).cast("double") * scale).cast("long") if scale > 1 else F.col(distance).cast("long")
    points = records.select(key, us.cast("long").alias("_us"), covered.alias("_d"))
    return points.where("_us IS NOT NULL AND _d IS NOT NULL")


def _efforts(best: DataFrame, key: str) -> DataFrame:
    return best.select(
        "event_distance",
        key,
        F.make_dt_interval(secs=(F.col("_dur") / 1_000_000).cast("decimal(18,6)")).alias("shortest_duration"),
        F.col("_dur").alias("duration_us"),
        F.timestamp_micros("_us").alias("start_time"),
    )


def _too_wide(points: DataFrame, key: str, limit: float) -> Groups | None:
    """Activities with more rows than one task may take, counted as the search widens them."""
    if limit == MEASURED:
        return None
    large = heavy_groups(points, [key], limit / max(1, ceil(log2(max(limit, 2)))))
    if large is None:
        return None
    # Few activities come this near to the limit; of them it is looked up whose distance falls.
    middle, wide = as_groups(large.frame.where(F.col("_n") <= limit), large.rows), large.frame.where(F.col("_n") > limit)
    if middle is None:
        return as_groups(wide, large.rows)
    times = part_hot(points, [key], middle)[1].groupBy(key, "_us").agg(F.min("_d").alias("_low"), F.max("_d").alias("_high"))
    in_time = Window.partitionBy(key).orderBy("_us").rowsBetween(Window.unboundedPreceding, -1)
    falling = times.select(key, _falls(F.max("_high").over(in_time)).alias("_falls"))
    falling = falling.where("_falls").select(key).distinct()
    widened = middle.frame.join(falling, key, "left_semi").where(F.col("_n") * F.ceil(F.log2("_n")) > limit)
    return as_groups(durable(wide.unionByName(widened)), large.rows)


def _is_numeric(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() in {"long", "integer", "short", "double", "float", "decimal"}


def _marked(points: DataFrame, key: str, clustered: bool, tasks: int | None) -> DataFrame:
    """Each time of an activity with its rank, the activity's number of times, and whether its distance falls anywhere.

    One exchange by ``key``, into ``tasks`` if given; every later window reuses that partitioning.
    """
    group = Window.partitionBy(key)
    in_time = group.orderBy("_us")
    spread = points if clustered else points.repartition(*([tasks] if tasks else []), key)
    times = spread.groupBy(key, "_us").agg(F.min("_d").alias("_low"), F.max("_d").alias("_high"))
    return (
        times.withColumn("_before", F.max("_high").over(in_time.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_rank", F.row_number().over(in_time).cast("long") - 1)
        .withColumn("_irregular", F.max(_falls(F.col("_before"))).over(group))
        .withColumn("_count", F.count(F.lit(1)).over(group))
    )


def _falls(before: Column) -> Column:
    """True where a point lies below an earlier one, or points of one time disagree."""
    return F.coalesce(before > F.col("_low"), F.lit(False)) | (F.col("_low") < F.col("_high"))


def _pieces(irregular: Column, count: Column) -> Column:
    """Levels a point takes part in: -1 alone (start and end at once) or all halvings."""
    levels = F.greatest(F.ceil(F.log2(count.cast("double"))).cast("int"), F.lit(1))
    return F.when(irregular, F.sequence(F.lit(0), levels - 1)).otherwise(F.array(F.lit(-1)))


def _roles(df: DataFrame) -> DataFrame:
    """Piece, role and position of each point; rank 0 is the first point in time."""
    level = F.col("_level")
    whole = level == -1
    late = F.expr("shiftright(_rank, greatest(_level, 0)) & 1L = 1")
    return df.withColumns(
        {
            "_node": F.when(whole, F.lit(0)).otherwise(F.expr("shiftright(_rank, _level + 1)")).cast("long"),
            "_starts": whole | ~late,
            "_ends": whole | late,
            "_pos": F.when(late & ~whole, F.col("_high")).otherwise(F.col("_low")),
        }
    )


def _within_task(points: DataFrame, key: str, distances: dict[float, int], clustered: bool, tasks: int | None) -> DataFrame:
    """``distances`` as asked for, with their steps of ``_d``."""
    group = Window.partitionBy(key)
    marked = _marked(points, key, clustered, tasks)
    pieces = _roles(marked.withColumn("_level", F.explode(_pieces(F.col("_irregular"), F.col("_count")))))

    def taken(step: int) -> Column:
        """Time from a start to the first end at least ``step`` further on."""
        first_end = F.expr(
            f"min(CASE WHEN _ends THEN _us END) OVER (PARTITION BY `{key}`, {', '.join(PIECE)} ORDER BY _pos DESC "
            f"RANGE BETWEEN UNBOUNDED PRECEDING AND {step} PRECEDING)"
        )
        return F.when(F.col("_starts"), first_end - F.col("_us"))

    at = range(len(distances))
    found = pieces.withColumns({f"_dur{i}": taken(d) for i, d in enumerate(distances.values())})
    best = found.withColumns({f"_best{i}": F.min(f"_dur{i}").over(group) for i in at})
    hits = [
        F.when(
            F.col(f"_dur{i}") == F.col(f"_best{i}"),
            F.struct(F.lit(float(d)).alias("event_distance"), F.col(f"_dur{i}").alias("_dur")),
        )
        for i, d in enumerate(distances)
    ]
    return (
        best.where(" OR ".join(f"_dur{i} = _best{i}" for i in at))
        .select(key, "_us", F.explode(F.array(*hits)).alias("_hit"))
        .where("_hit IS NOT NULL")
        .select(key, "_us", "_hit.event_distance", "_hit._dur")
    )


def _goals_within_task(points: DataFrame, asked: DataFrame, key: str, clustered: bool, tasks: int | None) -> DataFrame:
    """The search along a line of points and goals, for activities of one task each."""
    marked = _marked(points, key, clustered, tasks)
    pieces = _roles(marked.withColumn("_level", F.explode(_pieces(F.col("_irregular"), F.col("_count"))))).join(asked, key)
    found = _reached(_first_ends(_line(pieces, key), key), key)
    best = F.min("_dur").over(Window.partitionBy(key, "event_distance"))
    return found.withColumn("_best", best).where("_dur = _best").select(key, "_us", "event_distance", "_dur")


def _line(pieces: DataFrame, key: str, *keep: str) -> DataFrame:
    """Ends, and the goals of starts, from the far end on: ``_at``, at one place ends (``_kind`` 0) first."""
    none = F.lit(None).cast("long")
    end = F.struct((-F.col("_pos")).alias("_at"), F.lit(0).alias("_kind"), none.alias("_start"), F.col("_us").alias("_end"))
    goal = F.struct(
        (-(F.col("_pos") + F.col("_step"))).alias("_at"), F.lit(1).alias("_kind"), F.col("_us").alias("_start"), none.alias("_end")
    )
    met = F.explode(F.array_compact(F.array(F.when(F.col("_ends"), end), F.when(F.col("_starts"), goal))))
    return pieces.select(key, "event_distance", *PIECE, *keep, met.alias("_p")).select(key, "event_distance", *PIECE, *keep, "_p.*")


def _first_ends(line: DataFrame, key: str) -> DataFrame:
    far_first = Window.partitionBy(key, "event_distance", *PIECE).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    return line.withColumn("_first", F.min("_end").over(far_first))


def _reached(met: DataFrame, key: str) -> DataFrame:
    return met.where("_start IS NOT NULL AND _first IS NOT NULL").select(
        key, "event_distance", F.col("_start").alias("_us"), (F.col("_first") - F.col("_start")).alias("_dur")
    )


def _ranked_across_tasks(points: DataFrame, key: str, limit: float, hot: Groups) -> tuple[DataFrame, DataFrame]:
    """What ``_marked`` gives, of activities too large for one task: their times, and one row per activity."""
    times = points.groupBy(key, "_us").agg(F.min("_d").alias("_low"), F.max("_d").alias("_high"))
    before = running(
        times, [key], ["_us"], {"_before": ("max", "_high"), "_rank": ("count", F.lit(1))}, inclusive=False,
        min_rows=limit, hot_rows=hot.rows,
    )
    # Read several times below; written once so that the slicing above runs once.
    before = durable(before)
    shape = before.groupBy(key).agg(
        F.max(_falls(F.col("_before"))).alias("_irregular"), F.count(F.lit(1)).alias("_count")
    )
    return before, shape


def _search_across_tasks(before: DataFrame, about: DataFrame, key: str, limit: float) -> DataFrame:
    """The search along a line, pieces too large for one task in slices; ``about`` has the activities' shape and goals.

    Per-activity results are at most one row per hot activity and goal; if those are few, they are broadcast.
    """
    levels = F.greatest(F.size(_pieces(F.col("_irregular"), F.col("_count"))), F.lit(2))
    rows = F.sum(F.when(2 * F.col("_count") > limit, F.col("_count") * levels))
    goals, hot_rows = about.agg(F.count(F.lit(1)), rows).first()
    few = goals <= FEW_GROUPS
    joined = attach(before.drop("_before"), about, [key], few, "inner")
    pieces = _roles(joined.withColumn("_level", F.explode(_pieces(F.col("_irregular"), F.col("_count")))))
    # How many rows a piece has follows from its level, so none need be counted.
    size = F.when(F.col("_level") < 0, 2 * F.col("_count")).otherwise(
        F.least(F.col("_count"), F.expr("shiftleft(1L, greatest(_level, 0) + 1)"))
    )
    line = _line(pieces.withColumn("_wide", size > limit), key, "_wide")
    met = _first_ends(line.where("NOT _wide").drop("_wide"), key)
    if hot_rows:
        # Times tell rows of one place apart, so a long stop can be cut too; which ends come first does not depend on them.
        wide = line.where("_wide").drop("_wide").withColumn("_t", F.coalesce("_start", "_end"))
        cell = [key, "event_distance", *PIECE]
        sliced = running(
            wide, cell, ["_at", "_kind", "_t"], {"_first": ("min", "_end")}, min_rows=limit, hot_rows=hot_rows
        )
        met = met.unionByName(sliced.drop("_t"))
    found = _reached(met, key)
    best = found.groupBy(key, "event_distance").agg(F.min("_dur").alias("_best"))
    return attach(found, best, [key, "event_distance"], few).where("_dur = _best").select(key, "_us", "event_distance", "_dur")


def _goals_across_tasks(points: DataFrame, asked: DataFrame, key: str, limit: float, hot: Groups) -> DataFrame:
    before, shape = _ranked_across_tasks(points, key, limit, hot)
    return _search_across_tasks(before, shape.join(asked, key), key, limit)


def _across_tasks(points: DataFrame, key: str, distances: dict[float, int], limit: float, hot: Groups) -> DataFrame:
    """The same for activities too large for one task: every scan runs in slices."""
    before, shape = _ranked_across_tasks(points, key, limit, hot)
    goals = F.array(*[
        F.struct(F.lit(float(d)).alias("event_distance"), F.lit(step).cast("long").alias("_step")) for d, step in distances.items()
    ])
    about = shape.select("*", F.explode(goals).alias("_goal")).select(*shape.columns, "_goal.*")
    return _search_across_tasks(before, about, key, limit)
