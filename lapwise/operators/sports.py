"""Sport of an activity, and the reports built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.functions.values import miles


def classify_sport(sessions: DataFrame, key: str = "activity_id", sport: str = "sport") -> DataFrame:
    """``multi_sport`` where the sessions name two sports or more, else the one they name.

    Smallest and largest differ exactly when there are two or more, and both combine
    before the shuffle, unlike a distinct count.
    """
    several = F.min(sport) != F.max(sport)
    return sessions.groupBy(key).agg(F.when(several, "multi_sport").otherwise(F.max(sport)).alias("sport"))


def activities_with_sport(activities: DataFrame, sessions: DataFrame, key: str = "activity_id") -> DataFrame:
    """Every activity with its sport, null without sessions."""
    return activities.join(classify_sport(sessions, key), key, "left")


def activities_over(
    activities: DataFrame,
    sessions: DataFrame,
    over_miles: float = 9,
    sport: str = "running",
    key: str = "activity_id",
    distance: str = "adjusted_distance",
    time: str = "timestamp",
) -> DataFrame:
    """Activities of one sport longer than ``over_miles``, newest first."""
    long_enough = activities.where(miles(F.col(distance)) > over_miles)
    return (
        activities_with_sport(long_enough, sessions, key)
        .where(F.col("sport") == sport)
        .orderBy(F.desc_nulls_first(time), key)
    )


def longest_multi_session(
    activities: DataFrame,
    sessions: DataFrame,
    key: str = "activity_id",
) -> DataFrame:
    """Activities of several sessions with each session distance, longest first.

    Sessions of equal distance in one activity are one row and weigh in together; that
    weight orders rows within an activity.
    """
    # Grouped before the join, by two columns: few rows per activity meet its long one.
    weighed = sessions.groupBy(key, "total_distance").agg(F.sum("total_distance").alias("sum_distance"))
    return (
        activities.where(F.col("num_sessions") > 1).join(weighed, key)
        .select(*activities.columns, "total_distance", "sum_distance")
        .orderBy(F.desc_nulls_first("adjusted_distance"), F.desc_nulls_first("sum_distance"), key)
    )


def activity_totals(
    sessions: DataFrame, key: str = "activity_id", distance: str = "total_distance", duration: str = "total_timer_time"
) -> DataFrame:
    """Summed session distance and time; all missing adds up to 0."""
    return sessions.groupBy(key).agg(
        F.coalesce(F.sum(distance), F.lit(0.0)).alias("adjusted_distance"),
        F.coalesce(F.sum(duration), F.lit(0.0)).alias("adjusted_duration"),
    )


def fill_activity_time(activities: DataFrame, sessions: DataFrame, key: str = "activity_id") -> DataFrame:
    """A missing activity time becomes the earliest session start."""
    earliest = sessions.groupBy(key).agg(F.min("start_time").alias("_earliest"))
    return (
        activities.join(earliest, key, "left")
        .withColumn("timestamp", F.coalesce("timestamp", "_earliest"))
        .select(*activities.columns)
    )
