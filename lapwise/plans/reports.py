"""Queries over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.operators.efforts import fastest_effort, fastest_efforts
from lapwise.operators.sports import activities_over, longest_multi_session
from lapwise.sources.tables import Store


def shortest_duration_for_distance(store: Store, event_distance: int, activity: int | None = None) -> DataFrame:
    """``shortest_duration, start_time`` of one activity, or of each, earliest start first."""
    best = fastest_effort(
        store.read("record"), event_distance, activity_id=activity, clustered=store.clustered("record")
    )
    best = by_start(best)
    return best.select(*([] if activity is not None else ["activity_id"]), "shortest_duration", "start_time")


def by_start(best: DataFrame, key: str = "activity_id") -> DataFrame:
    """Efforts in order of their start."""
    return best.orderBy(F.asc_nulls_last("start_time"), key)


def best_times(store: Store, distances_m: list[float]) -> DataFrame:
    return fastest_efforts(store.read("record"), distances_m, clustered=store.clustered("record"))


def long_activities(store: Store, over_miles: float = 9, sport: str = "running") -> DataFrame:
    return activities_over(store.read("activity"), store.read("session"), over_miles, sport)


def longest_multi_session_activities(store: Store) -> DataFrame:
    return longest_multi_session(store.read("activity"), store.read("session"))
