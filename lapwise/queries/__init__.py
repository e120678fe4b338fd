"""Each operator run over the shared test tables, with the same result in SQL.

The tables stand in for activity data: users or orders for activities, events for points
or messages, line items for laps or sessions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def collect() -> tuple[dict[str, Query], dict[str, str]]:
    """All queries, and the SQL of those that have one."""
    from lapwise.queries import activities, efforts, files, laps, loads, stored, stores, tracks

    queries: dict[str, Query] = {}
    sql: dict[str, str] = {}
    for module in (efforts, laps, activities, stores, files, tracks, loads, stored):
        for name, (query, text) in module.QUERIES.items():
            queries[name] = query
            if text is not None:
                sql[name] = text
    return queries, sql
