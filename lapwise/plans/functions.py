"""Searches as SQL functions: ``SELECT * FROM f(...)``, and per row of another table with ``LATERAL f(...)``."""

from __future__ import annotations

from pyspark.sql import SparkSession

# One activity and distance, or all rows of a lateral join at once: Spark turns the arguments into grouping columns of
# every window below. The method is that of operators.efforts: points and goals on one line, pieces where distance falls.
_SHORTEST_DURATION = """
CREATE OR REPLACE TEMPORARY FUNCTION shortest_duration_for_distance(event_distance DOUBLE, activity BIGINT)
RETURNS TABLE (shortest_duration INTERVAL DAY TO SECOND, start_time TIMESTAMP)
COMMENT 'Shortest time in which an activity covers a distance in metres, with each start that reaches it'
RETURN WITH points AS (
    SELECT unix_micros(timestamp) AS us, CAST(round(CAST(distance AS DOUBLE) * 1000) AS BIGINT) AS mm
    FROM (SELECT {spread}activity_id, timestamp, distance FROM {record})
    WHERE activity_id = shortest_duration_for_distance.activity AND timestamp IS NOT NULL AND distance IS NOT NULL
        AND shortest_duration_for_distance.event_distance > 0
    -- No row, but a union makes Spark meet points with pairs of activity and distance, not with either.
    UNION ALL SELECT 0, 0 FROM {record} WHERE false
),
times AS (SELECT us, min(mm) AS low, max(mm) AS high FROM points GROUP BY us),
ranked AS (
    SELECT us, low, high, row_number() OVER (ORDER BY us) - 1 AS place, count(*) OVER () AS n,
           max(high) OVER (ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
    FROM times
),
shaped AS (SELECT *, max(coalesce(before > low, false) OR low < high) OVER () AS falls FROM ranked),
pieces AS (
    SELECT us, low, high, place, level
    FROM shaped LATERAL VIEW explode(
        CASE WHEN falls THEN sequence(0, greatest(CAST(ceil(log2(n)) AS INT), 1) - 1) ELSE array(-1) END) AS level
),
roles AS (
    SELECT us, level, IF(level < 0, 0, shiftright(place, level + 1)) AS node,
           IF(level >= 0 AND late, high, low) AS mm, level < 0 OR NOT late AS starts, level < 0 OR late AS ends
    FROM (SELECT *, (shiftright(place, greatest(level, 0)) & 1) = 1 AS late FROM pieces)
),
reaching AS (
    SELECT *, mm + CAST(round(shortest_duration_for_distance.event_distance * 1000) AS BIGINT) AS reach FROM roles
),
line AS (
    SELECT us, level, node, at, goal
    FROM reaching LATERAL VIEW inline(array(
        named_struct('at', reach, 'goal', 1, 'counts', starts),
        named_struct('at', mm, 'goal', 0, 'counts', ends))) AS at, goal, counts
    WHERE counts
),
met AS (
    SELECT us, goal, min(IF(goal = 0, us, NULL)) OVER (
        PARTITION BY level, node ORDER BY at DESC, goal ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS first
    FROM line
),
best AS (SELECT us, first - us AS took, min(first - us) OVER () AS least FROM met WHERE goal = 1 AND first IS NOT NULL)
SELECT make_dt_interval(0, 0, 0, CAST(took / 1000000 AS DECIMAL(18, 6))), timestamp_micros(us) FROM best WHERE took = least
"""


def register_functions(spark: SparkSession, record: str = "record", tasks: int | None = None) -> None:
    """Make ``shortest_duration_for_distance(event_distance, activity)`` known to the session.

    ``record`` is a table or view of points: ``Store.register_views`` makes one. The longest activity must fit one
    task; ``operators.efforts.fastest_efforts_by`` slices larger ones.
    For a lateral join over many activities, ``tasks`` (``operators.skew.tasks_for``) deals them out.
    """
    spread = f"/*+ REPARTITION({tasks}, activity_id) */ " if tasks else ""
    spark.sql(_SHORTEST_DURATION.format(record=record, spread=spread))
