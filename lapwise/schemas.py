"""Table layouts.

Column names, their order and the text limits are fixed values: stored data and
the queries on it depend on them. ``real`` columns are kept as double.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Name and type of every stored column, in write order.
LAYOUTS: dict[str, str] = {
    "activity": """
        activity_id bigint, timestamp timestamp, adjusted_distance double, adjusted_duration double,
        workout_feel smallint, effort smallint, category string, activity_name string, description string,
        total_timer_time double, local_timestamp timestamp_ntz, num_sessions int, type string, event string,
        event_type string, event_group smallint
    """,
    "file_id": """
        activity_id bigint, serial_number bigint, time_created timestamp, manufacturer string, number double,
        type string, product string
    """,
    "lap": """
        activity_id bigint, start_time timestamp, number smallint, total_distance double, total_timer_time double,
        total_ascent smallint, total_descent smallint, avg_vertical_oscillation double, avg_stance_time double,
        avg_vertical_ratio double, avg_stance_time_balance double, avg_step_length double,
        avg_running_cadence smallint, max_heart_rate smallint, avg_heart_rate smallint, intensity string,
        avg_power smallint, max_power smallint, normalized_power smallint
    """,
    "record": """
        activity_id bigint, latitude double, longitude double, lap smallint, altitude double, timestamp timestamp,
        heart_rate smallint, cadence smallint, fractional_cadence decimal(1,1), enhanced_speed double,
        distance double
    """,
    "session": """
        activity_id bigint, timestamp timestamp, start_time timestamp, start_position_lat double,
        start_position_long double, total_elapsed_time double, total_timer_time double, total_distance double,
        total_strokes double, nec_lat double, nec_long double, swc_lat double, swc_long double, message_index int,
        total_calories smallint, total_fat_calories double, enhanced_avg_speed double, avg_speed double,
        enhanced_max_speed double, max_speed double, avg_power smallint, max_power double, total_ascent smallint,
        total_descent smallint, first_lap_index smallint, num_laps smallint, event string, event_type string,
        sport string, sub_sport string, avg_heart_rate smallint, max_heart_rate smallint, avg_cadence smallint,
        max_cadence smallint, total_training_effect double, event_group smallint, trigger string,
        pool_length double, pool_length_unit string
    """,
    "length": """
        activity_id bigint, timestamp timestamp, start_time timestamp, message_index smallint,
        total_timer_time double, total_strokes smallint, avg_speed double, swim_stroke string, length_type string
    """,
    "event": """
        activity_id bigint, timestamp timestamp, event string, event_type string, data string, event_group smallint
    """,
}

# Longest text each column takes.
TEXT_LIMITS: dict[str, dict[str, int]] = {
    "activity": {"category": 15, "type": 50, "event": 50, "event_type": 50},
    "file_id": {"manufacturer": 50, "type": 50, "product": 50},
    "lap": {"intensity": 20},
    "record": {},
    "session": {"event": 50, "event_type": 50, "sport": 50, "sub_sport": 50, "trigger": 50, "pool_length_unit": 20},
    "length": {"swim_stroke": 15, "length_type": 15},
    "event": {"event": 50, "event_type": 50, "data": 50},
}

# Columns no device message carries; derivations and sidecars fill them.
DERIVED: dict[str, set[str]] = {
    "activity": {
        "activity_id", "adjusted_distance", "adjusted_duration", "workout_feel", "effort", "category",
        "activity_name", "description",
    },
    "lap": {"activity_id", "number", "intensity"},
    "record": {"activity_id", "lap", "latitude", "longitude"},
}

# Columns sent in semicircles.
SEMICIRCLES: dict[str, list[str]] = {
    "session": ["start_position_lat", "start_position_long", "nec_long", "swc_lat", "swc_long", "nec_lat"],
    "record": ["latitude", "longitude"],
}

CHILD_TABLES = [name for name in LAYOUTS if name != "activity"]

_TYPES: dict[str, T.DataType] = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "double": T.DoubleType(),
    "decimal(1,1)": T.DecimalType(1, 1),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def columns(table: str) -> list[tuple[str, str]]:
    """``(name, type)`` of every column of ``table``; unknown tables raise."""
    if table not in LAYOUTS:
        raise ValueError(f"unknown table {table!r}; known: {', '.join(LAYOUTS)}")
    pairs = " ".join(LAYOUTS[table].split()).replace(",1)", ";1)").split(", ")
    return [(name, kind.replace(";", ",")) for name, kind in (p.split(" ", 1) for p in pairs)]


def struct(table: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns(table)])


DAY = "day"  # optional column of stored messages: the day of the file time
MESSAGES = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    ]
)
