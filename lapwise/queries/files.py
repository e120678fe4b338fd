"""File names and JSON summaries, made from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapwise.functions import names
from lapwise.queries.tables import prop, read
from lapwise.sources.sidecar import PATHS, flatten


def _events(spark, sf_dir):
    at = lambda form: F.date_format("ts", form)
    offset = F.when(F.col("event_id") % 2 == 0, "+00.00").otherwise("+02.00")
    stem = F.concat(at("yyyy-MM-dd'T'HH.mm.ss"), offset, F.lit("_"), F.col("event_id"))
    return read(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", prop("k").alias("k"), stem.alias("stem"),
        F.concat(F.lit("/in/"), stem, F.lit(".fit")).alias("file"),
        F.concat(F.lit("/watch/"), at("yyyy-MM-dd-HH-mm-ss"), F.lit(".fit")).alias("watch"),
    )


def name_parts(spark, sf_dir):
    file = F.col("file")
    return _events(spark, sf_dir).select(
        "event_id",
        names.activity_id(file).alias("activity_id"),
        names.activity_id(F.concat("stem", F.lit("_summary.json"))).alias("summary_id"),
        F.unix_micros(names.export_time(file)).alias("export_us"),
        F.unix_micros(names.watch_time(F.col("watch"))).alias("watch_us"),
        F.unix_date(names.file_date(file)).alias("day"),
    )


def pairs(spark, sf_dir):
    """Every second file has a summary."""
    events = _events(spark, sf_dir)
    files = events.select("event_id", names.pair_key(F.col("file")).alias("pair"))
    summaries = events.where("event_id % 2 = 0").select(
        names.pair_key(F.concat("stem", F.lit("_summary.json"))).alias("pair"), F.col("event_type").alias("category")
    )
    return files.join(summaries, "pair", "left").select("event_id", "category")


def _summaries(spark, sf_dir):
    summary = F.struct(
        F.struct(
            F.col("value").alias("distance"), (F.col("k") * 10).alias("duration"),
            F.when(F.col("k") % 2 == 0, F.col("k")).alias("directWorkoutFeel"),
            F.when(F.col("k") % 5 == 0, F.col("k") + 0.5).alias("directWorkoutRpe"),
        ).alias("summaryDTO"),
        F.when(F.col("k") % 3 != 0, F.struct(F.col("event_type").alias("typeKey"))).alias("eventTypeDTO"),
        F.concat(F.lit("activity "), F.col("event_id")).alias("activityName"),
        F.when(F.col("k") % 4 == 1, F.concat(F.lit('said "'), F.col("event_type"), F.lit('"'))).alias("description"),
        F.array(F.struct(F.lit(1).alias("v")), F.struct(F.col("k").alias("v"))).alias("legs"),
    )
    return _events(spark, sf_dir).select("event_id", F.to_json(summary).alias("doc"))


def json_paths(spark, sf_dir):
    paths = PATHS | {"legs.1.v": "second_leg", "legs.2.v": "third_leg"}
    out = flatten(_summaries(spark, sf_dir), "doc", paths)
    return out.select("event_id", *[F.col(c).cast("double").alias(c) if c in _NUMBERS else c for c in paths.values()])


_NUMBERS = {"adjusted_distance", "adjusted_duration", "workout_feel", "effort", "second_leg", "third_leg"}
_TIME = "date_trunc('second', ts)"

QUERIES = {
    "filename_fields": (
        name_parts,
        f"""SELECT event_id, event_id AS activity_id, event_id AS summary_id,
                   epoch_us({_TIME}) - CASE WHEN event_id % 2 = 0 THEN 0 ELSE 7200000000 END AS export_us,
                   epoch_us({_TIME}) AS watch_us,
                   CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS day
            FROM events""",
    ),
    "summary_pairs": (
        pairs,
        "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type END AS category FROM events",
    ),
    "json_paths": (
        json_paths,
        """SELECT event_id, value AS adjusted_distance, k * 10.0::DOUBLE AS adjusted_duration,
                  CASE WHEN k % 2 = 0 THEN k::DOUBLE END AS workout_feel, CASE WHEN k % 5 = 0 THEN k + 0.5::DOUBLE END AS effort,
                  CASE WHEN k % 3 <> 0 THEN event_type END AS category, 'activity ' || event_id AS activity_name,
                  CASE WHEN k % 4 = 1 THEN 'said "' || event_type || '"' END AS description, k::DOUBLE AS second_leg, CAST(NULL AS DOUBLE) AS third_leg
           FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)""",
    ),
}
