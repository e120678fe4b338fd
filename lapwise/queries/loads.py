"""What loads would store, planned on files made from ``orders``."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from lapwise.plans.ingest import plan_connect, plan_watch
from lapwise.queries.tables import read

_AFTER = datetime(1996, 6, 1, tzinfo=timezone.utc)


def _files(spark, sf_dir):
    """An order is a file; keys choose what is wrong with it."""
    k = F.col("o_orderkey")
    at = lambda form: F.date_format("o_orderdate", form)
    name = F.when(k % 11 == 0, F.lit("someday")).otherwise(at("yyyy-MM-dd'T'HH.mm.ss"))
    number = F.when(k % 13 == 0, F.lit("x")).otherwise(F.lit("")).cast("string")
    later = F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd HH:mm:ss")
    return read(spark, sf_dir, "orders").select(
        k.alias("k"), "o_totalprice", "o_orderpriority",
        F.concat(name, F.lit("_"), number, k, F.lit(".fit")).alias("export"),
        F.concat(F.lit("/in/"), k, F.lit("/"), at("yyyy-MM-dd-HH-mm-ss"), F.lit(".fit")).alias("watch"),
        at("yyyy-MM-dd HH:mm:ss").alias("at"), later.alias("later"),
    )


def _messages(files, name):
    """An activity message but for every seventh file, and two sessions."""
    text = lambda c: F.col(c).cast("string")
    pairs = lambda *p: F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in p])
    k = F.col("k")
    about = pairs(
        "timestamp", F.when(k % 3 != 0, F.col("at")), "num_sessions", (k % 3).cast("string"),
        "sport", F.lit(None).cast("string"), "start_time", F.lit(None).cast("string"),
        "total_distance", F.lit(None).cast("string"), "total_timer_time", F.lit(None).cast("string"),
    )

    def session(time, distance):
        return pairs(
            "timestamp", F.col("at"), "num_sessions", F.lit(None).cast("string"),
            "sport", F.when(k % 2 == 0, "lap_swimming"), "start_time", time, "total_distance", distance,
            "total_timer_time", F.when(k % 4 != 0, "60.5"),
        )

    one = lambda seq, kind, fields: F.struct(
        F.lit(seq).cast("bigint").alias("seq"), F.lit(kind).alias("name"), fields.alias("fields")
    )
    sessions = [one(1, "session", session(F.col("later"), text("k"))), one(2, "session", session(F.col("later"), F.lit("0.5")))]
    listed = F.when(k % 7 == 0, F.array(*sessions)).otherwise(F.array(one(0, "activity", about), *sessions))
    return files.select(F.col(name).alias("file"), F.explode(listed).alias("m")).select("file", "m.*")


def _stored(files):
    """Every fifth activity is stored already."""
    return files.where("k % 5 = 0").select(F.col("k").alias("activity_id"))


def _connect(spark, sf_dir):
    files = _files(spark, sf_dir)
    none = F.lit(None).cast("string")
    summaries = files.where("k % 2 = 0").select(
        F.regexp_replace("export", r"\.fit$", "").alias("pair"), F.col("export").alias("file"),
        F.col("o_totalprice").alias("adjusted_distance"), F.lit(1.5).alias("adjusted_duration"),
        none.cast("double").alias("workout_feel"), none.cast("double").alias("effort"),
        F.col("o_orderpriority").alias("category"), none.alias("activity_name"), none.alias("description"),
    )
    return plan_connect(_messages(files, "export"), summaries, _stored(files), _AFTER)


def connect_activities(spark, sf_dir):
    """New activities of exports, with their summaries and times filled in."""
    return _connect(spark, sf_dir).activities.select(
        "activity_id", F.unix_micros("timestamp").alias("us"), F.col("num_sessions").cast("int").alias("num_sessions"),
        "adjusted_distance", "category",
    )


def connect_rejected(spark, sf_dir):
    """Every file that is neither loaded, stored, nor older than the mark."""
    return _connect(spark, sf_dir).rejected.select("file", "reason")


def watch_activities(spark, sf_dir):
    """New activities of watch files: totals and names from their sessions, ids made."""
    files = _files(spark, sf_dir)
    stored = _stored(files.where("1 = 0"))
    plan = plan_watch(_messages(files, "watch"), None, stored, _AFTER, datetime(1999, 1, 1, tzinfo=timezone.utc))
    return plan.activities.select(
        "file", (F.col("activity_id") > 0).alias("has_id"), "activity_name", "adjusted_distance", "adjusted_duration",
        F.unix_micros("timestamp").alias("us"),
    )


_TIME = "CASE WHEN k % 3 = 0 THEN o_orderdate + INTERVAL 1 HOUR ELSE o_orderdate END"
_ORDERS = "(SELECT *, o_orderkey AS k FROM orders)"
_FILE = """CASE WHEN k % 11 = 0 THEN 'someday' ELSE strftime(o_orderdate, '%Y-%m-%dT%H.%M.%S') END || '_'
           || CASE WHEN k % 13 = 0 THEN 'x' ELSE '' END || k || '.fit'"""

QUERIES = {
    "connect_activities": (
        connect_activities,
        f"""SELECT k AS activity_id, epoch_us({_TIME}) AS us, CAST(k % 3 AS INTEGER) AS num_sessions,
                   CASE WHEN k % 2 = 0 THEN o_totalprice END AS adjusted_distance,
                   CASE WHEN k % 2 = 0 THEN o_orderpriority END AS category
            FROM {_ORDERS} WHERE o_orderdate > TIMESTAMP '1996-06-01'
                AND k % 5 <> 0 AND k % 7 <> 0 AND k % 11 <> 0 AND k % 13 <> 0""",
    ),
    "connect_rejected": (
        connect_rejected,
        f"""SELECT {_FILE} AS file,
                   CASE WHEN k % 11 = 0 THEN 'no time in the file name' WHEN k % 7 = 0 THEN 'no activity message'
                        ELSE 'activity_id' END AS reason
            FROM {_ORDERS}
            WHERE k % 11 = 0 OR (o_orderdate > TIMESTAMP '1996-06-01' AND (k % 7 = 0 OR k % 13 = 0))""",
    ),
    "watch_activities": (
        watch_activities,
        f"""SELECT '/in/' || k || '/' || strftime(o_orderdate, '%Y-%m-%d-%H-%M-%S') || '.fit' AS file, true AS has_id,
                   CASE WHEN k % 3 > 1 THEN 'Multisport' WHEN k % 2 = 0 THEN 'Lap_Swimming' ELSE 'Unknown' END AS activity_name,
                   k + 0.5::DOUBLE AS adjusted_distance,
                   CASE WHEN k % 4 <> 0 THEN 121.0::DOUBLE ELSE 0.0 END AS adjusted_duration, epoch_us({_TIME}) AS us
            FROM {_ORDERS} WHERE o_orderdate > TIMESTAMP '1996-06-01' AND o_orderdate <= TIMESTAMP '1999-01-01'
                AND k % 7 <> 0""",
    ),
}
