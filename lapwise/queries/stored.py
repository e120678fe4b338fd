"""Whole loads: messages made from ``orders`` and ``lineitem``, stored in a folder of their own and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.functions import names
from lapwise.operators.efforts import fastest_effort
from lapwise.operators.numbering import number_as_sorted
from lapwise.operators.skew import measured, tasks_for
from lapwise.operators.sports import activities_over, longest_multi_session
from lapwise.plans.ingest import derive, load_connect
from lapwise.plans.reports import by_start
from lapwise.queries.efforts import NAMES, tracks
from lapwise.queries.tables import LINE_ORDER, read
from lapwise.schemas import MESSAGES
from lapwise.session import scratch
from lapwise.sinks.contract import conform
from lapwise.sinks.load import serial_ids, with_parent
from lapwise.sources.messages import kept_by_name, write_messages
from lapwise.sources.sidecar import PATHS
from lapwise.sources.tables import LOAD, Store, list_files
from lapwise.streaming.incremental import follow, message_stream

_SPLIT = "1996-01-01"


def _map(**fields) -> Column:
    pairs = [x for name, value in fields.items() for x in (F.lit(name), (F.col(value) if isinstance(value, str) else value).cast("string"))]
    return F.create_map(*pairs)


def _name(key: str, time: str) -> Column:
    return F.concat(F.date_format(time, "yyyy-MM-dd'T'HH.mm.ss"), F.lit("_"), key, F.lit(".fit"))


def order_messages(spark, sf_dir, lines: bool = True) -> DataFrame:
    """An order is a file with two workout steps, a lap and a point per line, a session and an activity message.

    Laps of even orders name their workout step.
    """
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_orderdate", _name("o_orderkey", "o_orderdate").alias("file"))
    at = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    none = F.lit(None).cast("string")

    def rows(df, seq, name, fields):
        return df.select("file", F.lit(seq).cast("bigint").alias("seq") if isinstance(seq, int) else seq.alias("seq"), F.lit(name).alias("name"), fields.alias("fields"))

    out = [
        rows(orders, 9_000_001, "session", _map(start_time=at, sport=F.lit("running"), total_distance=F.col("k"))),
        rows(orders.where("k % 7 <> 0"), 9_000_002, "activity", _map(timestamp=F.when(F.col("k") % 3 != 0, at), num_sessions=F.lit(1))),
    ]
    if lines:
        nth = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)).cast("bigint")
        each = read(spark, sf_dir, "lineitem").withColumn("nth", nth).join(orders, F.col("l_orderkey") == F.col("k"))
        lap = _map(total_distance=F.col("l_quantity"), max_power=F.col("nth"))
        stepped = F.map_concat(lap, _map(wkt_step_index=(F.col("nth") - 1) % 2))
        point = _map(distance=F.col("l_partkey") % 200, position_lat=none, position_long=F.col("nth"), heart_rate=F.col("nth"))
        # Both messages of a line in one pass over the lines.
        both = F.array(
            F.struct((F.col("nth") + 10).alias("seq"), F.lit("lap").alias("name"), F.when(F.col("k") % 2 == 0, stepped).otherwise(lap).alias("fields")),
            F.struct((F.col("nth") + 1_000_000).alias("seq"), F.lit("record").alias("name"), point.alias("fields")),
        )
        out += [
            rows(orders, n, "workout_step", _map(intensity=F.lit(what))) for n, what in enumerate(("warmup", "active"))
        ] + [each.select("file", F.inline(both))]
    all_ = out[0]
    for df in out[1:]:
        all_ = all_.unionByName(df)
    return all_


def no_summaries(spark) -> DataFrame:
    numbers = {"adjusted_distance", "adjusted_duration", "workout_feel", "effort"}
    kinds = [f"{n} {'double' if n in numbers else 'string'}" for n in PATHS.values()]
    return spark.createDataFrame([], ", ".join(["file string", "pair string", *kinds]))


def load_ledger(spark, sf_dir):
    """Early files, then all, then the early ones again: what the ledger says."""
    store = Store(spark, scratch(spark, "ledger"))
    messages = order_messages(spark, sf_dir, lines=False)
    early = messages.where(F.col("file") < _SPLIT)
    for load_id, files in (("early", early), ("late", messages), ("early", early)):
        load_connect(store, files, no_summaries(spark), load_id)
    return store.ledger().select(
        LOAD, "source", F.unix_micros("mark").alias("mark_us"), F.unix_micros("newest").alias("newest_us"),
        F.col("counts")["activity"].alias("activities"), F.col("counts")["session"].alias("sessions"),
    )


def stream_activities(spark, sf_dir):
    """The activities a stream has stored."""
    source = scratch(spark, "messages")
    order_messages(spark, sf_dir, lines=False).write.parquet(source)
    store = Store(spark, scratch(spark, "store"))
    none = no_summaries(spark)
    follow(message_stream(spark, source), store, scratch(spark, "progress"), lambda since: none).awaitTermination()
    return store.read("activity").select("activity_id", F.unix_micros("timestamp").alias("us"))


def _children(spark, sf_dir, table):
    # Made once: every step below reads them again.
    messages = kept_by_name(order_messages(spark, sf_dir), scratch(spark, "messages"))
    stored = messages.where("name = 'activity'").select("file")
    # Counted once: files have no more messages left where those without an activity are gone.
    limit = measured(messages, ["file"])
    mine = with_parent(messages, stored, key="file", min_rows=limit)
    rows = derive(mine, names.activity_id(F.col("file")), limit)[table]
    return conform(rows, table)


def connect_laps(spark, sf_dir):
    """Laps of a load: numbered in file order, with their workout's intensity, under their activity's id."""
    return _children(spark, sf_dir, "lap").select(
        "activity_id", F.col("number").cast("int").alias("number"), "total_distance", "intensity",
        F.col("max_power").cast("int").alias("max_power"),
    )


def connect_records(spark, sf_dir):
    """Points of a load with the lap their distance falls in."""
    return _children(spark, sf_dir, "record").select(
        "activity_id", F.col("heart_rate").cast("int").alias("nth"), "distance", F.col("lap").cast("int").alias("lap")
    )


def serial(spark, sf_dir):
    """Ids without a gap for orders that have none yet, after those in use."""
    orders = read(spark, sf_dir, "orders")
    used = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("activity_id"))
    new = orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderdate")
    return serial_ids(new, used, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "activity_id")


def local_times(spark, sf_dir):
    """Local times keep what the clock showed; their zone is dropped."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 1, "+02:00").otherwise("Z"))
    rows = read(spark, sf_dir, "events").select(
        F.col("event_id").alias("activity_id"), F.when(F.col("event_id") % 7 == 0, "at noon").otherwise(text).alias("local_timestamp")
    )
    return conform(rows, "activity").select("activity_id", F.date_format("local_timestamp", "yyyy-MM-dd HH:mm:ss").alias("local_time"))


def report_orders(spark, sf_dir):
    """Rows of the sorted reports, numbered as they come."""
    orders = read(spark, sf_dir, "orders")
    activities = orders.select(
        F.col("o_orderkey").alias("activity_id"), F.lit(2).alias("num_sessions"),
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice")).alias("adjusted_distance"),
        F.when(F.col("o_orderkey") % 8 != 0, F.col("o_orderdate")).alias("timestamp"),
    )
    sessions = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("activity_id"), F.lit("running").alias("sport"), F.col("l_quantity").alias("total_distance")
    )
    points, limit = tracks(spark, sf_dir)
    efforts = by_start(fastest_effort(points, 20000, min_rows=limit, **NAMES), "user_id")
    number = lambda c: F.col(c).cast("double")
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    reports = {
        "longest": (longest_multi_session(activities, sessions), number("adjusted_distance"), number("sum_distance")),
        "newest": (activities_over(activities, sessions), us("timestamp"), number("activity_id")),
        "efforts": (efforts, us("start_time"), number("user_id")),
    }
    out = None
    for name, (df, first, second) in reports.items():
        rows = number_as_sorted(df, "place").select(F.lit(name).alias("report"), "place", first.alias("first"), second.alias("second"))
        out = rows if out is None else out.unionByName(rows)
    return out


def listed_folders(spark, sf_dir):
    """Messages stored by day, here the first of their month, and name: the folders found by listing their files."""
    path = scratch(spark, "listed")
    files = read(spark, sf_dir, "events").select(
        F.date_format(F.date_trunc("month", "ts"), "yyyy-MM-dd").alias("file"), F.col("event_id").alias("seq"),
        F.col("event_type").alias("name"), F.create_map(F.lit("k"), F.col("props")).alias("fields"),
    )
    tasks = tasks_for(spark, files.count()) or 2
    # All rows of a month may be the whole table: dealt by row, so that no task sorts more than its share.
    write_messages(files.select(*MESSAGES.names).repartition(tasks, "file", "seq"), path, F.to_date("file"))
    found = list_files(spark, path, "*.parquet")
    part = lambda key: F.regexp_extract("file_path", f"{key}=([^/]+)/", 1)
    return found.select(part("day").alias("day"), part("name").alias("name")).distinct()


_NTH = "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)"
_TRACKS = """SELECT user_id, epoch_us(ts) AS us,
    CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS d FROM events"""
_LAPS = f"""SELECT l_orderkey AS k, {_NTH} AS nth, l_quantity, l_partkey,
    sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice
        ROWS UNBOUNDED PRECEDING) AS lap_end
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_orderkey % 7 <> 0"""

QUERIES = {
    "load_ledger": (
        load_ledger,
        f"""WITH o AS (
                SELECT epoch_us(o_orderdate) AS us, o_orderdate < TIMESTAMP '{_SPLIT}' AS early FROM orders WHERE o_orderkey % 7 <> 0
            ),
            e AS (SELECT max(us) AS us FROM o WHERE early)
            SELECT 'early' AS load_id, 'connect' AS source, epoch_us(TIMESTAMP '1900-01-01 12:00:00') AS mark_us, max(us) AS newest_us,
                   count(*) AS activities, count(*) AS sessions FROM o WHERE early
            UNION ALL SELECT 'late', 'connect', any_value(e.us), max(o.us), count(*), count(*) FROM o, e WHERE o.us > e.us""",
    ),
    "stream_activities": (
        stream_activities,
        "SELECT o_orderkey AS activity_id, epoch_us(o_orderdate) AS us FROM orders WHERE o_orderkey % 7 <> 0",
    ),
    "connect_laps": (
        connect_laps,
        f"""SELECT k AS activity_id, CAST(nth AS INTEGER) AS number, l_quantity AS total_distance,
                   CASE WHEN k % 2 = 0 THEN CASE WHEN nth % 2 = 1 THEN 'warmup' ELSE 'active' END END AS intensity,
                   CAST(nth AS INTEGER) AS max_power
            FROM ({_LAPS})""",
    ),
    "connect_records": (
        connect_records,
        f"""WITH l AS ({_LAPS})
            SELECT p.k AS activity_id, CAST(p.nth AS INTEGER) AS nth, CAST(p.l_partkey % 200 AS DOUBLE) AS distance,
                   CAST(1 + (SELECT count(*) FROM l WHERE l.k = p.k AND l.lap_end < p.l_partkey % 200) AS INTEGER) AS lap
            FROM l p""",
    ),
    "serial_ids": (
        serial,
        """SELECT o_orderkey, (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'F')
                  + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS activity_id
           FROM orders WHERE o_orderstatus <> 'F'""",
    ),
    "local_times": (
        local_times,
        """SELECT event_id AS activity_id, CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS local_time
           FROM events""",
    ),
    "report_orders": (
        report_orders,
        f"""WITH a AS (
                SELECT o_orderkey AS k, CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END AS d,
                       CASE WHEN o_orderkey % 8 <> 0 THEN o_orderdate END AS t FROM orders
            ),
            s AS (SELECT l_orderkey AS k, l_quantity, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2),
            p AS ({_TRACKS}),
            pairs AS (SELECT a.user_id, a.us - b.us AS dur, b.us FROM p a JOIN p b ON a.user_id = b.user_id AND a.us > b.us AND a.d - b.d >= 20000),
            best AS (SELECT DISTINCT user_id, us FROM pairs QUALIFY dur = min(dur) OVER (PARTITION BY user_id))
            SELECT 'longest' AS report, row_number() OVER (ORDER BY d DESC NULLS FIRST, q DESC NULLS FIRST, k) AS place, d AS first, q AS second
            FROM a JOIN s USING (k)
            UNION ALL SELECT 'newest', row_number() OVER (ORDER BY t DESC NULLS FIRST, k), epoch_us(t)::DOUBLE, k::DOUBLE
            FROM a WHERE d / 1609.335 > 9 AND k IN (SELECT k FROM s)
            UNION ALL SELECT 'efforts', row_number() OVER (ORDER BY us, user_id), us::DOUBLE, user_id::DOUBLE FROM best""",
    ),
    "listed_folders": (
        listed_folders,
        "SELECT DISTINCT strftime(date_trunc('month', ts), '%Y-%m-%d') AS day, event_type AS name FROM events",
    ),
}
