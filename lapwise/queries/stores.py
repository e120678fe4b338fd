"""Loads into stored tables: new rows, parents, contracts, updates, ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapwise.functions.names import made_id
from lapwise.operators.skew import deal, dealing
from lapwise.plans.ingest import fill_created
from lapwise.queries.tables import LINE_ORDER, cents, micros, prop, read
from lapwise.sinks.contract import conform, with_raw
from lapwise.sinks.load import backfill_power, insert_if_absent, update_pool, with_parent, without_parent
from lapwise.sources.messages import filled_fields, message_rows


def inserts(spark, sf_dir):
    new = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("activity_id"), *LINE_ORDER
    )
    stored = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("activity_id"))
    return insert_if_absent(new, stored, LINE_ORDER)


def _children(spark, sf_dir):
    children = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("activity_id"), "l_linenumber", "l_partkey")
    parents = read(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    return children, parents.select(F.col("o_orderkey").alias("activity_id"))


def kept_children(spark, sf_dir):
    return with_parent(*_children(spark, sf_dir))


def orphans(spark, sf_dir):
    return without_parent(*_children(spark, sf_dir))


def orphans_sliced(spark, sf_dir):
    """Orders of four lines and more taken for hot groups."""
    return without_parent(*_children(spark, sf_dir), min_rows=3)


def pool(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    sub_sport = F.when(F.col("l_returnflag") == "A", "lap_swimming").otherwise(F.col("l_returnflag"))
    sessions = lines.select(
        F.col("l_orderkey").alias("activity_id"), "l_linenumber", "l_partkey", sub_sport.alias("sub_sport"),
        F.col("l_quantity").alias("pool_length"), F.lit("yard").alias("pool_length_unit"),
    )
    updates = lines.where("l_linestatus = 'O'").select(
        F.col("l_orderkey").alias("activity_id"), sub_sport.alias("sub_sport"), *LINE_ORDER,
        F.when(F.col("l_linenumber") != 2, F.col("l_extendedprice") / 1000).alias("pool_length"),
        F.when(F.col("l_linenumber") != 3, "metric").alias("pool_length_unit"),
    )
    return update_pool(sessions, updates, LINE_ORDER)


def power(spark, sf_dir):
    lines, keys = read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    # Laps and decoded laps are both of these lines, which are counted once for them.
    limit, tasks = dealing(lines, keys, sides=2)
    numbered = deal(lines, keys, tasks).groupBy(F.col("l_orderkey").alias("activity_id"), F.col("l_linenumber").alias("number"))
    laps = numbered.agg(
        F.max(F.when(F.col("l_returnflag") == "A", F.col("l_suppkey"))).alias("avg_power"),
        F.max("l_suppkey").alias("max_power"),
        F.lit(None).cast("bigint").alias("normalized_power"),
    )
    decoded = lines.where("l_linestatus = 'F'").select(
        F.col("l_orderkey").alias("activity_id"), F.col("l_linenumber").alias("number"), "l_partkey", "l_suppkey",
        "l_extendedprice", F.col("l_partkey").alias("avg_power"), F.lit(7).cast("bigint").alias("max_power"),
        F.col("l_suppkey").alias("normalized_power"),
    )
    return backfill_power(laps, decoded, ["l_partkey", "l_suppkey", "l_extendedprice"], min_rows=limit, tasks=tasks)


def messages(spark, sf_dir):
    """Events as decoded messages; the kind of event is the kind of message."""
    events = read(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", micros("ts").alias("us"), cents("value").alias("d"), prop("k").alias("k")
    )
    text = lambda c: F.col(c).cast("string")
    semis = (F.col("event_id") * 1000003 % 2147483647).cast("string")
    east = [F.lit("position_long"), semis]
    rest = [
        F.lit("position_lat"), F.when(F.col("k") != 5, semis),
        F.lit("distance"), text("d"),
        F.lit("heart_rate"), F.when(F.col("k") % 4 == 0, "nan").otherwise(text("k")),
        F.lit("total_distance"), text("d"),
        F.lit("sport"), F.lit("running"),
        F.lit("timestamp"), text("us"),
        F.lit("length_type"), F.when(F.col("k") % 2 == 0, "active").otherwise("idle"),
        F.lit("serial_number"), F.when(F.col("k") % 5 != 0, text("event_id")),
        F.lit("event_type"), F.lit("start"),
    ]
    fields = F.when(F.col("k") % 10 != 3, F.create_map(*rest, *east)).otherwise(F.create_map(*rest))
    kinds = {"view": "record", "click": "lap", "signup": "session", "error": "length"}
    kind = F.lit("other")
    for n, name in enumerate(["activity", "file_id", "event"]):
        kind = F.when((F.col("event_type") == "purchase") & (F.col("k") % 3 == n), name).otherwise(kind)
    for event_type, name in kinds.items():
        kind = F.when(F.col("event_type") == event_type, name).otherwise(kind)
    return events.select(
        F.col("user_id").cast("string").alias("file"), F.col("event_id").alias("seq"), kind.alias("name"),
        fields.alias("fields"),
    )


def routed(spark, sf_dir):
    """Rows and filled fields per table; purchases are spread over three kinds of message."""
    return filled_fields(messages(spark, sf_dir))


def records(spark, sf_dir):
    rows = message_rows(messages(spark, sf_dir), "record")
    degrees = lambda c: F.round(F.col(c).try_cast("double") * 1e6).cast("bigint").alias(c)
    return rows.select(
        "file", "seq", degrees("latitude"), degrees("longitude"), F.col("distance").cast("bigint").alias("distance"),
        F.col("heart_rate").cast("int").alias("heart_rate"),
    )


def _raw_lengths(spark, sf_dir):
    """Events as decoded swim lengths, some of which do not fit."""
    events = read(spark, sf_dir, "events")
    return events.select(
        F.when(prop("k") != 0, F.col("event_id")).alias("activity_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.when(prop("k") % 10 == 1, "no time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("start_time"),
        prop("k").cast("string").alias("message_index"),
        F.when(prop("k") % 10 == 2, "NaN").otherwise(F.col("value").cast("string")).alias("total_timer_time"),
        F.concat((prop("k") * 1000).cast("string"), F.lit(".5")).alias("total_strokes"),
        F.when(prop("k") % 10 == 4, "a stroke nobody has named yet").otherwise("freestyle").alias("swim_stroke"),
    )


def conformed(spark, sf_dir):
    """All rows in the table's types; what does not fit is null."""
    out = conform(_raw_lengths(spark, sf_dir), "length")
    return out.select(
        "activity_id", F.unix_micros("timestamp").alias("us"), F.unix_micros("start_time").alias("start_us"),
        F.col("message_index").cast("int").alias("message_index"), "total_timer_time",
        F.col("total_strokes").cast("int").alias("total_strokes"), "avg_speed", "swim_stroke", "length_type",
    )


def set_aside(spark, sf_dir):
    """Rows per set of columns that do not fit."""
    tested = with_raw(_raw_lengths(spark, sf_dir), "length")
    why = F.when(F.col("reasons") == "", "fits").otherwise(F.col("reasons"))
    return tested.groupBy(why.alias("why")).agg(F.count(F.lit(1)).alias("n"))


def made_ids(spark, sf_dir):
    """One positive id per path, another in another folder."""
    files = read(spark, sf_dir, "events").select(F.concat(F.date_format("ts", "yyyy-MM-dd-HH-mm-ss"), F.lit("-"), "event_id", F.lit(".fit")).alias("file"))
    ids = files.select("file", made_id(F.col("file")).alias("id"), made_id(F.concat(F.lit("/in/"), "file")).alias("other"))
    return ids.agg(
        F.count_distinct("file").alias("files"), F.count_distinct("id").alias("ids"),
        F.count(F.when((F.col("id") < 0) | (F.col("id") == F.col("other")), 1)).alias("wrong"),
    )


def created(spark, sf_dir):
    """Creation times of the first click of a user fall back to the first purchase."""
    events = read(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("file"), F.col("event_id").alias("seq"), "event_type", prop("k").alias("k"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text"),
    )
    ids = events.where("event_type = 'click'").select(
        "file", "seq", F.when(F.col("k") % 2 == 0, F.col("text")).otherwise("never").alias("time_created")
    )
    activities = events.where("event_type = 'purchase'").select("file", "seq", F.col("text").alias("timestamp"))
    return fill_created(ids, activities).select("file", "seq", F.unix_micros("time_created").alias("created_us"))


_LINES = "l_linenumber, l_partkey, l_suppkey, l_extendedprice"
_EVENTS = "SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"
_SUB = "CASE WHEN l_returnflag = 'A' THEN 'lap_swimming' ELSE l_returnflag END"
_MICRO = "CAST(round(semis::DOUBLE / (4294967296.0::DOUBLE / 360) * 1e6) AS BIGINT)"
_TIME = "date_trunc('second', ts)"
_FITS = """
    SELECT *, k * 1000 + 1 AS strokes, concat_ws(',',
        CASE WHEN k % 10 = 1 THEN 'start_time' END,
        CASE WHEN k * 1000 + 1 > 32767 THEN 'total_strokes' END,
        CASE WHEN k % 10 = 4 THEN 'swim_stroke' END,
        CASE WHEN k = 0 THEN 'activity_id' END) AS why
"""

QUERIES = {
    "insert_if_absent": (
        inserts,
        f"""SELECT l_orderkey AS activity_id, {_LINES} FROM (
                SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINES}) AS nth FROM lineitem
            ) WHERE nth = 1 AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    ),
    "fk_kept": (
        kept_children,
        """SELECT l_orderkey AS activity_id, l_linenumber, l_partkey FROM lineitem
           WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""",
    ),
    "fk_missing": (
        orphans,
        """SELECT l_orderkey AS activity_id, l_linenumber, l_partkey FROM lineitem
           WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""",
    ),
    "fk_missing_sliced": (
        orphans_sliced,
        """SELECT l_orderkey AS activity_id, l_linenumber, l_partkey FROM lineitem
           WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""",
    ),
    "pool_update": (
        pool,
        f"""WITH u AS (
                SELECT l_orderkey, {_SUB} AS sub_sport,
                       CASE WHEN l_linenumber <> 2 THEN l_extendedprice / 1000 END AS len,
                       CASE WHEN l_linenumber <> 3 THEN 'metric' END AS unit,
                       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC,
                           l_suppkey DESC, l_extendedprice DESC) AS nth
                FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag = 'A'
            ),
            s AS (SELECT l_orderkey, l_linenumber, l_partkey, {_SUB} AS sub_sport, l_quantity FROM lineitem)
            SELECT s.l_orderkey AS activity_id, l_linenumber, l_partkey, s.sub_sport,
                   CASE WHEN nth IS NULL THEN l_quantity ELSE trunc(coalesce(len, 0)) END AS pool_length,
                   coalesce(unit, 'yard') AS pool_length_unit
            FROM s LEFT JOIN u ON u.l_orderkey = s.l_orderkey AND u.sub_sport = s.sub_sport AND nth = 1""",
    ),
    "power_backfill": (
        power,
        """WITH laps AS (
               SELECT l_orderkey, l_linenumber, max(CASE WHEN l_returnflag = 'A' THEN l_suppkey END) AS avg_power,
                      max(l_suppkey) AS max_power
               FROM lineitem GROUP BY 1, 2
           ),
           d AS (
               SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                   ORDER BY l_partkey, l_suppkey, l_extendedprice) AS nth
               FROM lineitem WHERE l_linestatus = 'F'
           )
           SELECT laps.l_orderkey AS activity_id, laps.l_linenumber AS number,
                  coalesce(avg_power, l_partkey) AS avg_power, max_power, l_suppkey AS normalized_power
           FROM laps LEFT JOIN d ON d.l_orderkey = laps.l_orderkey AND d.l_linenumber = laps.l_linenumber AND nth = 1""",
    ),
    "message_router": (
        routed,
        f"""SELECT 'activity' AS table_name, count(*) AS n, 2 * count(*) AS filled
                FROM ({_EVENTS}) WHERE event_type = 'purchase' AND k % 3 = 0
            UNION ALL SELECT 'file_id', count(*), count(*) FILTER (k % 5 <> 0)
                FROM ({_EVENTS}) WHERE event_type = 'purchase' AND k % 3 = 1
            UNION ALL SELECT 'event', count(*), 2 * count(*) FROM ({_EVENTS}) WHERE event_type = 'purchase' AND k % 3 = 2
            UNION ALL SELECT 'lap', count(*), count(*) FROM events WHERE event_type = 'click'
            UNION ALL SELECT 'session', count(*), 4 * count(*) FROM events WHERE event_type = 'signup'
            UNION ALL SELECT 'length', count(*), 2 * count(*) FROM events WHERE event_type = 'error'
            UNION ALL SELECT 'record', count(*), CAST(sum(CASE WHEN k = 5 THEN 3 ELSE 4 END
                                                         + CASE WHEN k % 4 <> 0 THEN 1 ELSE 0 END) AS BIGINT)
                      FROM ({_EVENTS}) WHERE event_type = 'view' AND k % 10 <> 3""",
    ),
    "record_rows": (
        records,
        f"""SELECT CAST(user_id AS VARCHAR) AS file, event_id AS seq, CASE WHEN k <> 5 THEN {_MICRO} END AS latitude,
                   {_MICRO} AS longitude, CAST(round(value * 100) AS BIGINT) AS distance,
                   CASE WHEN k % 4 <> 0 THEN k END AS heart_rate
            FROM (SELECT *, event_id * 1000003 % 2147483647 AS semis FROM ({_EVENTS}))
            WHERE event_type = 'view' AND k % 10 <> 3""",
    ),
    "conform_cast": (
        conformed,
        f"""SELECT CASE WHEN k <> 0 THEN event_id END AS activity_id, epoch_us({_TIME}) AS us,
                   CASE WHEN k % 10 <> 1 THEN epoch_us({_TIME}) END AS start_us, k AS message_index,
                   CASE WHEN k % 10 <> 2 THEN value END AS total_timer_time,
                   CASE WHEN strokes <= 32767 THEN CAST(strokes AS INTEGER) END AS total_strokes,
                   CAST(NULL AS DOUBLE) AS avg_speed,
                   CASE WHEN k % 10 = 4 THEN 'a stroke nobody has named yet' ELSE 'freestyle' END AS swim_stroke,
                   CAST(NULL AS VARCHAR) AS length_type
            FROM ({_FITS} FROM ({_EVENTS}))""",
    ),
    "quarantine": (
        set_aside,
        f"""SELECT CASE WHEN why = '' THEN 'fits' ELSE why END AS why, count(*) AS n
            FROM ({_FITS} FROM ({_EVENTS})) GROUP BY 1""",
    ),
    "made_ids": (
        made_ids,
        "SELECT count(DISTINCT f) AS files, count(DISTINCT f) AS ids, CAST(0 AS BIGINT) AS wrong "
        "FROM (SELECT strftime(ts, '%Y-%m-%d-%H-%M-%S') || '-' || event_id AS f FROM events)",
    ),
    "created_fallback": (
        created,
        f"""WITH e AS (SELECT *, {_TIME} AS t FROM ({_EVENTS})),
            clicks AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nth
                       FROM e WHERE event_type = 'click'),
            buys AS (SELECT user_id, arg_min(t, event_id) AS t FROM e WHERE event_type = 'purchase' GROUP BY 1)
            SELECT CAST(clicks.user_id AS VARCHAR) AS file, event_id AS seq,
                   epoch_us(CASE WHEN k % 2 = 0 THEN clicks.t WHEN nth = 1 THEN buys.t END) AS created_us
            FROM clicks LEFT JOIN buys USING (user_id)""",
    ),
}
