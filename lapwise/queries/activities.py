"""Activity-level derivations and reports: orders are activities, line items sessions."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lapwise.functions.values import default_name, degrees
from lapwise.operators.marks import high_water, high_water_date, newer_files
from lapwise.operators.places import nearest_place
from lapwise.operators.sports import (
    activities_over,
    activities_with_sport,
    activity_totals,
    classify_sport,
    fill_activity_time,
    longest_multi_session,
)
from lapwise.queries.tables import cents, micros, read

_CUTOFF = datetime(2024, 1, 15, 12)


def _orders(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("activity_id"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.col("o_totalprice").alias("adjusted_distance"),
        "o_orderstatus",
    )


def _sessions(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("activity_id"),
        F.col("l_returnflag").alias("sport"),
        F.col("l_quantity").alias("total_distance"),
        F.col("l_shipdate").cast("timestamp").alias("start_time"),
        cents("l_extendedprice").alias("total_timer_time"),
    )


def sport_class(spark, sf_dir):
    return classify_sport(_sessions(spark, sf_dir))


def with_sport(spark, sf_dir):
    return activities_with_sport(_orders(spark, sf_dir), _sessions(spark, sf_dir)).select("activity_id", "sport")


def running_over(spark, sf_dir):
    out = activities_over(_orders(spark, sf_dir), _sessions(spark, sf_dir), 9, "R")
    return out.select("activity_id", "adjusted_distance", F.unix_micros("timestamp").alias("us"), "sport")


def multi_session(spark, sf_dir):
    sessions = _sessions(spark, sf_dir)
    counted = sessions.groupBy("activity_id").agg(F.count(F.lit(1)).alias("num_sessions"))
    activities = _orders(spark, sf_dir).join(counted, "activity_id", "left")
    return longest_multi_session(activities, sessions).select(
        "activity_id", "adjusted_distance", "num_sessions", "total_distance", "sum_distance"
    )


def totals(spark, sf_dir):
    sessions = _sessions(spark, sf_dir).withColumn(
        "total_distance", F.when(F.col("sport") != "N", F.col("total_distance"))
    )
    return activity_totals(sessions)


def time_filled(spark, sf_dir):
    activities = _orders(spark, sf_dir).withColumn(
        "timestamp", F.when(F.col("o_orderstatus") != "F", F.col("timestamp"))
    )
    out = fill_activity_time(activities, _sessions(spark, sf_dir))
    return out.select("activity_id", F.unix_micros("timestamp").alias("us"))


def _stored(spark, sf_dir):
    return read(spark, sf_dir, "events").select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("timestamp"), F.col("ts").alias("wall")
    )


def marks(spark, sf_dir):
    """Per question one row: time before a cutoff, nothing that early, and the date form."""
    stored = _stored(spark, sf_dir)
    row = lambda name, df, value: df.select(F.lit(name).alias("question"), value.alias("mark"))
    day = F.unix_date("after").cast("long")
    return (
        row("cutoff", high_water(stored, _CUTOFF), F.unix_micros("after"))
        .unionByName(row("none", high_water(stored, datetime(1999, 1, 1)), F.unix_micros("after")))
        .unionByName(row("date", high_water_date(stored, _CUTOFF.date()), day))
        .unionByName(row("no_date", high_water_date(stored, datetime(1999, 1, 1).date()), day))
    )


def new_files(spark, sf_dir):
    """Events past the last purchase before the cutoff, and of these those of the ten days after it."""
    stored = _stored(spark, sf_dir)
    mark = high_water(stored.where("event_type = 'purchase'"), _CUTOFF)
    after = datetime(1970, 1, 1) + timedelta(microseconds=mark.select(F.unix_micros("after")).first()[0])
    time = F.col("timestamp")
    newer = newer_files(stored, time, after)
    until = newer_files(stored, time, after, datetime(2024, 1, 25), until_now=True)
    return newer.select("event_id", F.lit("newer").alias("rule")).unionByName(
        until.select("event_id", F.lit("until_now").alias("rule"))
    )


def semicircles(spark, sf_dir):
    turn = (F.col("c_custkey") * 1000003) % 2147483647
    out = read(spark, sf_dir, "customer").select("c_custkey", degrees(turn).alias("degrees"))
    return out.select("c_custkey", F.round(F.col("degrees") * 1e6).cast("long").alias("micro_degrees"))


def names(spark, sf_dir):
    """Customers name their sport and home; some have several sessions, some no city."""
    nations = read(spark, sf_dir, "nation")
    customers = read(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    sport = F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lower("c_mktsegment"), F.lit("_swimming")))
    city = F.when(F.col("c_custkey") % 3 == 0, F.lit("")).when(F.col("c_custkey") % 3 == 1, F.col("n_name"))
    county = F.when(F.col("c_custkey") % 7 != 0, F.concat(F.lit("county "), F.col("c_nationkey")))
    name = default_name(sport, F.col("c_custkey") % 4, city, county)
    return customers.select("c_custkey", name.alias("activity_name"))


def places(spark, sf_dir):
    """Customers start somewhere on a grid; suppliers are places."""
    starts = read(spark, sf_dir, "customer").select(
        "c_custkey",
        ((F.col("c_custkey") * 7919) % 2400 / 200.0 - 6).alias("start_position_lat"),
        ((F.col("c_custkey") * 104729) % 2400 / 200.0 - 6).alias("start_position_long"),
    )
    gazetteer = read(spark, sf_dir, "supplier").select(
        ((F.col("s_suppkey") * 6007) % 12000 / 1000.0 - 6).alias("latitude"),
        ((F.col("s_suppkey") * 9001) % 12000 / 1000.0 - 6).alias("longitude"),
        F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name")).alias("city"),
        F.when(F.col("s_suppkey") % 3 == 1, F.col("s_name")).alias("town"),
        F.lit(None).cast("string").alias("village"),
        F.concat(F.lit("county "), F.col("s_nationkey")).alias("county"),
    )
    return nearest_place(starts, gazetteer).select("c_custkey", "city", "county")


_NUM = "SELECT l_orderkey AS activity_id, count(*) AS num_sessions FROM lineitem GROUP BY 1"
_SPORT = """SELECT l_orderkey AS activity_id,
    CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'multi_sport' ELSE max(l_returnflag) END AS sport
    FROM lineitem GROUP BY 1"""

QUERIES = {
    "sport_class": (sport_class, _SPORT),
    "activity_sport": (
        with_sport,
        f"SELECT o_orderkey AS activity_id, sport FROM orders LEFT JOIN ({_SPORT}) s ON s.activity_id = o_orderkey",
    ),
    "running_over_distance": (
        running_over,
        f"""SELECT o_orderkey AS activity_id, o_totalprice AS adjusted_distance, epoch_us(o_orderdate) AS us, sport
            FROM orders LEFT JOIN ({_SPORT}) s ON s.activity_id = o_orderkey
            WHERE o_totalprice / 1609.335 > 9 AND sport = 'R' ORDER BY o_orderdate DESC""",
    ),
    "longest_multi_session": (
        multi_session,
        f"""SELECT activity_id, o_totalprice AS adjusted_distance, num_sessions, l_quantity AS total_distance,
                   sum(l_quantity) AS sum_distance
            FROM orders JOIN ({_NUM}) n ON n.activity_id = o_orderkey JOIN lineitem ON l_orderkey = o_orderkey
            WHERE num_sessions > 1 GROUP BY activity_id, o_totalprice, num_sessions, l_quantity
            ORDER BY o_totalprice DESC, sum_distance DESC""",
    ),
    "activity_totals": (
        totals,
        """SELECT l_orderkey AS activity_id,
                  coalesce(sum(CASE WHEN l_returnflag <> 'N' THEN l_quantity END), 0.0) AS adjusted_distance,
                  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) AS adjusted_duration
           FROM lineitem GROUP BY 1""",
    ),
    "timestamp_fallback": (
        time_filled,
        """SELECT o_orderkey AS activity_id,
                  epoch_us(coalesce(CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END,
                      (SELECT min(l_shipdate) FROM lineitem WHERE l_orderkey = o_orderkey))) AS us
           FROM orders""",
    ),
    "high_water": (
        marks,
        """SELECT 'cutoff' AS question, epoch_us(max(ts)) AS mark FROM events WHERE ts < TIMESTAMP '2024-01-15 12:00:00'
           UNION ALL SELECT 'none', epoch_us(coalesce(max(ts), TIMESTAMP '1900-01-01 12:00:00'))
                     FROM events WHERE ts < TIMESTAMP '1999-01-01'
           UNION ALL SELECT 'date', CAST(date_diff('day', DATE '1970-01-01', max(CAST(ts AS DATE))) AS BIGINT)
                     FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-15'
           UNION ALL SELECT 'no_date', CAST(date_diff('day', DATE '1970-01-01', max(CAST(ts AS DATE))) AS BIGINT)
                     FROM events WHERE CAST(ts AS DATE) <= DATE '1999-01-01'""",
    ),
    "incremental_filter": (
        new_files,
        """WITH m AS (SELECT max(ts) AS after FROM events
                      WHERE event_type = 'purchase' AND ts < TIMESTAMP '2024-01-15 12:00:00')
           SELECT event_id, 'newer' AS rule FROM events, m WHERE ts > after
           UNION ALL
           SELECT event_id, 'until_now' FROM events, m WHERE ts > after AND ts <= TIMESTAMP '2024-01-25'""",
    ),
    "semicircles": (
        semicircles,
        """SELECT c_custkey,
                  CAST(round(((c_custkey * 1000003) % 2147483647)::DOUBLE / (4294967296.0::DOUBLE / 360) * 1e6) AS BIGINT)
                      AS micro_degrees
           FROM customer""",
    ),
    "default_name": (
        names,
        """SELECT c_custkey, concat_ws(' ',
               coalesce(CASE WHEN c_custkey % 3 = 1 THEN n_name END,
                        CASE WHEN c_custkey % 7 <> 0 THEN 'county ' || c_nationkey END),
               CASE WHEN c_custkey % 4 > 1 THEN 'Multisport' WHEN c_custkey % 5 = 0 THEN 'Unknown'
                    ELSE upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || '_Swimming' END) AS activity_name
           FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    ),
    "nearest_place": (
        places,
        """WITH starts AS (
               SELECT c_custkey, (c_custkey * 7919) % 2400 / 200.0::DOUBLE - 6 AS slat,
                      (c_custkey * 104729) % 2400 / 200.0::DOUBLE - 6 AS slon
               FROM customer
           ),
           places AS (
               SELECT (s_suppkey * 6007) % 12000 / 1000.0::DOUBLE - 6 AS lat,
                      (s_suppkey * 9001) % 12000 / 1000.0::DOUBLE - 6 AS lon,
                      CASE WHEN s_suppkey % 3 < 2 THEN s_name END AS city, 'county ' || s_nationkey AS county
               FROM supplier
           )
           SELECT c_custkey, city, county FROM starts CROSS JOIN places
           QUALIFY row_number() OVER (
               PARTITION BY c_custkey
               ORDER BY round(2 * 6371.0088 * asin(sqrt(
                   pow(sin((radians(lat) - radians(slat)) / 2), 2)
                   + cos(radians(slat)) * cos(radians(lat)) * pow(sin((radians(lon) - radians(slon)) / 2), 2))), 6),
                   coalesce(city, ''), county) = 1""",
    ),
}
