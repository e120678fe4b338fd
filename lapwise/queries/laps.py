"""Lap numbers, swim lengths and workout intensities."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapwise.operators.intensity import align_intensity, distinct_in_order
from lapwise.operators.laps import assign_laps, first_row, lap_bounds, number_in_order, renumber_lengths
from lapwise.operators.skew import measured, running
from lapwise.queries.tables import LINE_ORDER, micros, prop, read

_LINES = "l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def _laps(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_orderkey").alias("o_orderkey"), *LINE_ORDER, F.col("l_quantity").alias("total_distance"))


def lap_assign(spark, sf_dir):
    """15 points per order; the last has no distance."""
    points = read(spark, sf_dir, "orders").select("o_orderkey", F.explode(F.sequence(F.lit(0), F.lit(14))).alias("k"))
    points = points.withColumn("distance", F.when(F.col("k") < 14, F.col("k") * 20.0 + F.col("o_orderkey") % 7))
    out = assign_laps(points, _laps(spark, sf_dir), key="o_orderkey", lap_order=LINE_ORDER)
    return out.select("o_orderkey", "k", "lap")


def lap_ends(spark, sf_dir):
    out = lap_bounds(_laps(spark, sf_dir), "o_orderkey", LINE_ORDER)
    return out.select("o_orderkey", "l_linenumber", "l_partkey", "lap_end")


def lap_number(spark, sf_dir):
    out = number_in_order(_laps(spark, sf_dir), "o_orderkey", LINE_ORDER)
    return out.select("o_orderkey", "l_linenumber", "l_partkey", "number")


def first_rows(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", micros("ts").alias("us"))
    return first_row(events, ["user_id"], ["us", "event_id"]).select("user_id", "event_id", "event_type", "us")


def _numbered_events(spark, sf_dir, min_rows=None):
    """Events numbered per user; and the row limit, counted once."""
    events = read(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", micros("ts").alias("us"), prop("k").alias("k")
    )
    limit = measured(events, ["user_id"], min_rows)
    return running(events, ["user_id"], ["us", "event_id"], {"seq": ("count", F.lit(1))}, min_rows=limit), limit


def _lengths(spark, sf_dir, min_rows=None):
    kind = (
        F.when(F.col("event_type").isin("click", "view"), "active").when(F.col("event_type") != "signup", "idle")
    )
    events, limit = _numbered_events(spark, sf_dir, min_rows)
    lengths = events.withColumns({"message_index": F.col("seq") - 1, "length_type": kind})
    return renumber_lengths(lengths, "user_id", ["seq"], limit).select("user_id", "event_id", "message_index")


def length_renumber(spark, sf_dir):
    return _lengths(spark, sf_dir)


def length_renumber_sliced(spark, sf_dir):
    """Every user taken for a hot group."""
    return _lengths(spark, sf_dir, 20)


def intensity_align(spark, sf_dir):
    """Clicks with small ``k`` carry an intensity; purchases are laps and carry a step number."""
    events, limit = _numbered_events(spark, sf_dir)
    word = F.element_at(F.array(*[F.lit(w) for w in ("warmup", "active", "rest", "cooldown")]), F.col("k") % 4 + 1)
    messages = events.select(
        "user_id", "seq",
        ((F.col("event_type") == "click") & (F.col("k") < 25)).alias("has_intensity"),
        F.when(F.col("k") % 10 != 9, word).alias("intensity"),
        (F.col("event_type") == "purchase").alias("has_step"),
        F.when(F.col("k") % 7 != 0, F.col("k") % 3).cast("long").alias("step"),
    )
    purchases = events.where("event_type = 'purchase'").select("user_id", "event_id", "seq")
    laps = number_in_order(purchases, "user_id", ["seq"], min_rows=limit)
    return align_intensity(messages, laps, key="user_id", min_rows=limit).select("user_id", "event_id", "number", "intensity")


def distinct_types(spark, sf_dir):
    events, limit = _numbered_events(spark, sf_dir)
    out = distinct_in_order(events, "user_id", "event_type", "seq", limit)
    return out.select("user_id", "event_type", F.col("_place").alias("place"))


_NUMBERED = """
    SELECT user_id, event_id, event_type, epoch_us(ts) AS us, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq
    FROM events
"""
_LENGTHS = f"""
    SELECT user_id, event_id, seq - CAST(sum(CASE WHEN event_type IN ('click', 'view') THEN 0 ELSE 1 END)
        OVER (PARTITION BY user_id ORDER BY seq) AS BIGINT) AS message_index
    FROM ({_NUMBERED})
"""
_BOUNDS = f"""
    SELECT l_orderkey AS o_orderkey, l_linenumber, l_partkey, sum(l_quantity) OVER (
        PARTITION BY l_orderkey ORDER BY {_LINES} ROWS UNBOUNDED PRECEDING) AS lap_end
    FROM lineitem
"""

QUERIES = {
    "lap_assign": (
        lap_assign,
        f"""WITH points AS (
                SELECT o_orderkey, CAST(k AS INTEGER) AS k,
                       CASE WHEN k < 14 THEN k * 20.0 + o_orderkey % 7 END AS distance
                FROM orders, generate_series(0, 14) AS g(k)
            )
            SELECT p.o_orderkey, p.k, CAST(1 + count(b.lap_end) AS INTEGER) AS lap
            FROM points p LEFT JOIN ({_BOUNDS}) b
              ON b.o_orderkey = p.o_orderkey AND (p.distance IS NULL OR b.lap_end < p.distance)
            GROUP BY p.o_orderkey, p.k""",
    ),
    "lap_ends": (lap_ends, _BOUNDS),
    "lap_number": (
        lap_number,
        f"""SELECT l_orderkey AS o_orderkey, l_linenumber, l_partkey,
                   row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINES}) AS number
            FROM lineitem""",
    ),
    "first_row": (
        first_rows,
        f"SELECT user_id, event_id, event_type, us FROM ({_NUMBERED}) WHERE seq = 1",
    ),
    "length_renumber": (length_renumber, _LENGTHS),
    "length_renumber_sliced": (length_renumber_sliced, _LENGTHS),
    "intensity_align": (
        intensity_align,
        f"""WITH m AS ({_NUMBERED}),
            words AS (
                SELECT user_id, ['warmup', 'active', 'rest', 'cooldown'][k % 4 + 1] AS word,
                       row_number() OVER (PARTITION BY user_id ORDER BY seq) - 1 AS j
                FROM m WHERE event_type = 'click' AND k < 25 AND k % 10 <> 9
            ),
            has AS (SELECT DISTINCT user_id FROM m WHERE event_type = 'click' AND k < 25),
            laps AS (
                SELECT user_id, event_id, CASE WHEN k % 7 <> 0 THEN k % 3 END AS step,
                       row_number() OVER (PARTITION BY user_id ORDER BY seq) AS number
                FROM m WHERE event_type = 'purchase'
            ),
            steps AS (
                SELECT user_id, step, row_number() OVER (PARTITION BY user_id ORDER BY min(number)) - 1 AS p
                FROM laps GROUP BY user_id, step
            ),
            sizes AS (
                SELECT user_id, (SELECT count(*) FROM words w WHERE w.user_id = h.user_id) AS nw,
                       (SELECT count(*) FROM steps s WHERE s.user_id = h.user_id) AS ns,
                       (SELECT min(p) FROM steps s WHERE s.user_id = h.user_id AND step IS NULL) AS np
                FROM has h
            ),
            modes AS (SELECT *, nw < ns AND np IS NOT NULL AND ns > 1 AS padded FROM sizes),
            paired AS (
                SELECT s.user_id, s.step, w.word
                FROM steps s JOIN modes m USING (user_id)
                LEFT JOIN words w ON w.user_id = s.user_id AND w.j = CASE
                    WHEN NOT padded OR s.p < np THEN s.p WHEN s.p > np THEN s.p - 1 END
                WHERE CASE WHEN padded THEN s.p <= greatest(nw, np)
                           ELSE s.p < nw AND (s.step IS NOT NULL OR ns = 1) END
            ),
            taken AS (
                SELECT l.user_id, p.word, row_number() OVER (PARTITION BY l.user_id ORDER BY l.number) AS number,
                       count(*) OVER (PARTITION BY l.user_id) AS n
                FROM laps l JOIN paired p ON p.user_id = l.user_id AND p.step IS NOT DISTINCT FROM l.step
            ),
            totals AS (SELECT user_id, count(*) AS n FROM laps GROUP BY user_id)
            SELECT l.user_id, l.event_id, l.number, t.word AS intensity
            FROM laps l JOIN totals USING (user_id)
            LEFT JOIN taken t ON t.user_id = l.user_id AND t.number = l.number AND t.n = totals.n""",
    ),
    "distinct_in_order": (
        distinct_types,
        f"""SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY min(seq)) - 1 AS place
            FROM ({_NUMBERED}) GROUP BY user_id, event_type""",
    ),
}
