"""TCX and GPX documents, one per event, written by Spark and read back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lapwise.queries.tables import prop, read
from lapwise.sources.tracks import gpx_points, parse_gpx, parse_tcx, tcx_laps, tcx_points


DOCUMENTS_PER_TASK = 5_000


def _tag(name: str, *body: Column | str, attributes: Column | None = None) -> Column:
    parts = [F.lit(b) if isinstance(b, str) else b for b in body]
    start = [F.lit(f"<{name}>")] if attributes is None else [F.lit(f"<{name} "), attributes, F.lit(">")]
    return F.concat(*start, *parts, F.lit(f"</{name}>"))


def _text(c: Column) -> Column:
    return c.cast("string")


def _events(spark, sf_dir):
    # A document is much larger than its event: spread by their number before they are made.
    events = read(spark, sf_dir, "events")
    parts = -(-events.count() // DOCUMENTS_PER_TASK)
    return events.repartition(max(parts, 1), "event_id").select(
        "event_id", "value", prop("k").alias("k"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time")
    )


def _at_least_one(n: Column, each) -> Column:
    """Pieces for 0 .. n-1, joined."""
    return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), each), "")


def tcx_documents(spark, sf_dir):
    """1 to 3 laps of 1 to 4 points; the first point of a lap has no position when ``k`` is even."""
    k = F.col("k")

    def point(lap: Column, i: Column) -> Column:
        position = _tag(
            "Position", _tag("LatitudeDegrees", _text(lap + i * 0.5)), _tag("LongitudeDegrees", _text(-i * 0.25))
        )
        return _tag(
            "Trackpoint",
            _tag("Time", F.col("time")),
            F.when((k % 2 == 0) & (i == 0), F.lit("")).otherwise(position),
            _tag("AltitudeMeters", _text(i * 1.5)),
            _tag("HeartRateBpm", _tag("Value", _text(k + i))),
            F.when(i == 1, _tag("Cadence", _text(k))).otherwise(F.lit("")),
            # Speed at three depths, or nowhere.
            F.when(k % 4 == 0, _tag("Extensions", _tag("ns3:TPX", _tag("ns3:RunCadence", "80"), _tag("ns3:Speed", _text(i * 0.125)))))
            .when(k % 4 == 1, _tag("Extensions", _tag("maker", _tag("ns3:TPX", _tag("data", _tag("ns3:Speed", _text(i * 0.125)))))))
            .when(k % 4 == 2, _tag("ns3:Speed", _text(i * 0.125)))
            .otherwise(_tag("Extensions", _tag("ns3:TPX", _tag("ns3:SpeedZone", "4")))),
        )

    def lap(n: Column) -> Column:
        return _tag(
            "Lap",
            _tag("TotalTimeSeconds", _text(F.col("value"))),
            _tag("DistanceMeters", _text(n * 1000.0)),
            F.when(n == 0, _tag("MaximumSpeed", "3.5")).otherwise(F.lit("")),
            F.when(n != 1, _tag("MaximumHeartRateBpm", _tag("Value", _text(k + n)))).otherwise(F.lit("")),
            _tag("AverageHeartRateBpm", _tag("Value", _text(k))),
            F.when(n < 2, _tag("Track", _at_least_one(k % 4 + 1, lambda i: point(n, i)))).otherwise(F.lit("")),
            attributes=F.concat(F.lit('StartTime="'), F.col("time"), F.lit('"')),
        )

    activity = _tag("Activity", _at_least_one(k % 3 + 1, lap), attributes=F.lit('Sport="Running"'))
    other = F.lit('<Activity Sport="Other"><Lap StartTime="2000-01-01T00:00:00Z"></Lap></Activity>')
    root = _tag(
        "TrainingCenterDatabase",
        _tag("Activities", activity, F.when(k % 5 == 0, other).otherwise(F.lit(""))),
        attributes=F.lit('xmlns="urn:example:training" xmlns:ns3="urn:example:extension"'),
    )
    return _events(spark, sf_dir).select("event_id", root.alias("doc"))


def gpx_documents(spark, sf_dir):
    """1 to 4 points; every third event has a second segment and a second track, which do not count."""
    k = F.col("k")

    def point(i: Column) -> Column:
        extension = _tag(
            "extensions",
            _tag(
                "ns3:TrackPointExtension",
                _tag("ns3:hr", _text(k + i)),
                F.when(i == 1, _tag("ns3:cad", _text(k))).otherwise(F.lit("")),
            ),
        )
        return _tag(
            "trkpt",
            _tag("ele", _text(i * 1.5)),
            _tag("time", F.col("time")),
            F.when(i < 2, extension).otherwise(F.lit("")),
            attributes=F.concat(F.lit('lat="'), _text(i * 0.5), F.lit('" lon="'), _text(-i * 0.25), F.lit('"')),
        )

    segment = _tag("trkseg", _at_least_one(k % 4 + 1, point))
    more = F.when(k % 3 == 0, segment).otherwise(F.lit(""))
    root = _tag(
        "gpx",
        _tag("trk", _tag("name", "a"), segment, more),
        F.when(k % 3 == 0, _tag("trk", segment)).otherwise(F.lit("")),
        attributes=F.lit('xmlns="urn:example:gpx" xmlns:ns3="urn:example:extension"'),
    )
    return _events(spark, sf_dir).select("event_id", root.alias("doc"))


def laps(spark, sf_dir):
    out = tcx_laps(parse_tcx(tcx_documents(spark, sf_dir), "event_id", "doc"))
    total_us = F.round(F.col("total_time").cast("decimal(20,6)") * 1000000).cast("bigint")
    return out.select(
        "event_id", "number", F.unix_micros("start_time").alias("start_us"), "distance", total_us.alias("total_us"),
        "max_speed", "max_hr", "avg_hr",
    )


def points(spark, sf_dir):
    out = tcx_points(parse_tcx(tcx_documents(spark, sf_dir), "event_id", "doc"))
    return out.withColumn("time_us", F.unix_micros("time")).drop("time")


def gpx(spark, sf_dir):
    out = gpx_points(parse_gpx(gpx_documents(spark, sf_dir), "event_id", "doc"))
    return out.withColumn("time_us", F.unix_micros("time")).drop("time")


_EVENTS = "SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k, epoch_us(date_trunc('second', ts)) AS us FROM events"

QUERIES = {
    "tcx_laps": (
        laps,
        f"""SELECT event_id, CAST(n + 1 AS INTEGER) AS number, us AS start_us, n * 1000.0::DOUBLE AS distance,
                   CAST(round(value * 1000000) AS BIGINT) AS total_us, CASE WHEN n = 0 THEN 3.5::DOUBLE END AS max_speed,
                   CASE WHEN n <> 1 THEN (k + n)::DOUBLE END AS max_hr, k::DOUBLE AS avg_hr
            FROM ({_EVENTS}), generate_series(0, 2) AS g(n) WHERE n <= k % 3""",
    ),
    "tcx_points": (
        points,
        f"""SELECT event_id, n + i * 0.5::DOUBLE AS latitude, -i * 0.25::DOUBLE AS longitude,
                   i * 1.5::DOUBLE AS elevation, us AS time_us, CAST(k + i AS INTEGER) AS heart_rate,
                   CASE WHEN i = 1 THEN k END AS cadence, CASE WHEN k % 4 < 3 THEN i * 0.125::DOUBLE END AS speed, CAST(n + 1 AS INTEGER) AS lap
            FROM ({_EVENTS}), generate_series(0, 1) AS g(n), generate_series(0, 3) AS h(i)
            WHERE n <= k % 3 AND i <= k % 4 AND NOT (k % 2 = 0 AND i = 0)""",
    ),
    "gpx_points": (
        gpx,
        f"""SELECT event_id, i * 0.5::DOUBLE AS latitude, -i * 0.25::DOUBLE AS longitude,
                   i * 1.5::DOUBLE AS elevation, us AS time_us,
                   CASE WHEN i < 2 THEN CAST(k + i AS INTEGER) END AS heart_rate,
                   CASE WHEN i = 1 THEN k END AS cadence
            FROM ({_EVENTS}), generate_series(0, 3) AS h(i) WHERE i <= k % 4""",
    ),
}
