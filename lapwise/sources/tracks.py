"""TCX and GPX tracks.

Each format has two ways in, a folder of files or a text column, and the same tables out.
One file is one XML document and one task reads it whole; files are spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.functions.values import seconds_to_duration

XML_OPTIONS = {"ignoreNamespace": "true", "attributePrefix": "_", "mode": "PERMISSIVE"}

_VALUE = "struct<Value:double>"
_POINT = (
    "struct<Time:timestamp,Position:struct<LatitudeDegrees:double,LongitudeDegrees:double>,"
    f"AltitudeMeters:double,DistanceMeters:double,HeartRateBpm:{_VALUE},Cadence:double,"
    # What is not named here comes as text, whatever stands below it.
    "Speed:string,xs_any:array<string>>"
)
_SPEED = r"<(?:[\w.-]+:)?Speed(?:\s[^>]*)?>\s*([^<\s]+)"
_LAP = (
    "struct<_StartTime:timestamp,TotalTimeSeconds:double,DistanceMeters:double,MaximumSpeed:double,"
    f"MaximumHeartRateBpm:{_VALUE},AverageHeartRateBpm:{_VALUE},Track:array<struct<Trackpoint:array<{_POINT}>>>>"
)
ACTIVITIES = f"Activity array<struct<_Sport:string,Id:string,Lap:array<{_LAP}>>>"
TCX_DOCUMENT = f"Activities struct<{ACTIVITIES.replace(' ', ':', 1)}>"

_TRKPT = (
    "struct<_lat:double,_lon:double,ele:double,time:timestamp,"
    "extensions:struct<TrackPointExtension:array<struct<hr:int,cad:int>>>>"
)
GPX_DOCUMENT = f"trk array<struct<name:string,trkseg:array<struct<trkpt:array<{_TRKPT}>>>>>"


def read_tcx(spark: SparkSession, path: str, glob: str = "*.tcx") -> DataFrame:
    """``file`` and the first activity of each file."""
    docs = _read_xml(spark, path, glob, "Activities", ACTIVITIES)
    return docs.select("file", F.get("Activity", F.lit(0)).alias("activity"))


def parse_tcx(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The same from a column of documents; ``key`` names them."""
    doc = F.from_xml(F.col(text), TCX_DOCUMENT, XML_OPTIONS)
    return docs.select(key, F.get(doc["Activities"]["Activity"], F.lit(0)).alias("activity"))


def tcx_laps(activities: DataFrame) -> DataFrame:
    """One row per lap, numbered from 1; everything beside ``activity`` is kept."""
    return _laps(activities).select(
        *_names(activities),
        "number",
        F.col("lap._StartTime").alias("start_time"),
        F.col("lap.DistanceMeters").alias("distance"),
        seconds_to_duration(F.col("lap.TotalTimeSeconds")).alias("total_time"),
        F.col("lap.MaximumSpeed").alias("max_speed"),
        F.col("lap.MaximumHeartRateBpm.Value").alias("max_hr"),
        F.col("lap.AverageHeartRateBpm.Value").alias("avg_hr"),
    )


def tcx_points(activities: DataFrame) -> DataFrame:
    """Points of the first track of each lap that have a position.

    ``speed`` is the point's first Speed element, at any depth.
    """
    names = _names(activities)
    track = F.get("lap.Track", F.lit(0))
    points = _laps(activities).select(*names, "number", F.explode_outer(track["Trackpoint"]).alias("p"))
    return points.where("p.Position IS NOT NULL").select(
        *names,
        F.col("p.Position.LatitudeDegrees").alias("latitude"),
        F.col("p.Position.LongitudeDegrees").alias("longitude"),
        F.col("p.AltitudeMeters").alias("elevation"),
        F.col("p.Time").alias("time"),
        F.col("p.HeartRateBpm.Value").cast("int").alias("heart_rate"),
        F.col("p.Cadence").cast("int").alias("cadence"),
        F.coalesce(
            F.col("p.Speed"), F.regexp_extract(F.array_join("p.xs_any", " "), _SPEED, 1)
        ).try_cast("double").alias("speed"),
        F.col("number").alias("lap"),
    )


def read_gpx(spark: SparkSession, path: str, glob: str = "*.gpx") -> DataFrame:
    """``file`` and the tracks of each file."""
    return _read_xml(spark, path, glob, "gpx", GPX_DOCUMENT)


def parse_gpx(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The same from a column of documents."""
    return docs.select(key, F.from_xml(F.col(text), GPX_DOCUMENT, XML_OPTIONS)["trk"].alias("trk"))


def gpx_points(tracks: DataFrame) -> DataFrame:
    """Points of the first segment of the first track."""
    names = [c for c in tracks.columns if c != "trk"]
    segment = F.get(F.get("trk", F.lit(0))["trkseg"], F.lit(0))
    extension = F.get("p.extensions.TrackPointExtension", F.lit(0))
    return tracks.select(*names, F.explode_outer(segment["trkpt"]).alias("p")).where("p IS NOT NULL").select(
        *names,
        F.col("p._lat").alias("latitude"),
        F.col("p._lon").alias("longitude"),
        F.col("p.ele").alias("elevation"),
        F.col("p.time").alias("time"),
        extension["hr"].alias("heart_rate"),
        extension["cad"].alias("cadence"),
    )


def _read_xml(spark: SparkSession, path: str, glob: str, tag: str, schema: str) -> DataFrame:
    reader = spark.read.format("xml").options(**XML_OPTIONS, rowTag=tag, pathGlobFilter=glob)
    return reader.schema(schema).load(path).select(F.col("_metadata.file_name").alias("file"), "*")


def _names(activities: DataFrame) -> list[str]:
    return [c for c in activities.columns if c != "activity"]


def _laps(activities: DataFrame) -> DataFrame:
    # The plain explode would be preceded by a filter on the list, which parses the document again.
    laps = activities.select(*_names(activities), F.posexplode_outer("activity.Lap").alias("_at", "lap"))
    return laps.where("lap IS NOT NULL").withColumn("number", F.col("_at") + 1)


