"""JSON summaries that come beside activity files."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.functions.names import pair_key
from lapwise.functions.values import nested

# Path in the summary, name in the activity table.
PATHS = {
    "summaryDTO.distance": "adjusted_distance",
    "summaryDTO.duration": "adjusted_duration",
    "summaryDTO.directWorkoutFeel": "workout_feel",
    "summaryDTO.directWorkoutRpe": "effort",
    "eventTypeDTO.typeKey": "category",
    "activityName": "activity_name",
    "description": "description",
}

SCHEMA = (
    "summaryDTO struct<distance:double,duration:double,directWorkoutFeel:double,directWorkoutRpe:double>,"
    "eventTypeDTO struct<typeKey:string>,activityName string,description string"
)


def read_sidecars(
    spark: SparkSession, path: str, glob: str = "*_summary.json", since: datetime | None = None
) -> DataFrame:
    """``file, pair`` and the flat columns; a file that is no JSON gives nulls.

    Names begin with the activity's time. With ``since``, files of names before the day before it are
    not opened: names are compared while files are listed. (A day, as names may be in any time zone.)
    """
    docs = spark.read.schema(SCHEMA).options(multiLine="true", mode="PERMISSIVE", pathGlobFilter=glob).json(path)
    if since is not None:
        docs = docs.where(F.col("_metadata.file_name") >= _day_before(since))
    docs = docs.select(F.col("_metadata.file_name").alias("file"), "*")
    return docs.select("file", pair_key(F.col("file")).alias("pair"), *[F.col(p).alias(n) for p, n in PATHS.items()])


def summaries_since(spark: SparkSession, path: str, glob: str = "*_summary.json") -> Callable[[datetime], DataFrame]:
    """The summaries of a folder for a load, read from its mark on."""
    return lambda since: read_sidecars(spark, path, glob, since)


def _day_before(time: datetime) -> str:
    time = time.astimezone(timezone.utc) if time.tzinfo else time
    return f"{time - timedelta(days=1):%Y-%m-%d}" if time.year >= 1000 else ""


def _type(tree: dict) -> T.DataType:
    if not tree:
        return T.StringType()
    return T.StructType([T.StructField(step, _type(below)) for step, below in tree.items()])


def flatten(docs: DataFrame, text: str, paths: dict[str, str]) -> DataFrame:
    """``docs`` with one text column per dotted path of its JSON column; null when absent.

    All paths through objects share one parse. Digits index lists, whose elements may differ in kind:
    such a path is read by itself, as is one that ends where another goes on.
    """
    tree: dict = {}
    for path in paths:
        if not any(step.isdigit() for step in path.split(".")):
            reduce(lambda node, step: node.setdefault(step, {}), path.split("."), tree)
    parsed = F.from_json(text, _type(tree)) if tree else None

    def at(path: str) -> Column:
        node, found = tree, parsed
        for step in path.split("."):
            if step not in node:
                return nested(F.col(text), path)
            node, found = node[step], found[step]
        return nested(F.col(text), path) if node else found

    return docs.withColumns({name: at(path) for path, name in paths.items()})
