"""Decoded device messages and the rows they hold.

A message table has ``file, seq, name, fields``: one row per data message, ``seq`` its
place in the file, ``fields`` the fields it carries as text. ``write_messages`` stores it
by day and ``name``: a load then reads the days since its mark only, each table its own messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.functions.values import degrees
from lapwise.schemas import DAY, DERIVED, LAYOUTS, MESSAGES, SEMICIRCLES, columns

# Fixed value: the stored name of a record's position fields.
POSITION_FIELDS = {"latitude": "position_lat", "longitude": "position_long"}
# Up to so many fields, a table's rows are looked up by an expression per column.
FEW_FIELDS = 16


def read_messages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(MESSAGES).format(fmt).load(path)


def write_messages(messages: DataFrame, path: str, file_time: Column, mode: str = "append") -> None:
    """Store messages by the day of their file's time, and by name."""
    days = messages.withColumn(DAY, F.to_date(file_time))
    days.write.mode(mode).partitionBy(DAY, "name").parquet(path)


def kept_by_name(messages: DataFrame, path: str) -> DataFrame:
    """``messages`` written to ``path``, in place of what is there, and read from it: made once however often they are read.

    Stored by name, each table reads its own messages and fields only, which a micro-batch of a stream does not offer.
    """
    writer = messages.select(*MESSAGES.names).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("name").parquet(path)
    return read_messages(messages.sparkSession, path).select(*MESSAGES.names)


def field(name: str) -> Column:
    """A field as text; null when absent or not a number."""
    text = F.col("fields")[name]
    return F.when(F.lower(text) != "nan", text)


def has_field(name: str) -> Column:
    """Whether the message carries the field, with a value or without."""
    return F.map_contains_key("fields", name)


def held_fields(table: str) -> dict[str, Column]:
    """What a message holds for each of the table's own columns, as text; absent ones null, coordinates in degrees."""
    return _in_degrees({n: field(f) for n, f in _own_fields(table).items()}, table)


def _own_fields(table: str) -> dict[str, str]:
    """The field that each of the table's own columns is read from."""
    skip = DERIVED.get(table, {"activity_id"})
    own = {n: n for n, _ in columns(table) if n not in skip}
    return POSITION_FIELDS | own if table == "record" else own


def _in_degrees(picked: dict[str, Column], table: str) -> dict[str, Column]:
    turned = {n: degrees(picked[n].try_cast("double")).cast("string") for n in SEMICIRCLES.get(table, [])}
    return picked | turned


def belongs(table: str) -> Column:
    """Whether a message is a row of the table. Records without position fields are not; positions without a value are."""
    named = F.col("name") == table
    return named & has_field("position_lat") & has_field("position_long") if table == "record" else named


def message_rows(messages: DataFrame, table: str, only: list[str] | None = None) -> DataFrame:
    """``file, seq`` and the table's own fields, or ``only`` those columns.

    Of tables with many columns, all fields are looked up in one pass over their names: an expression per column would
    make generated code too long to be compiled. Of others, columns that nobody asks for are not looked up.
    """
    own = {n: f for n, f in _own_fields(table).items() if only is None or n in only}
    if len(own) <= FEW_FIELDS:
        held = held_fields(table)
        return messages.where(belongs(table)).select("file", "seq", *[held[n].alias(n) for n in own])
    texts = F.transform(F.array(*[F.lit(f) for f in own.values()]), lambda name: F.col("fields")[name])
    held = F.transform(texts, lambda text: F.when(F.lower(text) != "nan", text))
    picked = _in_degrees({n: F.col("_held")[i] for i, n in enumerate(own)}, table)
    rows = messages.where(belongs(table)).select("file", "seq", held.alias("_held"))
    return rows.select("file", "seq", *[c.alias(n) for n, c in picked.items()])


def filled_fields(messages: DataFrame) -> DataFrame:
    """``table_name, n, filled`` for all seven tables: rows, and fields that hold something, counted in one pass."""
    def held(table: str) -> Column:
        return sum((F.when(c.isNotNull(), 1).otherwise(0) for c in held_fields(table).values()), F.lit(0))

    per_table = {t: F.when(belongs(t), held(t)) for t in LAYOUTS}
    counted = messages.agg(*[
        F.struct(F.lit(t).alias("table_name"), F.count(c).alias("n"), F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias("filled")).alias(t)
        for t, c in per_table.items()
    ])
    return counted.select(F.inline(F.array(*per_table)))


def route(messages: DataFrame) -> dict[str, DataFrame]:
    """Rows of all seven tables."""
    return {table: message_rows(messages, table) for table in LAYOUTS}


def workout_fields(messages: DataFrame) -> DataFrame:
    """Messages of any kind that carry an intensity or a workout step number."""
    return messages.where(has_field("intensity") | has_field("wkt_step_index")).select(
        "file",
        "seq",
        has_field("intensity").alias("has_intensity"),
        field("intensity").alias("intensity"),
        has_field("wkt_step_index").alias("has_step"),
        field("wkt_step_index").try_cast("bigint").alias("step"),
    )
