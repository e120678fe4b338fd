"""Reading the shared tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.session import use_utc

# Line items of an order repeat line numbers; these settle the order.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def micros(column: str) -> Column:
    """A stored time, which has no zone, as microseconds."""
    return F.unix_micros(F.col(column).cast("timestamp"))


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("long")


def prop(name: str) -> Column:
    return F.get_json_object("props", f"$.{name}").cast("int")
