"""Helpers several operators share: reading tables, unique column names, totals that run through large groups."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 20_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has it (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def whole_row(df: DataFrame) -> Column:
    """All columns as one, so that none of them clashes with a name used on the way."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def unit(*parts: Column | str) -> Column:
    """A double in [0, 1) that depends on ``parts`` alone, the same in every run."""
    columns = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def blocks_for(rows: int, rows_per_block: int = ROWS_PER_BLOCK) -> int:
    return max(1, -(-rows // rows_per_block))


def compact(df: DataFrame, rows: int, rows_per_task: int = 100_000) -> DataFrame:
    """``df`` of about ``rows`` narrow rows in as few partitions as suit them, without a shuffle.

    Iterations over a small table would else write a file per partition and shuffle, again and again.
    """
    return df.coalesce(blocks_for(rows, rows_per_task))


def running_total(
    df: DataFrame, groups: list[str], place: str, ties: Iterable[str], value: Column, out: str, blocks: int
) -> DataFrame:
    """Adds ``out``: ``value`` summed over the rows of the group up to this one, this one included.

    Rows of a group are ordered by ``place``, a double in [0, 1) that spreads rows evenly, then by
    ``ties``. Each group is cut into ``blocks`` stretches of ``place``; a window runs through a
    stretch, and one row per stretch carries the sums of earlier ones. So no task takes a whole
    group, however many rows one group has. ``groups`` hold no nulls; ``df`` must give the same
    rows when read twice.
    """
    cut = df.withColumn("_block", F.floor(F.col(place) * blocks)).withColumn("_value", value)
    keys = [*groups, "_block"]
    before = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        cut.groupBy(*keys).agg(F.sum("_value").alias("_sum"))
        .select(*keys, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*keys).orderBy(place, *ties).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.withColumn("_inside", F.sum("_value").over(inside))
        .join(carried, keys)
        .withColumn(out, F.col("_before") + F.col("_inside"))
        .drop("_block", "_value", "_sum", "_before", "_inside")
    )


def shared_folder(spark: SparkSession) -> str:
    """Where tables that all executors must see are kept: the checkpoint folder, else the warehouse."""
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
