"""Lap numbers: of laps in file order, and of points by distance covered."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapwise.operators.skew import attach, heavy_groups, heavy_join, min_rows_for, part_hot, running
from lapwise.session import durable


def number_in_order(
    df: DataFrame, key: str, order: list[str], out: str = "number", min_rows: float | None = None
) -> DataFrame:
    """1, 2, 3, … per ``key`` in ``order``."""
    return running(df, [key], order, {out: ("count", F.lit(1))}, min_rows=min_rows)


def first_row(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each group, picked before the shuffle; no sort."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*")


def lap_bounds(laps: DataFrame, key: str = "activity_id", order: list[str] = ("number",), min_rows: float | None = None):
    """Distance at the end of each lap. Laps without a distance bound nothing and are left out."""
    known = laps.where(F.col("total_distance").isNotNull())
    if known.schema["total_distance"].dataType.typeName() in {"double", "float"}:
        # Whole micrometres add up to the same in any order.
        exact = {"lap_end": ("sum", F.col("total_distance").cast("decimal(28,6)"))}
        ends = running(known, [key], list(order), exact, min_rows=min_rows)
        return ends.withColumn("lap_end", F.col("lap_end").cast("double"))
    return running(known, [key], list(order), {"lap_end": ("sum", "total_distance")}, min_rows=min_rows)


def assign_laps(
    points: DataFrame,
    laps: DataFrame,
    key: str = "activity_id",
    distance: str = "distance",
    lap_order: list[str] = ("number",),
    min_rows: float | None = None,
) -> DataFrame:
    """Points with ``lap`` = 1 + number of laps ending strictly before the point's distance.

    Beyond the last end, or without a distance, a point is in lap count + 1. Points and
    lap ends travel as one frame in order of distance, so a running count does it:
    one exchange and no lap list per activity.
    """
    limit = min_rows_for(points.sparkSession, min_rows)
    bounds = lap_bounds(laps, key, lap_order, limit).select(key, F.col("lap_end").alias("_pos"))
    # Points and lap ends are scanned together, so they count together.
    hot_keys = heavy_groups(points.select(key).unionByName(laps.select(key)), [key], limit)
    if hot_keys is None:
        return _count_ends(points, bounds, key, distance)

    cold, hot = part_hot(points, [key], hot_keys)
    cold_bounds, hot_bounds = part_hot(bounds, [key], hot_keys)
    # A place can repeat without bound (standing still), so scan each place once.
    places = hot.select(key, F.col(distance).alias("_pos")).where("_pos IS NOT NULL").distinct()
    line = places.select(key, "_pos", F.lit(0).alias("_kind")).unionByName(
        hot_bounds.select(key, "_pos", F.lit(1).alias("_kind"))
    )
    # The scan reads this several times; written once so that places are told apart once.
    line = durable(line)
    ends = F.when(F.col("_kind") == 1, 1)
    counted = running(line, [key], ["_pos", "_kind"], {"_passed": ("count", ends)}, min_rows=limit)
    at_place = counted.where("_kind = 0").select(key, F.col("_pos").alias(distance), "_passed")
    total = hot_bounds.groupBy(key).agg(F.count(F.lit(1)).alias("_total"))
    placed = attach(heavy_join(hot, at_place, [key, distance], "left", limit), total, [key], hot_keys.few)
    hot_out = placed.select(
        *points.columns, (F.coalesce("_passed", "_total", F.lit(0)) + 1).cast("int").alias("lap")
    )
    return _count_ends(cold, cold_bounds, key, distance).unionByName(hot_out)


def _count_ends(points: DataFrame, bounds: DataFrame, key: str, distance: str) -> DataFrame:
    line = points.withColumns({"_pos": F.col(distance).cast("double"), "_kind": F.lit(0)}).unionByName(
        bounds.select(key, F.col("_pos").cast("double").alias("_pos"), F.lit(1).alias("_kind")),
        allowMissingColumns=True,
    )
    in_order = Window.partitionBy(key).orderBy(F.asc_nulls_last("_pos"), "_kind")
    passed = F.count(F.when(F.col("_kind") == 1, 1)).over(
        in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        line.withColumn("lap", (passed + 1).cast("int")).where("_kind = 0").select(*points.columns, "lap")
    )


def renumber_lengths(
    lengths: DataFrame, key: str = "activity_id", order: list[str] = ("seq",), min_rows: float | None = None
) -> DataFrame:
    """``message_index`` counted from 1 over active swim lengths; a rest keeps the number before it.

    A missing length type counts as rest.
    """
    rest = F.when(F.col("length_type").eqNullSafe("active"), 0).otherwise(1)
    counted = running(lengths, [key], list(order), {"_rests": ("sum", rest)}, min_rows=min_rows)
    return counted.withColumn("message_index", F.col("message_index") + 1 - F.col("_rests")).drop("_rests")
