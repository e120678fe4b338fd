"""Which rows of a load are new, which have a parent, and updates to stored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.operators.laps import first_row
from lapwise.operators.numbering import dense_numbers
from lapwise.operators.skew import heavy_join

POWER = ["avg_power", "max_power", "normalized_power"]


def insert_if_absent(new: DataFrame, existing: DataFrame, order: list[str], key: str = "activity_id") -> DataFrame:
    """Rows of ``new`` whose key is not stored yet; of several with one key, the first in ``order``."""
    return first_row(new, [key], order).join(existing.select(key), key, "left_anti").select(*new.columns)


def with_parent(
    children: DataFrame, parents: DataFrame, key: str = "activity_id", min_rows: float | None = None
) -> DataFrame:
    """Child rows whose activity is in ``parents``."""
    return heavy_join(children, parents.select(key), [key], "left_semi", min_rows, DataFrame.distinct)


def without_parent(
    children: DataFrame, parents: DataFrame, key: str = "activity_id", min_rows: float | None = None
) -> DataFrame:
    """Child rows whose activity is missing, or that name none."""
    return heavy_join(children, parents.select(key), [key], "left_anti", min_rows, DataFrame.distinct)


def reject_shared_ids(files: DataFrame, file: str = "file", key: str = "activity_id") -> DataFrame:
    """Ids that more than one file name leads to."""
    return files.groupBy(key).agg(F.min(file).alias("_a"), F.max(file).alias("_b")).where("_a <> _b").select(key)


def serial_ids(
    rows: DataFrame, stored: DataFrame, order: list[str], key: str = "activity_id"
) -> DataFrame:
    """``rows`` with ids that follow the largest stored one without a gap, in ``order``.

    The same on every run against the same store if ``order`` tells rows apart. A load that may run again at any
    time takes ``functions.names.made_id`` instead, which asks no store.
    """
    largest = stored.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    return dense_numbers(rows, order, key, after=largest)


def update_pool(
    sessions: DataFrame,
    updates: DataFrame,
    order: list[str],
    key: str = "activity_id",
    min_rows: float | None = None,
) -> DataFrame:
    """``sessions`` with pool length and unit from ``updates``, by activity and kind of sport.

    Only lap swimming is updated. The last update in ``order`` wins. A missing length
    becomes 0 and a fraction is cut off; a missing unit leaves the stored one.
    """
    keys = [key, "sub_sport"]
    swims = updates.where(F.col("sub_sport") == "lap_swimming")
    last = F.max_by(F.struct("pool_length", "pool_length_unit"), F.struct(*order)).alias("_new")
    joined = heavy_join(sessions, swims, keys, "left", min_rows, lambda rows: rows.groupBy(*keys).agg(last))
    length = F.coalesce(F.col("_new.pool_length"), F.lit(0)).cast("bigint")
    hit = F.col("_new").isNotNull()
    return joined.withColumns(
        {
            "pool_length": F.when(hit, length.cast(sessions.schema["pool_length"].dataType)).otherwise(
                F.col("pool_length")
            ),
            "pool_length_unit": F.coalesce(F.col("_new.pool_length_unit"), F.col("pool_length_unit")),
        }
    ).select(*sessions.columns)


def backfill_power(
    laps: DataFrame,
    decoded: DataFrame,
    order: list[str],
    key: str = "activity_id",
    min_rows: float | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """``laps`` with missing power values taken from ``decoded`` laps of the same number.

    The first in ``order`` counts where a lap was decoded more than once. ``min_rows`` and ``tasks`` as for ``heavy_join``.
    """
    keys = [key, "number"]
    first = F.min_by(F.struct(*POWER), F.struct(*order)).alias("_new")
    joined = heavy_join(laps, decoded, keys, "left", min_rows, lambda rows: rows.groupBy(*keys).agg(first), tasks)
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_new.{c}")) for c in POWER}).select(*laps.columns)
