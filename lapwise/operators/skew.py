"""Groups too large for one task: finding them, joining on them, scanning through them.

``heavy_groups`` returns every group above ``min_rows``, however many there are. Up to
``FEW_GROUPS`` of them are rows of the plan and may be broadcast; more stay a distributed table,
and then scans slice all groups alike, while joins are shuffled, where adaptive skew handling splits the hot side.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lapwise.session import durable

FEW_GROUPS = 4096
FEW_SLICES = 100_000
# Ranges that hot rows are cut into where the row limit asks for more; beyond that, only as many as
# leave ROWS_PER_TASK rows in each.
MOST_RANGES = 256
DEFAULT_MIN_ROWS = 2_000_000
ROWS_PER_TASK = 1_000_000
MIN_ROWS_SETTING = "spark.lapwise.hotGroupRows"
# Groups are counted by buckets of their hash first, so that the counts do not grow with the number of groups.
BUCKETS = 65_536
# In place of a row limit: the caller has counted a frame that contains this one, found no
# hot group, and there is nothing left to count.
MEASURED = float("inf")


@dataclass
class Groups:
    """One row per hot group; ``few`` if they may be broadcast. ``rows`` is what ``part_hot`` gives as hot, in rows."""

    frame: DataFrame
    few: bool
    rows: int


def min_rows_for(spark: SparkSession, given: float | None) -> float:
    """Rows one task may take without question: the argument, else the session's setting."""
    if given is not None:
        return given
    return int(spark.conf.get(MIN_ROWS_SETTING, str(DEFAULT_MIN_ROWS)))


def heavy_groups(df: DataFrame, keys: list[str], min_rows: float) -> Groups | None:
    """Keys and row count ``_n`` of the groups above ``min_rows``.

    Reads the key columns only and counts before the shuffle.
    """
    return None if min_rows == MEASURED else counted(df, keys, min_rows)[1]


def counted(df: DataFrame, keys: list[str], min_rows: float) -> tuple[int, Groups | None]:
    """Rows of ``df``, and its groups above ``min_rows`` as ``heavy_groups`` gives them.

    A group is not above the limit if its bucket is not, so only the groups of buckets above it are counted one by one.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    sizes = df.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    above = F.collect_list(F.when(F.col("_n") > min_rows, F.col("_b")))
    rows, full = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)), above).first()
    if not full:
        return rows, None
    counts = (df.where(bucket.isin(full)) if len(full) <= FEW_GROUPS else df).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    found = as_groups(counts.where(F.col("_n") > min_rows))
    if found is None or found.few:
        return rows, found
    return rows, Groups(durable(counts).where(F.col("_n") > min_rows), False, rows)


def as_groups(found: DataFrame, all_rows: int = 0) -> Groups | None:
    """One row per group with its ``_n`` as ``Groups``; nothing if there is none. ``all_rows`` are the rows of all groups."""
    rows = found.limit(FEW_GROUPS + 1).collect()
    if not rows:
        return None
    if len(rows) > FEW_GROUPS:
        return Groups(found, False, all_rows)
    # From Arrow, so that the plan holds the rows themselves and knows their size.
    table = pa.Table.from_pylist([r.asDict() for r in rows], to_arrow_schema(found.schema))
    return Groups(found.sparkSession.createDataFrame(table, found.schema), True, sum(r["_n"] for r in rows))


def measured(df: DataFrame, keys: list[str], min_rows: float | None = None) -> float:
    """The row limit for steps that scan ``df``, or frames with no more rows per group.

    Counts once; with no hot group those steps need not count again.
    """
    limit = min_rows_for(df.sparkSession, min_rows)
    return limit if heavy_groups(df, keys, limit) else MEASURED


def widened_rows(df: DataFrame, key: str) -> int:
    """Rows of ``df`` times log2 of the rows in their group: what a search that halves every group again and again makes of them.

    Reads the key column only and counts before the shuffle.
    """
    wide = F.col("count") * F.greatest(F.ceil(F.log2("count")), F.lit(1))
    return int(df.select(key).groupBy(key).count().agg(F.coalesce(F.sum(wide), F.lit(0))).first()[0])


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """Tasks to deal ``rows`` to, so that what one task holds does not grow with the table; none if one may take them all.

    Given as a number, since adaptive execution puts small shuffles together by their bytes, before rows multiply.
    """
    return None if rows <= ROWS_PER_TASK else max(-(-rows // ROWS_PER_TASK), spark.sparkContext.defaultParallelism)


def dealing(
    df: DataFrame, keys: list[str], min_rows: float | None = None, sides: int = 1
) -> tuple[float, int | None]:
    """The row limit as ``measured`` gives it, and the tasks to deal the rows of ``df`` to by ``keys``: none if a group is hot.

    ``sides`` is how many frames, none with more rows than ``df``, meet in a task.
    """
    limit = min_rows_for(df.sparkSession, min_rows)
    rows, hot = counted(df, keys, limit)
    return (limit, None) if hot else (MEASURED, tasks_for(df.sparkSession, sides * rows))


def deal(df: DataFrame, keys: list[str], tasks: int | None) -> DataFrame:
    """Rows by ``keys`` in ``tasks`` parts; without a number, as they are."""
    return df.repartition(tasks, *keys) if tasks else df


def _same_group(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys])


def _side(df: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(df) if few else df


def attach(df: DataFrame, groups: DataFrame, keys: list[str], few: bool, how: str = "left") -> DataFrame:
    """Join one row per group of ``keys``; ``few`` says that ``groups`` is bounded and may be broadcast."""
    named = groups.select(
        *[F.col(k).alias(f"_g_{k}") for k in keys], *[c for c in groups.columns if c not in keys]
    )
    return df.join(_side(named, few), _same_group(keys), how).drop(*[f"_g_{k}" for k in keys])


def part_hot(df: DataFrame, keys: list[str], hot: Groups) -> tuple[DataFrame, DataFrame]:
    """``df`` without the hot groups, and the hot groups alone.

    Where hot groups are too many to broadcast, all groups go with them: two joins of all rows would cost more than
    slicing the ordinary groups too, which gives them the same results.
    """
    if not hot.few:
        return df.where(F.lit(False)), df
    frame = F.broadcast(hot.frame.select(*[F.col(k).alias(f"_g_{k}") for k in keys]))
    test = _same_group(keys)
    return df.join(frame, test, "left_anti"), df.join(frame, test, "left_semi")


def heavy_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    min_rows: float | None = None,
    once: Callable[[DataFrame], DataFrame] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Equi join where keys repeat without bound on the left and are unique on the right, or made so by ``once``.

    Rows of few heavy left keys meet the as few right rows of those keys by broadcast, where
    they stand; all others join by shuffle. With ``once``, large sides are counted and dealt to tasks by their rows, before
    ``once``; a caller who has counted both gives the number of ``tasks``. A right side with a heavy key is not dealt, as
    ``once`` combines its rows before the shuffle, nor one that a single task may take, which may be broadcast.
    """
    spark, unique = left.sparkSession, once or (lambda rows: rows)
    limit = min_rows_for(spark, min_rows)
    if limit == MEASURED:
        return deal(left, keys, tasks).join(unique(deal(right, keys, tasks)), keys, how)
    rows, hot = counted(left, keys, limit)
    if hot is not None and not hot.few:
        return left.join(unique(right), keys, how)
    if once is not None and tasks is None:
        right_rows, repeated = counted(right, keys, limit)
        if repeated is None and right_rows > ROWS_PER_TASK:
            tasks = tasks_for(spark, rows + right_rows)
    if hot is None:
        return deal(left, keys, tasks).join(unique(deal(right, keys, tasks)), keys, how)
    cold_left, hot_left = part_hot(left, keys, hot)
    _, hot_right = part_hot(right, keys, hot)
    cold = deal(cold_left, keys, tasks).join(unique(deal(right, keys, tasks)), keys, how)
    return cold.unionByName(hot_left.join(F.broadcast(unique(hot_right)), keys, how))


@dataclass
class Slices:
    """Rows of ordinary groups, rows of hot groups, and the columns that slice the latter.

    ``(keys, cuts)`` names a slice; slices of a group follow each other in the order asked for.
    ``few`` says that one row per range may be broadcast.
    """

    cold: DataFrame
    hot: DataFrame | None = None
    cuts: list[str] = field(default_factory=list)
    few: bool = True


def slice_groups(
    df: DataFrame, keys: list[str], order: list[str], min_rows: float | None = None, hot_rows: int | None = None
) -> Slices:
    """Cut every hot group into consecutive slices of about ``min_rows`` rows each, or fewer slices if those were very many.

    The hot rows are sorted across tasks by group and ``order``, in ranges of about equally many rows, and written
    once, each with its range: a task run again finds each row in the same slice. A slice is what one range
    holds of a group, so of each range only the first group can have begun before. Rows tied in ``order`` stay
    together. With ``hot_rows``, the caller knows that all groups may count as hot and how many rows they have at most.
    """
    limit = min_rows_for(df.sparkSession, min_rows)
    cold, work = df.where(F.lit(False)), df
    if hot_rows is None:
        hot = heavy_groups(df, keys, limit)
        if hot is None:
            return Slices(df)
        hot_rows = hot.rows
        cold, work = part_hot(df, keys, hot)
    ranges = max(1, min(ceil(2 * hot_rows / limit), max(MOST_RANGES, ceil(hot_rows / ROWS_PER_TASK))))
    ranged = work.repartitionByRange(ranges, *keys, *order).withColumn("_cut", F.spark_partition_id())
    return Slices(cold, durable(ranged), ["_cut"], ranges <= FEW_SLICES)


_FOLD = {
    "sum": (F.sum, lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)),
    "count": (F.count, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "min": (F.min, lambda a, b: F.least(a, b)),
    "max": (F.max, lambda a, b: F.greatest(a, b)),
}


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    outputs: dict[str, tuple[str, str | Column]],
    inclusive: bool = True,
    min_rows: float | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Running ``sum``/``count``/``min``/``max`` per group in ``order``.

    ``outputs`` maps a new column to ``(aggregate, input)``. Ordinary groups take one
    window. Hot groups take a window per slice, plus what all earlier slices of the group
    add up to: one small row per slice that has any, joined back. ``hot_rows`` as for ``slice_groups``.
    """
    inputs = {f"_in_{out}": (F.col(c) if isinstance(c, str) else c) for out, (_, c) in outputs.items()}
    keep = df.columns
    df = df.withColumns(inputs)
    parts = slice_groups(df, keys, order, min_rows, hot_rows)
    end = Window.currentRow if inclusive else -1

    def windowed(frame: DataFrame, group: list[str]) -> DataFrame:
        w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
        return frame.withColumns({out: _FOLD[agg][0](f"_in_{out}").over(w) for out, (agg, _) in outputs.items()})

    cold = windowed(parts.cold, keys).select(*keep, *outputs)
    if parts.hot is None:
        return cold
    group = keys + parts.cuts
    before = Window.partitionBy(*keys).orderBy(*parts.cuts).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        parts.hot.groupBy(*group)
        .agg(*[_FOLD[agg][0](f"_in_{out}").alias(f"_sum_{out}") for out, (agg, _) in outputs.items()])
        .select(
            *group,
            *[
                (F.sum if agg == "count" else _FOLD[agg][0])(f"_sum_{out}").over(before).alias(f"_carry_{out}")
                for out, (agg, _) in outputs.items()
            ],
            _later(keys, parts.cuts),
        )
    )
    joined = attach(windowed(parts.hot, group), _continued(carried), group, parts.few)
    hot = joined.select(
        *keep, *[_FOLD[agg][1](F.col(f"_carry_{out}"), F.col(out)).alias(out) for out, (agg, _) in outputs.items()]
    )
    return cold.unionByName(hot)


def _later(keys: list[str], cuts: list[str]) -> Column:
    return (F.row_number().over(Window.partitionBy(*keys).orderBy(*cuts)) > 1).alias("_later")


def _continued(slices: DataFrame) -> DataFrame:
    """Slices that are not the first of their group: one a range at most."""
    return slices.where("_later").drop("_later")


def totals(
    df: DataFrame, keys: list[str], outputs: dict[str, tuple[str, str | Column]], min_rows: float | None = None
) -> DataFrame:
    """Each row with aggregates over its whole group; ``outputs`` as for ``running``."""
    values = {out: _FOLD[agg][0](c) for out, (agg, c) in outputs.items()}

    def windowed(frame: DataFrame) -> DataFrame:
        return frame.withColumns({out: v.over(Window.partitionBy(*keys)) for out, v in values.items()})

    hot_keys = heavy_groups(df, keys, min_rows_for(df.sparkSession, min_rows))
    if hot_keys is None:
        return windowed(df)
    cold, hot = part_hot(df, keys, hot_keys)
    per_group = hot.groupBy(*keys).agg(*[v.alias(out) for out, v in values.items()])
    return windowed(cold).unionByName(attach(hot, per_group, keys, hot_keys.few))


def previous(
    df: DataFrame, keys: list[str], order: list[str], outputs: dict[str, str], min_rows: float | None = None
) -> DataFrame:
    """Value of the row before, per group in ``order``; ``outputs`` maps new column to input."""
    keep = df.columns
    parts = slice_groups(df, keys, order, min_rows)

    def windowed(frame: DataFrame, group: list[str]) -> DataFrame:
        w = Window.partitionBy(*group).orderBy(*order)
        return frame.withColumns({out: F.lag(c).over(w) for out, c in outputs.items()})

    cold = windowed(parts.cold, keys).select(*keep, *outputs)
    if parts.hot is None:
        return cold
    group = keys + parts.cuts
    last = F.max_by(F.struct(*[F.col(c).alias(out) for out, c in outputs.items()]), F.struct(*order))
    carried = (
        parts.hot.groupBy(*group)
        .agg(last.alias("_last"))
        .select(
            *group, F.lag("_last").over(Window.partitionBy(*keys).orderBy(*parts.cuts)).alias("_before"), _later(keys, parts.cuts)
        )
    )
    first = F.row_number().over(Window.partitionBy(*group).orderBy(*order)) == 1
    joined = attach(windowed(parts.hot, group).withColumn("_first", first), _continued(carried), group, parts.few)
    hot = joined.select(
        *keep,
        *[F.when(F.col("_first"), F.col(f"_before.{out}")).otherwise(F.col(out)).alias(out) for out in outputs],
    )
    return cold.unionByName(hot)
