"""Gapless numbers over a whole table, without a task that sees all of it.

Rows are sorted across tasks by ranges, each task numbers its own, and one small row per task says how many come before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.session import durable

ROWS_PER_RANGE = 1_000_000
MOST_RANGES = 10_000


def number_as_sorted(df: DataFrame, out: str, after: int = 0) -> DataFrame:
    """Adds ``out``: ``after + 1``, ``after + 2``, … in the order that ``df`` is sorted in.

    The rows are written once, so that counting and numbering see the same partitions.
    """
    # The place in a partition fills the lowest 33 bits, the partition the others.
    placed = durable(df.withColumn(out, F.monotonically_increasing_id()))
    part = F.shiftright(out, 33)
    sizes = sorted(placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, starts = after, {}
    for p, n in sizes:
        starts[p], before = before, before + n
    known = F.array(*[F.lit(starts.get(p, 0)).cast("bigint") for p in range(max(starts, default=0) + 1)])
    return placed.withColumn(out, F.get(known, part.cast("int")) + F.col(out).bitwiseAND((1 << 33) - 1) + 1)


def dense_numbers(
    df: DataFrame, order: list[Column | str], out: str, after: int = 0, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Adds ``out``: ``after + 1``, ``after + 2``, … in ``order``, without a gap.

    The same on every run if ``order`` tells all rows apart.
    """
    ranges = min(MOST_RANGES, max(1, -(-df.count() // rows_per_range)))
    sorted_ = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return number_as_sorted(sorted_, out, after)
