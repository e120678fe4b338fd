"""Mixing sources to target weights by weighted fair queueing.

Sources weigh 5, 2, 1, 5, 2, ... by name and share ``share`` times all words; a source takes at
most ``repeat`` times its own words, and what it cannot take goes to the others by weight.

Documents of a source are shuffled, once for each time they may be taken. Each copy gets a virtual
finish time: the source's words up to it, divided by the source's target. All copies are put
in order of finish time and taken until the budget is used up. Both running sums go through stretches
of the order (``common.running_total``), so neither a large source nor the whole order is one task.

The shuffle is by a hash of the key and the turn, so reruns agree; rows with the same key follow by
size and source. A null source is a source of its own, the last. Documents without words,
and null texts, are taken 0 words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.llm.common import ROWS_PER_BLOCK, blocks_for, free_name, running_total, whole_row
from lapwise.session import durable

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEAT = 2


def words(text: Column | str) -> Column:
    """Number of runs of anything but blanks, tabs and line ends."""
    parts = F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.size(F.filter(parts, lambda p: p != "")).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """``source, source_size`` with the words to take from each.

    In order of how soon a source is used up for its weight: one is taken whole if its part of
    what the earlier ones left would be more than it has; from the first that is not, all get the
    same words per weight. One row per source.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_n") - 1) % len(weights) + 1)
    most = repeat * F.col("source_size")
    everything = Window.partitionBy(F.lit(0))
    by_name, sooner = everything.orderBy(F.asc_nulls_last("source")), everything.orderBy("_ratio", "_n")
    earlier = sooner.rowsBetween(Window.unboundedPreceding, -1)
    later = sooner.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = share * F.sum("source_size").over(everything)
    return (
        sizes.withColumn("_n", F.row_number().over(by_name)).withColumn("_weight", weight)
        .withColumn("_ratio", most / F.col("_weight"))
        .withColumn("_level", (budget - F.coalesce(F.sum(most).over(earlier), F.lit(0))) / F.sum("_weight").over(later))
        .withColumn("_open", F.when(F.col("_level") < F.col("_ratio"), F.struct("_ratio", "_n", "_level")))
        .withColumn("_even", F.min("_open").over(everything)["_level"])
        .withColumn("target", F.least(most.cast("double"), F.coalesce(F.col("_even") * F.col("_weight"), most)))
        .select("source", "source_size", "target")
    )


def _turn_place(key: Column, turn: Column) -> Column:
    """A double in [0, 1) from a hash of key and turn."""
    text = F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("null")), turn.cast("string"))
    digits = F.substring(F.md5(text.cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(
    sized: DataFrame, key: str, size: str, source: str, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
    repeat: int = REPEAT, rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """``sized`` with ``source_size``, ``target`` and ``taken`` (words, repeats counted) for each row.

    The three columns get underscores where ``sized`` has them. ``sized`` is kept by a checkpoint.
    """
    keep = durable(sized.select(whole_row(sized).alias("doc"), F.monotonically_increasing_id().alias("row")))
    total, target, taken = (free_name(sized, c) for c in ("source_size", "target", "taken"))
    doc = F.col("doc")
    plain = keep.select("row", doc[key].alias("key"), doc[size].alias("size"), doc[source].alias("source"))
    plan = durable(targets(plain.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeat))
    with_target = plain.join(
        plan.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))
    ).drop("_s")
    turn = F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))).alias("turn")
    copies = (
        with_target.where((F.col("size") > 0) & (F.col("target") > 0))
        .select("*", turn)
        .withColumn("place", (F.col("turn") + _turn_place(F.col("key"), F.col("turn"))) / repeat)
        .withColumn("name", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    )
    blocks = blocks_for(keep.count() * repeat, rows_per_block)
    served = running_total(copies, ["name"], "place", ["key", "size"], F.col("size"), "served", blocks)
    queue = (
        served.withColumn("finish", F.col("served") / F.col("target"))
        # Rising with the finish time and below 1, so that stretches of it can be cut.
        .withColumn("at", F.col("finish") / (1 + F.col("finish")))
        .withColumn("all", F.lit(0))
    )
    ordered = running_total(queue, ["all"], "at", ["finish", "name", "place", "key", "size"], F.col("size"), "used", blocks)
    budget = share * (plan.agg(F.sum("source_size")).first()[0] or 0)
    chosen = (
        ordered.where(F.col("used") <= budget)
        .groupBy("row").agg(F.sum("size").alias("taken"))
    )
    result = (
        with_target.join(chosen, "row", "left")
        .select("row", F.col("source_size").alias(total), F.col("target").alias(target),
                F.coalesce("taken", F.lit(0).cast("bigint")).alias(taken))
    )
    return keep.join(result, "row").select("doc.*", total, target, taken)
