"""A uniform shuffle into shards of exact sizes, with DataFrame functions only.

How many rows go from each partition to each shard is drawn first, as a matrix: the shards' exact
sizes are dealt to the partitions without replacement, so each entry is hypergeometric given those
before it. Partitions are taken in groups of about the square root of their number; one row deals
the shards' sizes to the groups, then every group deals its part to its partitions. Then each
partition permutes its rows where they are and deals them out by its row of the matrix, the
rows are exchanged once, and each shard permutes again: a row's slot is its place in a second
random order, counted in blocks of about ``rows_per_block`` rows. So every order of all rows is as
likely as any other, shards differ by one row at most, and no task takes a whole shard.

Random numbers are hashes of the seed and the row's place in the input, so a lost task gives the same
rows again. The input must be a stored table (or a checkpoint), which keeps rows in place; the
counts are checked against the rows when they are dealt. Equal and null rows are shuffled like
any others; the names of the added columns get underscores where the input has them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.llm.common import ROWS_PER_BLOCK, blocks_for, free_name, running_total, unit, whole_row
from lapwise.session import durable

# Rows of the matrix that may be broadcast: 24 shards times this many are a few MB.
_BROADCAST_PARTITIONS = 20_000
_LOW_BITS = (1 << 33) - 1


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def hypergeometric(u: Column, total: Column, marked: Column, drawn: Column) -> Column:
    """Marked ones among ``drawn`` of ``total``, ``marked`` of them marked, by inversion at ``u`` in [0, 1).

    Weights are built from their ratios, over all values within 12 standard deviations and 12
    of the mean; what lies outside has less probability than a double can tell from 0.
    """
    sizes = {"total": total, "marked": marked, "drawn": drawn}
    given = F.struct(u.alias("u"), *[size.cast("double").alias(name) for name, size in sizes.items()])

    def bounded(g: Column) -> Column:
        part = g["marked"] / F.greatest(g["total"], F.lit(1.0))
        mean = g["drawn"] * part
        spread = F.sqrt(mean * (1 - part) * (g["total"] - g["drawn"]) / F.greatest(g["total"] - 1, F.lit(1.0)))
        reach = 12 * spread + 12
        low = F.greatest(F.lit(0.0), g["drawn"] - g["total"] + g["marked"], F.floor(mean - reach).cast("double"))
        high = F.least(g["drawn"], g["marked"], F.ceil(mean + reach).cast("double"))
        return F.struct(g.alias("g"), F.sequence(low.cast("bigint"), F.greatest(low, high).cast("bigint")).alias("values"))

    def after(g: Column, weight: Column, k: Column) -> Column:
        """The next value's weight; past the highest value it is 0 or not used."""
        others = g["total"] - g["marked"] - g["drawn"]
        next_ = F.try_divide(weight * (g["marked"] - k) * (g["drawn"] - k), (k + 1) * (others + k + 1))
        return F.coalesce(next_, F.lit(0.0)).alias("weight")

    def invert(b: Column) -> Column:
        g = b["g"]
        sums = F.aggregate(
            b["values"], F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("weight")),
            lambda a, k: F.struct(
                (a["sum"] + a["weight"]).alias("sum"),
                after(g, a["weight"], k),
            ),
        )["sum"]
        return _let(sums * g["u"], lambda aim: F.aggregate(
            b["values"],
            F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("weight"), F.element_at(b["values"], 1).alias("at")),
            lambda a, k: F.struct(
                (a["sum"] + a["weight"]).alias("sum"),
                after(g, a["weight"], k),
                F.when(a["sum"] + a["weight"] <= aim, F.least(k + 1, F.element_at(b["values"], -1))).otherwise(a["at"]).alias("at"),
            ),
        )["at"])

    return _let(_let(given, bounded), invert)


def deal(children: Column, capacity: Column, seed: int) -> Column:
    """Deals ``capacity`` (array of sizes) to ``children`` (array of ``id, n``): ``id`` and ``part``, its sizes.

    The children's ``n`` add up to the capacity.
    """

    def one(left: Column, child: Column) -> Column:
        # Of the child's rows, shard by shard: how many come from this shard's size.
        start = F.struct(
            child["n"].alias("rows"), F.aggregate(left, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
            F.expr("cast(array() as array<bigint>)").alias("part"),
        )
        return F.aggregate(
            left, start,
            lambda a, size: _let(
                hypergeometric(unit(F.lit(seed), child["id"], F.size(a["part"])), a["total"], size, a["rows"]),
                lambda got: F.struct(
                    (a["rows"] - got).alias("rows"), (a["total"] - size).alias("total"), F.array_append(a["part"], got).alias("part")
                ),
            ),
            lambda a: a["part"],
        )

    start = F.struct(capacity.alias("left"), F.expr("cast(array() as array<struct<id:bigint,part:array<bigint>>>)").alias("out"))
    return F.aggregate(
        children, start,
        lambda a, child: _let(one(a["left"], child), lambda part: F.struct(
            F.zip_with(a["left"], part, lambda x, y: x - y).alias("left"),
            F.array_append(a["out"], F.struct(child["id"].alias("id"), part.alias("part"))).alias("out"),
        )),
        lambda a: a["out"],
    )


def communication_matrix(counts: DataFrame, shards: int, seed: int) -> tuple[DataFrame, int, int]:
    """``id, n`` (partitions, their rows) to ``id, part``; also the number of partitions and of rows."""
    counts = durable(counts)
    partitions, rows = counts.agg(F.count("id"), F.coalesce(F.sum("n"), F.lit(0))).first()
    width = max(1, int(partitions**0.5))
    capacity = F.array(*[F.lit(rows // shards + (s < rows % shards)).cast("bigint") for s in range(shards)])
    group = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(1, partitions // width)))
    listed = counts.withColumn("group", group).groupBy("group").agg(
        F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("id", "n"))).alias("members")
    )
    top = listed.agg(F.array_sort(F.collect_list(F.struct(F.col("group").alias("id"), "n"))).alias("groups"))
    by_group = top.select(F.explode(deal(F.col("groups"), capacity, seed)).alias("g")).select(
        F.col("g.id").alias("group"), F.col("g.part").alias("sizes")
    )
    matrix = listed.join(by_group, "group").select(F.explode(deal(F.col("members"), F.col("sizes"), seed + 1)).alias("m"))
    return durable(matrix.select("m.id", "m.part")), partitions, rows


def shuffle(docs: DataFrame, shards: int, seed: int = 7, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``docs`` with ``shard`` (from 0) and ``slot`` (from 0, gapless in the shard)."""
    placed = docs.select(whole_row(docs).alias("doc"), F.monotonically_increasing_id().alias("id"))
    placed = placed.withColumn("from", F.shiftrightunsigned("id", 33))
    counts = placed.groupBy(F.col("from").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    matrix, partitions, rows = communication_matrix(counts, shards, seed)
    matrix = matrix.withColumnRenamed("id", "partition")

    # Sorting a partition by a random key permutes it in place; the new ids count its rows.
    local = (
        placed.withColumn("key", F.xxhash64(F.lit(seed + 2), "id")).sortWithinPartitions("key", "id")
        .withColumn("turn", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS)))
    )
    if partitions <= _BROADCAST_PARTITIONS:
        matrix = F.broadcast(matrix)
    ends = F.aggregate(
        "part", F.expr("cast(array() as array<bigint>)"),
        lambda a, x: F.array_append(a, x + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0))),
    )
    dealt = (
        local.join(matrix, F.col("from") == F.col("partition"), "left")
        .withColumn("shard", F.size(F.filter(ends, lambda end: end <= F.col("turn"))))
        .withColumn("shard", F.when(F.col("shard").between(0, shards - 1), F.col("shard")).otherwise(
            F.raise_error(F.lit("rows moved between partitions; shuffle a stored table or a checkpoint"))).cast("int"))
        .select("doc", "id", "shard", unit(F.lit(seed + 3), F.col("id")).alias("place"))
    )
    blocks = blocks_for(-(-rows // shards), rows_per_block)
    return (
        running_total(dealt, ["shard"], "place", ["id"], F.lit(1), "slot", blocks)
        .select("doc.*", F.col("shard").alias(free_name(docs, "shard")), (F.col("slot") - 1).alias(free_name(docs, "slot")))
    )
