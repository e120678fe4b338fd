"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.llm.common import compact
from lapwise.session import durable


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a, b)`` but the roots themselves; the root is the smallest node.

    Each round joins every node's neighbours to the smallest of them, once over all neighbours and
    once over the smaller ones, until nothing changes; the rounds grow with the logarithm of the
    longest path. Minimums combine before the shuffle and links only move by join, so a node
    with very many links takes no task of its own. Each step ends in a checkpoint.
    """
    links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rows = links.count()

    def step(found: DataFrame) -> DataFrame:
        return durable(compact(compact(found, rows).distinct(), rows))

    def to_least(around: DataFrame, least: DataFrame) -> DataFrame:
        return around.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))

    now, seen = step(links), None
    while True:
        around = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = compact(around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), rows)
        large = step(to_least(around, least).where("a > b"))
        lower = compact(large.groupBy("a").agg(F.min("b").alias("m")), rows)
        now = step(to_least(large, lower).unionByName(lower.select("a", F.col("m").alias("b"))))
        state = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
