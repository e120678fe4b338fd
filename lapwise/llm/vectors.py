"""Blocks of vectors: every block of queries meets every block of candidates, a bounded task each."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.llm.common import blocks_for
from lapwise.session import durable

CANDIDATES_PER_TASK = 8_192
QUERIES_PER_TASK = 16_384


def finite(vector: Column) -> Column:
    """Whether a vector is neither null nor holds a null, a NaN or an infinity."""
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))), F.lit(False)
    )


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of numbers; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return values.reshape(-1, width)
    rows = np.zeros((len(lengths), width), values.dtype)
    rows[np.arange(width) < lengths[:, None]] = values
    return rows


def width_of(*columns: pa.ChunkedArray) -> int:
    return max((pc.max(pc.list_value_length(c)).as_py() or 0) for c in columns)


def search(
    rows: DataFrame, queries: Column, task: Callable[[pa.Table, pa.Table], pa.Table], score: str, limit: int,
    candidates_per_task: int = CANDIDATES_PER_TASK, queries_per_task: int = QUERIES_PER_TASK,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the best ``limit`` rows of each query but itself.

    ``rows`` hold ``vec_id, vector``; ``task`` gets a block of queries and one of candidates (``row, vec_id,
    vector``) and returns ``query, query_id, vec_id, score`` with at least the block's best ``limit`` per
    query. Rows are told apart by their place in a checkpoint, so repeated ids are rows of their own.
    A query's blocks each add ``limit`` rows to one ranking. Rows without an id take no part.
    """
    rows = durable(rows.where(F.col("vec_id").isNotNull()).withColumn("row", F.monotonically_increasing_id()))
    asked = rows.where(queries)
    there, asking = rows.count(), asked.count()
    right, left = blocks_for(there, candidates_per_task), blocks_for(asking, queries_per_task)

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        ).groupBy("_q", "_c")

    found = (
        dealt(asked, "_q", left, "_c", right)
        .cogroup(dealt(rows, "_c", right, "_q", left))
        .applyInArrow(task, f"query bigint, query_id bigint, vec_id bigint, score {score}")
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)
        .select("query_id", "rank", "vec_id", "score")
    )


def answer(query: np.ndarray, query_id: np.ndarray, vec_id: np.ndarray, score: np.ndarray) -> pa.Table:
    return pa.table({"query": query, "query_id": query_id, "vec_id": vec_id, "score": score})
