"""Exact top-k by inner product, with the threshold algorithm over sorted lists.

A task holds a block of candidates, sorted once by every dimension. A query reads each dimension's list
from its best end: from the top where its component is positive, from the bottom where it is negative.
What has been met in any list is scored in full. The bound is the score of a candidate that had, in
every dimension, the value the list stands at; a query stops as soon as its k-th best is above the bound.
(At the bound it goes on: a candidate of equal score with a smaller id may follow.)

Queries of a block read on together, to growing depths, and share the scoring of what they meet, so a
round is two matrix products. A query may then see more than its own lists showed, which can only
stop it sooner. In spaces of many dimensions the bound falls slowly and nearly everything is
met before it stops; the result is exact all the same.

Components are whole numbers. Scores that a double holds exactly are computed as doubles, larger
ones as whole numbers; beyond a long, the score is the end of its range. Vectors of different lengths are compared as if the shorter one ended in zeros.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.llm.vectors import answer, finite, matrix, search, width_of

_QUERIES_AT_ONCE = 256
_FIRST_DEPTH = 32


def quantised(vector: Column, scale: int = 64) -> Column:
    """``floor(scale * x)`` of each component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def _exact(values: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the narrowest type that holds every score."""
    most = max(np.abs(values).max(initial=0), 1) * max(np.abs(other).max(initial=0), 1) * max(values.shape[1], 1)
    if most < 2.0**53:
        return values, other
    if most < 2.0**62:
        return values.astype(np.int64), other.astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return whole(values) if values.size else values, whole(other) if other.size else other


def threshold_top(queries: np.ndarray, vectors: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> list[np.ndarray]:
    """Places of each query's best ``k`` vectors (and maybe more), ``own`` place left out (-1: none).

    ``ids`` settle ties, smaller first.
    """
    n, dims = vectors.shape
    order = np.argsort(vectors, axis=0, kind="stable") if dims else np.zeros((n, 0), np.int64)
    lists = np.take_along_axis(vectors, order, axis=0)
    results = []
    for at in range(0, len(queries), _QUERIES_AT_ONCE):
        block = queries[at:at + _QUERIES_AT_ONCE]
        positive, negative = np.maximum(block, 0), np.minimum(block, 0)
        best: list = [None] * len(block)
        active, met = np.arange(len(block)), np.zeros(n, bool)
        places, scores = np.zeros(0, np.int64), np.zeros((len(block), 0), block.dtype)
        depth = 0
        while len(active):
            deeper = min(n, max(_FIRST_DEPTH, 4 * depth)) if dims else n
            up = (block[active] > 0).any(axis=0)
            down = (block[active] < 0).any(axis=0)
            fresh = np.zeros(n, bool)
            fresh[order[n - deeper:n - depth][:, up].ravel()] = True
            fresh[order[depth:deeper][:, down].ravel()] = True
            if deeper == n:
                fresh[:] = True
            fresh = np.flatnonzero(fresh & ~met)
            met[fresh] = True
            more = np.zeros((len(block), len(fresh)), block.dtype)
            more[active] = block[active] @ vectors[fresh].T
            places, scores = np.concatenate([places, fresh]), np.concatenate([scores, more], axis=1)
            depth = deeper
            if depth < n:
                bound = positive[active] @ lists[n - depth] + negative[active] @ lists[depth - 1]
            going = []
            for i, q in enumerate(active.tolist()):
                row = scores[q]
                fits = places != own[at + q]
                enough = np.count_nonzero(fits) >= k
                if depth < n and not enough:
                    going.append(q)
                    continue
                row, there = row[fits], places[fits]
                if len(row) > k and row.dtype != object:
                    least = np.partition(row, len(row) - k)[len(row) - k]
                    if depth < n and least <= bound[i]:
                        going.append(q)
                        continue
                    top = np.flatnonzero(row >= least)
                else:
                    top = np.arange(len(row))
                    if depth < n and np.sort(row)[max(0, len(row) - k)] <= bound[i]:
                        going.append(q)
                        continue
                chosen = np.lexsort([ids[there[top]], -row[top]])[:k] if row.dtype != object else np.array(
                    sorted(range(len(top)), key=lambda x: (-row[top[x]], ids[there[top[x]]]))[:k], np.int64)
                best[q] = np.stack([there[top[chosen]].astype(object), row[top[chosen]]], axis=1)
            active = np.array(going, np.int64)
        results += best
    return results


def top_k(rows: DataFrame, vec_id: str, vector: str, queries: Column, k: int, scale: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` largest inner products among the other rows."""

    def task(asked: pa.Table, there: pa.Table) -> pa.Table:
        width = width_of(asked["vector"], there["vector"])
        q, v = _exact(matrix(asked["vector"], width), matrix(there["vector"], width))
        rows, ids = there["row"].to_numpy(), there["vec_id"].to_numpy(zero_copy_only=False)
        asking, names = asked["row"].to_numpy(), asked["vec_id"].to_numpy(zero_copy_only=False)
        by_row = np.argsort(rows)
        at = np.minimum(np.searchsorted(rows, asking, sorter=by_row), len(rows) - 1) if len(rows) else asking
        own = np.where(rows[by_row[at]] == asking, by_row[at], -1) if len(rows) else asking
        best = threshold_top(q, v, own, ids, k) if len(rows) else [np.zeros((0, 2), object)] * len(q)
        sizes = [len(b) for b in best]
        all_best = np.concatenate(best) if best else np.zeros((0, 2), object)
        return answer(
            np.repeat(asking, sizes), np.repeat(names, sizes), ids[all_best[:, 0].astype(np.int64)],
            np.clip(all_best[:, 1], -(2**63), 2**63 - 1).astype(np.int64),
        )

    taken = rows.where(finite(F.col(vector))).select(F.col(vec_id).alias("vec_id"), quantised(F.col(vector), scale).alias("vector"))
    return search(taken, queries, task, "bigint", k)
