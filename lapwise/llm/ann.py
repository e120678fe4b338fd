"""Approximate nearest neighbours by cosine, with an inverted multi-index.

Vectors are brought to length 1 and cut into two halves. Each half has its own centroids, fitted by
k-means on at most ``sample`` rows; a vector's cell is its pair of nearest centroids. Every row is
indexed, in blocks of rows. A query walks a block's cells in order of the summed distance of the two
centroids, with a heap over the sorted distances of each half, until the cells have given the
share ``visit`` of the block, and scores what they hold by the exact cosine of the original vectors.

Rows are dealt to blocks by hash, so a cell that a third of all vectors share is spread over all blocks.
Equal vectors in a block are one entry with all its rows, scored once; as only the smallest ids
can be among the nearest, an entry keeps ``limit + 1`` of them in play, which loses none.

Null vectors, zero vectors and those with a component that is null or not finite take no part. Vectors of
different lengths are compared as if the shorter one ended in zeros.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.llm.common import unit
from lapwise.llm.vectors import answer, finite, matrix, search, width_of

SAMPLE = 20_000
CENTROIDS = 32
VISIT = 0.6


def fit_half(vectors: np.ndarray, centroids: int, rounds: int = 12) -> np.ndarray:
    """Centroids of ``vectors`` by k-means, begun at evenly spread rows of their order."""
    distinct = np.unique(vectors, axis=0)
    centers = distinct[np.linspace(0, len(distinct) - 1, min(centroids, len(distinct))).astype(int)]
    for _ in range(rounds):
        nearest = distances(vectors, centers).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, vectors)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    return centers


def distances(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances but for the vector's own square."""
    return (centers**2).sum(axis=1) - 2 * vectors @ centers.T


def normed(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows at length 1, and their lengths; components too large or small to square are brought into range first."""
    scale = np.abs(vectors).max(axis=1, initial=0)[:, None]
    scale[scale == 0] = 1
    scaled = vectors / scale
    lengths = np.sqrt((scaled**2).sum(axis=1))
    return scaled / np.where(lengths == 0, 1, lengths)[:, None], lengths * scale[:, 0]


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """Cells in order of summed distance until they hold ``enough`` entries; ``sizes`` of the cells."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    first, second = first[a].tolist(), second[b].tolist()
    a, b, cells, have = a.tolist(), b.tolist(), [], 0
    heap = [(first[0] + second[0], 0, 0)]
    while heap and have < enough:
        _, i, j = heapq.heappop(heap)
        size = sizes[a[i], b[j]]
        if size:
            cells.append((a[i], b[j]))
            have += size
        # Each pair is reached once: along its row, and down only at the row's begin.
        if j + 1 < len(second):
            heapq.heappush(heap, (first[i] + second[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(first):
            heapq.heappush(heap, (first[i + 1] + second[0], i + 1, 0))
    return cells


class Index:
    """A block of vectors by cell."""

    def __init__(self, vectors: np.ndarray, codebooks: tuple[np.ndarray, np.ndarray]) -> None:
        self.codebooks, self.half = codebooks, codebooks[0].shape[1]
        self.vectors, _ = normed(vectors)
        codes = [distances(h, c).argmin(axis=1) for h, c in zip(self.halves(self.vectors), codebooks)]
        shape = tuple(len(c) for c in codebooks)
        cell = codes[0] * shape[1] + codes[1]
        self.entries = np.argsort(cell, kind="stable")
        self.sizes = np.bincount(cell, minlength=shape[0] * shape[1]).reshape(shape)
        self.ends = np.cumsum(self.sizes).reshape(shape)

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vectors[:, :self.half], vectors[:, self.half:]

    def near(self, queries: np.ndarray, enough: int):
        """For each query the places of the entries its cells hold."""
        first, second = (distances(h, c) for h, c in zip(self.halves(queries), self.codebooks))
        for i in range(len(queries)):
            cells = walk(first[i], second[i], self.sizes, enough)
            yield np.concatenate([self.entries[self.ends[c] - self.sizes[c]:self.ends[c]] for c in cells] or [self.entries[:0]])


def nearest(
    rows: DataFrame, vec_id: str, vector: str, queries: Column, limit: int, centroids: int = CENTROIDS,
    visit: float = VISIT, sample: int = SAMPLE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: about the ``limit`` rows of largest cosine for each query."""
    vectors = F.transform(F.col(vector), lambda x: x.cast("double"))
    taken = rows.where(finite(F.col(vector)) & F.exists(F.col(vector), lambda x: x != 0)).select(
        F.col(vec_id).alias("vec_id"), vectors.alias("vector")
    )
    there = taken.count()
    chosen = taken.where(unit(F.xxhash64("vec_id", "vector"), "index sample") < sample / max(there, 1)) if there > sample else taken
    fitted = chosen.select("vector").orderBy(F.xxhash64("vector")).limit(sample).toArrow()["vector"]
    width = max(width_of(fitted), 2) if there else 2
    points, _ = normed(matrix(fitted, width)) if there else (np.zeros((1, width)), None)
    half = width // 2
    codebooks = fit_half(points[:, :half], centroids), fit_half(points[:, half:], centroids)

    def task(asked: pa.Table, block: pa.Table) -> pa.Table:
        if not len(asked) or not len(block):
            empty = np.zeros(0, np.int64)
            return answer(empty, empty, empty, np.zeros(0))
        span = max(width, width_of(asked["vector"], block["vector"]))
        wide = codebooks[0], np.pad(codebooks[1], ((0, 0), (0, span - width)))
        ids, rows_ = block["vec_id"].to_numpy(), block["row"].to_numpy()
        order = np.lexsort([rows_, ids])
        ids, rows_ = ids[order], rows_[order]
        entries, entry = np.unique(matrix(block["vector"], span)[order], axis=0, return_inverse=True)
        members = np.argsort(entry.reshape(-1), kind="stable")
        counts = np.bincount(entry.reshape(-1))
        ends = np.cumsum(counts)
        index = Index(entries, wide)
        points, asking, names = matrix(asked["vector"], span), asked["row"].to_numpy(), asked["vec_id"].to_numpy()
        units, _ = normed(points)
        out = [[], [], [], []]
        for q, places in enumerate(index.near(units, max(int(visit * len(entries)), 10 * limit))):
            # Row by row, so that equal vectors have equal scores.
            scores = (index.vectors[places] * units[q]).sum(axis=1)
            if len(places) > limit + 1:
                keep = scores >= np.partition(scores, len(scores) - limit - 1)[len(scores) - limit - 1]
                places, scores = places[keep], scores[keep]
            found = [(members[ends[p] - counts[p]:ends[p]][:limit + 1], s) for p, s in zip(places, scores)]
            at = np.concatenate([m for m, _ in found])
            score = np.repeat([s for _, s in found], [len(m) for m, _ in found])
            other = rows_[at] != asking[q]
            at, score = at[other], score[other]
            best = np.lexsort([ids[at], -score])[:limit]
            out[0].append(np.full(len(best), asking[q]))
            out[1].append(np.full(len(best), names[q]))
            out[2].append(ids[at[best]])
            out[3].append(score[best])
        return answer(*[np.concatenate(part) for part in out])

    return search(taken, queries, task, "double", limit)
