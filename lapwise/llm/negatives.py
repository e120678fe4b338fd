"""Hard negatives by a vertical scan of columns with shrinking bitmaps (BOND).

A task holds a block of candidates as columns, one per dimension, with each column's least and largest value. An
anchor reads the columns in descending magnitude of its own components and adds up partial scores. What the columns not yet
read can add at least and at most bounds every candidate's score from both sides; after every few columns, candidates
that can no longer be among the wanted are struck from the bitmap, and the rest is read on for
what stands. When all columns are read the scores are exact.

1. Positives: of the anchor's own label, the best few. A candidate goes when the most it can reach is below the
   least that enough others reach.
2. Negatives: of other labels, in one window of scores per positive. A candidate goes when it can reach no
   window, or only windows in which enough others surely stand above it.

Rows are dealt to blocks by hash, whatever their label, so a label of a third of all rows is spread as well. Every block meets
the anchors, a stated set, and hands on the best few of each; ranks are taken over these.

Rows with a null label or id, a null vector, or a component that is null or not finite take no part. Rows that repeat are rows of
their own, told apart by their place in a checkpoint; ties go to the smaller id. Vectors of different lengths
are compared as if the shorter one ended in zeros. An anchor without positives, and a positive without negatives,
gives no rows. Scores beyond a long are the end of its range.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.llm.common import blocks_for
from lapwise.llm.vectors import finite, matrix, width_of
from lapwise.session import durable

CANDIDATES_PER_TASK = 32_768
ANCHORS_PER_TASK = 8_192
_COLUMNS_AT_ONCE = 8
_LONGEST = 2**63 - 1


class Columns:
    """A block of candidates, sorted by label, one array per dimension."""

    def __init__(self, table: pa.Table, width: int, largest: float) -> None:
        labels = table["label"].to_numpy()
        order = np.argsort(labels, kind="stable")
        values = matrix(table["vector"], width)[order]
        # The narrowest type that holds every score and partial sum.
        most = largest * np.abs(values).max(initial=0) * max(width, 1)
        kind = np.float32 if most < 2.0**24 else np.float64 if most < 2.0**53 else object
        self.kind = kind
        self.columns = whole(values, kind).T.copy()
        self.least = self.columns.min(axis=1) if len(values) else np.zeros(width, kind)
        self.largest = self.columns.max(axis=1) if len(values) else np.zeros(width, kind)
        self.labels, self.ids, self.rows = labels[order], table["vec_id"].to_numpy()[order], table["row"].to_numpy()[order]

    def scan(
        self, anchor: np.ndarray, places: np.ndarray, stays: Callable[[np.ndarray, np.ndarray], np.ndarray]
    ) -> tuple[np.ndarray, np.ndarray]:
        """Places that stay to the end, with their exact scores.

        ``stays`` gets the least and most that each score can be and tells which candidates stay.
        """
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = anchor * self.least, anchor * self.largest
        low, high = (np.concatenate([np.cumsum(pick(*ends)[order][::-1])[::-1], [0]]) for pick in (np.minimum, np.maximum))
        partial = np.zeros(len(places), self.kind)
        for at in range(0, len(order), _COLUMNS_AT_ONCE):
            all_there = len(places) == self.columns.shape[1]
            for d in order[at:at + _COLUMNS_AT_ONCE]:
                if anchor[d] != 0:
                    partial = partial + anchor[d] * (self.columns[d] if all_there else self.columns[d][places])
            read = min(at + _COLUMNS_AT_ONCE, len(order))
            stay = stays(partial + low[read], partial + high[read])
            if not stay.all():
                places, partial = places[stay], partial[stay]
            if not len(places):
                break
        return places, partial

    def best(self, places: np.ndarray, scores: np.ndarray, limit: int) -> tuple[np.ndarray, list[int]]:
        """The first ``limit`` by score, then id, then row; scores as whole numbers in the range of a long."""
        exact = [max(-_LONGEST - 1, min(_LONGEST, int(s))) for s in scores]
        first = sorted(range(len(places)), key=lambda i: (-exact[i], self.ids[places[i]], self.rows[places[i]]))[:limit]
        return places[first], [exact[i] for i in first]

    def positives(self, anchor: np.ndarray, label: int, row: int, limit: int) -> tuple[np.ndarray, list[int]]:
        places = np.arange(np.searchsorted(self.labels, label), np.searchsorted(self.labels, label, side="right"))
        places = places[self.rows[places] != row]

        def stays(least: np.ndarray, most: np.ndarray) -> np.ndarray:
            return most >= nth_largest(least, limit) if len(least) > limit else np.ones(len(least), bool)

        return self.best(*self.scan(anchor, places, stays), limit)

    def negatives(
        self, anchor: np.ndarray, label: int, windows: list[tuple[int, int]], limit: int
    ) -> list[tuple[np.ndarray, list[int]]]:
        begin, end = np.searchsorted(self.labels, label), np.searchsorted(self.labels, label, side="right")
        places = np.concatenate([np.arange(begin), np.arange(end, len(self.labels))])

        def stays(least: np.ndarray, most: np.ndarray) -> np.ndarray:
            keep = np.zeros(len(least), bool)
            for low, high in windows:
                sure = least[(least >= low) & (most <= high)]
                floor = max(low, nth_largest(sure, limit)) if len(sure) >= limit else low
                keep |= (most >= floor) & (least <= high)
            return keep

        places, scores = self.scan(anchor, places, stays) if windows else (places[:0], places[:0])
        inside = [(scores >= low) & (scores <= high) for low, high in windows]
        return [self.best(places[i], scores[i], limit) for i in inside]


def whole(values: np.ndarray, kind: type) -> np.ndarray:
    if kind is not object:
        return values.astype(kind)
    return np.vectorize(int, otypes=[object])(values) if values.size else values.astype(object)


def nth_largest(values: np.ndarray, n: int):
    return np.sort(values)[len(values) - n] if values.dtype == object else np.partition(values, len(values) - n)[len(values) - n]


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores s with ``low * score <= 100 * s <= high * score``."""
    return -(-low * score // 100), high * score // 100


def _meet(anchors: DataFrame, rows: DataFrame, task: Callable[[pa.Table, pa.Table], pa.Table], schema: str, sizes: tuple[int, int]) -> DataFrame:
    """Every block of anchors meets every block of rows, a bounded task each."""
    left, right = sizes

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        df = df.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).groupBy("_a", "_c")

    return dealt(anchors, "_a", left, "_c", right).cogroup(dealt(rows, "_c", right, "_a", left)).applyInArrow(task, schema)


def _blocks(asked: pa.Table, there: pa.Table) -> tuple[Columns, np.ndarray]:
    width = width_of(asked["vector"], there["vector"])
    anchors = matrix(asked["vector"], width)
    columns = Columns(there, width, np.abs(anchors).max(initial=0))
    return columns, whole(anchors, columns.kind)


def hard_negatives(
    rows: DataFrame, vec_id: str, vector: str, label: Column, anchors: Column, positives: int = 5, negatives: int = 10,
    low: int = 30, high: int = 90, scale: int = 256, candidates_per_task: int = CANDIDATES_PER_TASK,
    anchors_per_task: int = ANCHORS_PER_TASK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For each row that ``anchors`` picks and each of its first ``positives`` rows of the same label, the first ``negatives``
    rows of other labels whose score is between ``low`` and ``high`` percent of the positive's. Components count
    as ``floor(scale * x)``, scores are their inner products with the anchor.
    """
    parts = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    picked = rows.select(
        F.col(vec_id).alias("vec_id"), label.cast("bigint").alias("label"), F.when(finite(F.col(vector)), parts).alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("asks"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    taken = durable(picked.withColumn("row", F.monotonically_increasing_id()))
    asking = taken.where("asks")
    there, asked = taken.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    sizes = blocks_for(asked, anchors_per_task), blocks_for(there, candidates_per_task)
    rows, asking = taken.drop("asks"), asking.drop("asks")

    def find_positives(asked: pa.Table, block: pa.Table) -> pa.Table:
        columns, vectors = _blocks(asked, block)
        out = []
        for a, own, row in zip(vectors, asked["label"].to_pylist(), asked["row"].to_pylist()):
            places, scores = columns.positives(a, own, row, positives)
            out += zip([row] * len(places), columns.rows[places].tolist(), columns.ids[places].tolist(), scores)
        return table(out, "row", "positive_row", "positive_id", "positive_score")

    found = _meet(asking, rows, find_positives, "row bigint, positive_row bigint, positive_id bigint, positive_score bigint", sizes)
    first = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    found = found.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= positives)
    wanted = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("nth", "positive_id", "positive_score"))).alias("wanted"))
    # Fixed here: the second scan must see the ranks that the result names.
    asking = durable(asking.join(wanted, "row"))

    def find_negatives(asked: pa.Table, block: pa.Table) -> pa.Table:
        columns, vectors = _blocks(asked, block)
        out = []
        each = zip(vectors, asked["label"].to_pylist(), asked["row"].to_pylist(), asked["vec_id"].to_pylist(), asked["wanted"].to_pylist())
        for a, own, row, anchor_id, wanted in each:
            windows = [window(p["positive_score"], low, high) for p in wanted]
            different = sorted({w for w in windows if w[0] <= w[1]})
            by_window = dict(zip(different, columns.negatives(a, own, different, negatives)))
            for p, w in zip(wanted, windows):
                places, scores = by_window.get(w, ((), ()))
                for place, score in zip(places, scores):
                    out.append((
                        row, p["nth"], anchor_id, p["positive_id"], int(columns.ids[place]), int(columns.rows[place]),
                        p["positive_score"], score,
                    ))
        return table(out, "row", "nth", "anchor_id", "positive_id", "negative_id", "negative_row", "positive_score", "negative_score")

    found = _meet(asking, rows, find_negatives, (
        "row bigint, nth bigint, anchor_id bigint, positive_id bigint, negative_id bigint, negative_row bigint, "
        "positive_score bigint, negative_score bigint"
    ), sizes)
    first = Window.partitionBy("row", "nth").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def table(rows: list[tuple], *names: str) -> pa.Table:
    """Whole numbers by column."""
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})
