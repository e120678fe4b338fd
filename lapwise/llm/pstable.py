"""Near-duplicate embeddings by Euclidean p-stable hashing, then exact cosines.

Vectors are brought to length 1, where a cosine is a distance. A table hashes a vector by ``cells`` random
projections, each cut into cells of width ``WIDTH`` from a random offset; vectors of one label with equal cells share a bucket.
How likely two vectors share a cell follows from their distance alone, so the number of cells is chosen to leave
a vector ``STRANGERS`` chance companions (at a right angle) in a table among the rows of the largest label, and the number
of tables to miss a pair at the threshold in all of them with a chance of at most ``MISS``.

Equal vectors of a label are one class, told by 128 bits of hash. A bucket of many classes is cut into blocks, and every
pair of blocks is a unit of work of bounded size; units are dealt to tasks by hash. A unit computes all its cosines in one
matrix product, in double precision, and keeps those at the threshold or above. A pair is counted in the first table whose bucket
it shares, and nowhere else, so numbers of links add up without any list of pairs: a unit hands on, per class, how many
rows it links to, and one edge to the smallest member of the class's linked set. Components follow from these edges by stars.

Vectors that are null, zero or hold null or non-finite components, and rows without label or id, link with nothing; a row
without an id has no component. Rows that repeat are rows of their own, linked with each other. Vectors of different
lengths are compared as if the shorter one ended in zeros. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.llm.ann import normed
from lapwise.llm.common import blocks_for
from lapwise.llm.graph import components
from lapwise.llm.vectors import finite, matrix, width_of
from lapwise.session import durable

WIDTH = 2.0
STRANGERS = 0.1
MISS = 1e-6
CLASSES_PER_BLOCK = 1024
ROWS_PER_TASK = 4_096
_HASHES_AT_ONCE = 1 << 19
_SEED = 12


def shared_cell(distance: float, width: float = WIDTH) -> float:
    """Chance that two points at ``distance`` fall into one cell of a random projection."""
    if distance == 0:
        return 1.0
    r = width / distance
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def tables_for(classes: int, cosine: float) -> tuple[int, int]:
    """Number of cells in a table's hash, and of tables."""
    near, strange = shared_cell(math.sqrt(max(0.0, 2 - 2 * cosine))), shared_cell(math.sqrt(2))
    cells = max(2, math.ceil(math.log(STRANGERS / max(classes, 1)) / math.log(strange)))
    found = near**cells
    return cells, 1 if found >= 1 else math.ceil(math.log(MISS) / math.log(1 - found))


def buckets(vectors: np.ndarray, labels: np.ndarray, cells: int, tables: int) -> np.ndarray:
    """One 64-bit hash of label and cells per vector (at length 1) and table."""
    # A row of projections per dimension, so that a shorter vector meets the same ones.
    dice = [np.random.default_rng([_SEED, d]) for d in range(vectors.shape[1])]
    directions = np.array([d.normal(size=tables * cells) for d in dice]).reshape(-1, tables * cells)
    mixer = np.random.default_rng(_SEED)
    offsets = mixer.random(tables * cells) * WIDTH
    odd = mixer.integers(0, 2**63, tables * cells, np.int64) * 2 + 1
    by_label = mixer.integers(0, 2**63, tables, np.int64) * 2 + 1
    places = np.floor((vectors @ directions + offsets) / WIDTH).astype(np.int64) * odd
    return places.reshape(-1, tables, cells).sum(axis=2) + labels[:, None] * by_label


def _hash_classes(batches: Iterator[pa.RecordBatch], cells: int, tables: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        batch = pa.Table.from_batches([batch])
        vectors, labels = matrix(batch["vector"], width_of(batch["vector"])), batch["label"].to_numpy()
        at_once = max(1, _HASHES_AT_ONCE // (cells * tables))
        units = normed(vectors)[0]
        hashes = np.concatenate([np.zeros((0, tables), np.int64), *[
            buckets(units[at:at + at_once], labels[at:at + at_once], cells, tables) for at in range(0, len(units), at_once)
        ]])
        offsets = pa.array(np.arange(len(hashes) + 1, dtype=np.int32) * tables)
        codes = pa.ListArray.from_arrays(offsets, pa.array(hashes.ravel()))
        yield from batch.append_column("codes", codes).to_batches()


def linked_sets(links: np.ndarray) -> np.ndarray:
    """The smallest place reachable from each place, by a matrix of links."""
    root = np.full(len(links), -1)
    for start in range(len(links)):
        if root[start] < 0:
            root[start], ahead = start, [start]
            while ahead:
                fresh = np.flatnonzero(links[ahead.pop()] & (root < 0))
                root[fresh] = start
                ahead += fresh.tolist()
    return root


def compare(unit: dict[str, np.ndarray], within: bool, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """For each class of a unit how many rows it links to, and the first place of its linked set.

    ``unit`` holds ``vector`` (at length 1), ``label, codes, size, side`` and the number of the ``table``; pairs are those of
    both sides, or within the one side.
    """
    side = unit["side"]
    near = unit["vector"] @ unit["vector"].T >= cosine
    near &= unit["label"][:, None] == unit["label"]
    near &= np.triu(np.ones(near.shape, bool), 1) if within else (side[:, None] < side)
    a, b = np.nonzero(near)
    codes, known = unit["codes"], np.zeros(len(a), bool)
    for earlier in range(unit["table"]):
        known |= codes[a, earlier] == codes[b, earlier]
    a, b = a[~known], b[~known]
    links = np.zeros(near.shape, bool)
    links[a, b] = links[b, a] = True
    # Sums of whole numbers: exact in doubles.
    size = unit["size"]
    total = np.bincount(a, size[b], len(side)) + np.bincount(b, size[a], len(side))
    return total.astype(np.int64), linked_sets(links)


def _compare_units(group: pa.Table, cosine: float) -> pa.Table:
    group = group.sort_by([("nth", "ascending"), ("code", "ascending"), ("low", "ascending"), ("high", "ascending"), ("class", "ascending")])
    keys = [group[c].to_numpy() for c in ("nth", "code", "low", "high")]
    changes = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
    names, sizes, labels = (group[c].to_numpy() for c in ("class", "size", "label"))
    vectors, _ = normed(matrix(group["vector"], width_of(group["vector"])))
    codes = matrix(group["codes"], width_of(group["codes"]))
    block = group["block"].to_numpy()
    out: list[list[np.ndarray]] = [[], [], []]
    for begin, end in zip([0, *changes.tolist()], [*changes.tolist(), len(group)]):
        if end - begin < 2:
            continue
        low, high = keys[2][begin], keys[3][begin]
        rows = slice(begin, end)
        unit = {
            "vector": vectors[rows], "label": labels[rows], "codes": codes[rows], "size": sizes[rows],
            "side": (block[rows] != low).astype(int), "table": int(keys[0][begin]),
        }
        total, root = compare(unit, low == high, cosine)
        there = np.flatnonzero(total)
        for column, part in zip(out, (names[rows][there], total[there], names[rows][root[there]])):
            column.append(part)
    parts = [np.concatenate(column) if column else np.zeros(0, np.int64) for column in out]
    return pa.table(dict(zip(("class", "links", "root"), parts)))


def near_vectors(
    rows: DataFrame, vec_id: str, vector: str, label: Column, cosine: float = 0.98,
    classes_per_block: int = CLASSES_PER_BLOCK, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``vec_id, n_links, component_id``: for every row, other rows of its label linked directly, and the smallest id reachable."""
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    fits = finite(F.col(vector)) & F.exists(F.col(vector), lambda x: x != 0) & label.isNotNull() & F.col(vec_id).isNotNull()
    each = rows.select(
        F.col(vec_id).alias("vec_id"), label.cast("bigint").alias("label"), F.when(fits, doubles).alias("vector")
    ).withColumns({"first": F.xxhash64("label", "vector"), "second": F.xxhash64("vector", F.lit(_SEED), "label")})
    able = each.where("vector IS NOT NULL").groupBy("first", "second").agg(
        F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("least"), F.any_value("label").alias("label"),
        F.any_value("vector").alias("vector"),
    )
    # Classes are numbered by their place in a checkpoint.
    classes = durable(able.withColumn("class", F.monotonically_increasing_id()))
    most = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    cells, tables = tables_for(most, cosine)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _hash_classes(batches, cells, tables)

    known = classes.select("class", "label", "size", "vector")
    known = durable(known.mapInArrow(hashed, "class bigint, label bigint, size bigint, vector array<double>, codes array<bigint>"))
    placed = known.select("class", F.posexplode("codes").alias("nth", "code"))
    crowded = placed.groupBy("nth", "code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / classes_per_block).cast("int")
    members = placed.join(crowded, ["nth", "code"]).withColumn("block", F.pmod(F.xxhash64("class", "nth"), blocks).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "class", "nth", "code", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    members = durable(members)
    tasks = blocks_for(members.count(), rows_per_task)
    task = F.pmod(F.xxhash64("nth", "code", "low", "high"), F.lit(tasks))

    def compared(group: pa.Table) -> pa.Table:
        return _compare_units(group, cosine)

    found = durable(
        members.join(known, "class").groupBy(task.alias("task")).applyInArrow(compared, "class bigint, links bigint, root bigint")
    )
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")).where("a <> b"))
    joined = links.join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
    joined = joined.withColumn("root", F.coalesce("root", "class"))
    # Linked classes and classes of several rows; every other row stands alone.
    sets = classes.select("class", "first", "second", "size", "least").join(joined, "class", "left").where(
        "links IS NOT NULL OR size > 1"
    ).withColumn("root", F.coalesce("root", "class"))
    least = sets.groupBy("root").agg(F.min("least").alias("component_id"))
    told = sets.join(least, "root").select("first", "second", "component_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    each = each.select("vec_id", *[F.when(F.col("vector").isNotNull(), F.col(c)).alias(c) for c in ("first", "second")])
    return each.join(told, ["first", "second"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
