"""Near-duplicate documents by MinHash bands and sequential Bayesian verification.

1. Every text becomes its set of word shingles, kept as 64-bit hashes. Texts with the same set are one
   class; a class is looked at once, whatever its number of documents.
2. A class has ``BANDS`` bands of minimum hashes, as many rows in each as keep the chance that
   a pair at the threshold shares no band below ``BAND_MISS``. Classes with a band in common are
   candidates. A task compares their signatures (one byte per hash) batch by batch. After each batch
   the posterior of the similarity (uniform prior) says how likely the pair reaches the threshold;
   below ``MISS`` it is dropped. Classes joined by pairs that stay form a region: no link leaves it.
3. A task takes regions, compares their pairs in the same way, and verifies what stays on the whole sets.
4. In both steps a pair of classes joined already is skipped, and only what joins two groups is
   returned, so no step writes all pairs. A band or region above ``part`` classes is cut into parts. Every
   part meets the first one; classes that are then outside the largest group meet all
   parts. So every pair of different groups is compared, while a group of any size costs a few
   passes and never one task.

A text without words links with nothing; one with fewer words than a shingle has is one shingle. Letters
A to Z count as lower case. Null and repeated keys and equal rows are allowed: rows are told
apart by their place in a checkpoint. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.llm.common import blocks_for, compact
from lapwise.llm.graph import components
from lapwise.session import durable

BANDS = 30
BAND_MISS = 1e-6
MISS = 1e-6
BATCH = 20
PART = 500  # classes whose texts a task takes
BAND_PART = 10_000  # classes whose signatures a task takes
_ODD = np.uint64(0x9E3779B97F4A7C15)
_WORDS_KEPT = 100_000


class _Words(dict):
    """Hashes of words, kept for when they come again."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of ``width`` words."""
    words = text.lower().split()
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    if not len(hashes):
        return hashes
    size = min(width, len(hashes))
    joined = np.full(len(hashes) - size + 1, size, np.uint64)
    for i in range(size):
        joined = _mixed(joined ^ hashes[i:len(hashes) - size + 1 + i])
    return np.unique(joined)


def rows_per_band(percent: int) -> int:
    rows = 1
    while (1 - (percent / 100) ** (rows + 1)) ** BANDS <= BAND_MISS:
        rows += 1
    return rows


@lru_cache(maxsize=4)
def _multipliers(hashes: int) -> np.ndarray:
    return np.random.default_rng(20240301).integers(0, 1 << 63, (hashes, 1), np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingle_set: np.ndarray, hashes: int) -> np.ndarray:
    """Minimum of each hash over a set that is not empty."""
    least = None
    for at in range(0, len(shingle_set), 1024):
        part = (_multipliers(hashes) * shingle_set[at:at + 1024]).min(axis=1)
        least = part if least is None else np.minimum(least, part)
    return least


def _bands(minimums: np.ndarray) -> np.ndarray:
    rows = minimums.reshape(BANDS, -1)
    joined = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(rows.shape[1]):
        joined = _mixed(joined ^ rows[:, i])
    return joined.view(np.int64)


def profile(text: Column, width: int, percent: int) -> Column:
    """``struct<n, high, low, bands, brief>``: size of the set, its 128-bit hash in two parts, bands and signature."""
    hashes = BANDS * rows_per_band(percent)

    @F.arrow_udf("struct<n:bigint,high:bigint,low:bigint,bands:array<bigint>,brief:binary>")
    def profiled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([(c, pa.int64()) for c in ("n", "high", "low")] + [("bands", pa.list_(pa.int64())), ("brief", pa.binary())])
        for batch in batches:
            rows = []
            for value in batch:
                found = shingles(value.as_buffer().to_pybytes() if value.is_valid else b"", width)
                high, low = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64).tolist()
                bands = brief = None
                if len(found):
                    minimums = signature(found, hashes)
                    bands, brief = _bands(minimums), (_mixed(minimums) >> np.uint64(56)).astype(np.uint8).tobytes()
                rows.append({"n": len(found), "high": high, "low": low, "bands": bands, "brief": brief})
            yield pa.array(rows, kind)

    return profiled(text)


@lru_cache(maxsize=8)
def least_matches(percent: int, hashes: int, miss: float = MISS) -> tuple[tuple[int, int], ...]:
    """After so many hashes, the matches below which the similarity is out of reach.

    With a uniform prior and m matches of n the chance of a similarity of t or more is that of at most
    m successes in n + 1 trials of chance t.
    """
    t, table = percent / 100, []
    for n in range(BATCH, hashes + 1, BATCH):
        chance, m = 0.0, -1
        while chance < miss:
            m += 1
            chance += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        table.append((n, m))
    return tuple(table)


def join_groups(
    signatures: np.ndarray, labels: np.ndarray, mine: np.ndarray, percent: int, sets: list[np.ndarray] | None = None
) -> list[tuple[int, int]]:
    """Places of pairs that join different ``labels``; pairs without one of ``mine`` are left out.

    A pair joins if its signatures do not rule the threshold out and, where ``sets`` are given, they reach it.
    """
    steps = least_matches(percent, signatures.shape[1])
    sizes = np.array([len(s) for s in sets]) if sets else np.ones(len(labels), np.int64)
    links = []
    for i in range(len(labels) - 1):
        fits = (labels[i + 1:] != labels[i]) & (mine[i + 1:] | mine[i])
        fits &= 100 * np.minimum(sizes[i + 1:], sizes[i]) >= percent * np.maximum(sizes[i + 1:], sizes[i])
        rest = np.flatnonzero(fits) + i + 1
        matches = np.zeros(len(rest), np.int64)
        for n, least in steps:
            if not len(rest):
                break
            matches += (signatures[rest, n - BATCH:n] == signatures[i, n - BATCH:n]).sum(axis=1)
            rest, matches = rest[matches >= least], matches[matches >= least]
        for j in rest.tolist():
            if labels[i] == labels[j]:
                continue
            if sets:
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * common < percent * (sizes[i] + sizes[j] - common):
                    continue
            links.append((i, j))
            labels[labels == labels[j]] = labels[i]
    return links


def _in_tasks(tasks: DataFrame, rows: int, part: int, width: int, percent: int, verify: bool) -> DataFrame:
    """Links ``a, b`` that join classes of a task; several tasks share a group of about ``part`` rows.

    ``tasks`` hold, in about ``rows`` rows, ``task`` (array), ``node, label, mine, data``: texts to verify, or signatures.
    """
    hashes = BANDS * rows_per_band(percent)

    def linked(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        task = np.unique(table["task"].to_numpy(), return_inverse=True)[1].reshape(-1)
        order = np.argsort(task, kind="stable")
        table = table.take(pa.array(order))
        nodes, label = table["node"].to_numpy(), table["label"].to_numpy()
        mine = table["mine"].to_numpy(zero_copy_only=False)
        data = table["data"].to_pylist()
        borders = np.flatnonzero(np.diff(task[order])) + 1
        found = []
        for begin, end in zip([0, *borders], [*borders, len(task)]):
            if end - begin < 2:
                continue
            sets = [shingles(d, width) for d in data[begin:end]] if verify else None
            signatures = np.stack(
                [signature(s, hashes) for s in sets] if verify else [np.frombuffer(d, np.uint8) for d in data[begin:end]]
            )
            labels = np.unique(label[begin:end], return_inverse=True)[1].reshape(-1)
            found += [(nodes[begin + i], nodes[begin + j]) for i, j in join_groups(signatures, labels, mine[begin:end], percent, sets)]
        return pa.table({"a": pa.array([int(a) for a, _ in found], pa.int64()), "b": pa.array([int(b) for _, b in found], pa.int64())})

    groups = blocks_for(rows, part)
    return (
        tasks.select(F.xxhash64("task").alias("task"), "node", "label", "mine", "data")
        .groupBy(F.pmod("task", F.lit(groups)).alias("group")).applyInArrow(linked, "a bigint, b bigint").coalesce(groups)
    )


def _links(members: DataFrame, part: int, width: int, percent: int, verify: bool) -> DataFrame:
    """Pairs ``a, b`` that join the classes of each region as all pairs that fit would; ``members``: ``region, node, data``."""
    sizes = durable(
        members.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        .withColumn("parts", F.ceil(F.col("size") / part).cast("int"))
    )
    # The first part of a region is in every task: twice as many rows at most.
    rows, most = sizes.agg(F.coalesce(F.sum(F.when(F.col("parts") > 1, 2 * F.col("size")).otherwise(F.col("size"))), F.lit(0)),
                           F.coalesce(F.max("parts"), F.lit(1))).first()
    placed = (
        members.join(sizes.drop("size"), "region")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("label", F.col("node"))
    )
    # The first part of a region meets every part.
    meets = F.when(F.col("own") == 0, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("own"))
    first = placed.select("*", F.explode(meets).alias("other")).select(
        F.array("region", "other").alias("task"), "node", "label", (F.col("own") == F.col("other")).alias("mine"), "data"
    )
    links = durable(_in_tasks(first, rows, part, width, percent, verify))
    if most == 1:
        return links
    large = placed.where("parts > 1")
    groups = components(links)
    labelled = large.join(groups, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")
    counts = labelled.groupBy("region", "label").count()
    main = counts.groupBy("region").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
    rest = labelled.join(main, "region").withColumn("outside", F.col("label") != F.col("main"))
    turns = durable(rest.where("outside").groupBy("region", "parts").agg(F.count(F.lit(1)).alias("left")))
    turns = turns.withColumn("turns", F.ceil(F.col("left") / part).cast("int"))
    # Each class outside meets every part, and every part each turn.
    rows = turns.agg(F.coalesce(F.sum((F.col("left") + F.col("turns") * part) * F.col("parts")), F.lit(0))).first()[0]
    turns = turns.select("region", "turns")
    rest = rest.join(turns, "region").withColumn("turn", F.pmod(F.xxhash64("node", F.lit(1)), F.col("turns")).cast("int"))
    asking = rest.where("outside").select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        F.array("region", "turn", "other").alias("task"), "node", "label", F.lit(True).alias("mine"), "data"
    )
    asked = rest.drop("turn").select("*", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn")).select(
        F.array("region", "turn", "own").alias("task"), "node", "label", F.lit(False).alias("mine"), "data"
    )
    return links.unionByName(durable(_in_tasks(asking.unionByName(asked), rows, part, width, percent, verify)))


def near_duplicates(
    docs: DataFrame, text: str, key: str, width: int = 5, percent: int = 80, part: int = PART, band_part: int = BAND_PART
) -> DataFrame:
    """One row per document: ``key, text_hash, n_shingles, component_id, kept``.

    ``component_id`` is the smallest key among the documents reached over links, the document's own
    included. ``kept`` marks one row of each component: one with that key, and of several the first.
    ``text_hash`` (``xxhash64``) tells rows with the same key and other texts apart.
    Linked are documents with ``100 * common >= percent * united`` shingles of ``width`` words.
    """
    rows = durable(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("text_hash"),
                    profile(F.col(text), width, percent).alias("p"))
        .select("row", "key", "text_hash", "p.*")
    )
    filled = rows.where("n > 0")
    classes = filled.groupBy("high", "low").agg(F.min("row").alias("node"), F.min("key").alias("least"))
    classes = durable(compact(classes, rows.count()))
    one = durable(filled.select(F.col("row").alias("node"), "key", "text_hash", "bands", "brief").join(
        classes.select("node"), "node", "left_semi"
    ))
    banded = one.select("node", F.explode("bands").alias("region"))
    shared = banded.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("region")
    candidates = banded.join(shared, "region").join(one.select("node", F.col("brief").alias("data")), "node")
    regions = components(_links(durable(candidates), band_part, width, percent, False))
    regions = durable(regions.unionByName(regions.select(F.col("root").alias("node"), "root").distinct()))

    # A key may be repeated with another text; the hash of the text tells which was meant.
    name = F.coalesce(F.col("key").cast("string"), F.lit("")).alias("name")
    wanted = one.join(regions, "node").select(F.col("root").alias("region"), "node", name, "text_hash")
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).select(
        name, F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("data")
    )
    members = durable(source.join(wanted, ["name", "text_hash"]).select("region", "node", "data").dropDuplicates(["node"]))
    groups = components(_links(members, part, width, percent, True))

    class_root = classes.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = class_root.groupBy("root").agg(F.min("least").alias("component_id"))
    component = class_root.join(least, "root").select("high", "low", "root", "component_id")
    joined = rows.drop("bands", "brief").join(component, ["high", "low"], "left")
    own = F.col("n") == 0
    result = durable(joined.select(
        "row", "key", "text_hash", F.col("n").alias("n_shingles"),
        F.when(own, F.col("key")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(own, F.col("row")).otherwise(F.col("root")).alias("root"),
    ))
    first = result.where(F.col("key").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("row").alias("row"))
    return (
        result.join(first.select("row", F.lit(True).alias("first")), "row", "left")
        .select(F.col("key").alias(key), "text_hash", "n_shingles", "component_id", F.coalesce("first", F.lit(False)).alias("kept"))
    )
