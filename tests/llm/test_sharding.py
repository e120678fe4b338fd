import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import clashing, documents, stored
from lapwise.llm.queries import op1_shard
from lapwise.llm.sharding import communication_matrix, hypergeometric, shuffle


def chance(total, marked, drawn, k):
    return math.comb(marked, k) * math.comb(total - marked, drawn - k) / math.comb(total, drawn)


@pytest.mark.parametrize("total, marked, drawn", [(50, 20, 15), (1000, 3, 400), (12, 12, 5), (30, 0, 7), (40, 25, 40), (9000, 400, 3000)])
def test_counts_follow_the_distribution(spark, total, marked, drawn):
    """At u in steps of 1/n, each value comes up as often as its chance says."""
    n = 2000
    rows = spark.range(n).select(hypergeometric((F.col("id") + 0.5) / n, *[F.lit(x) for x in (total, marked, drawn)]).alias("k"))
    got = Counter(r["k"] for r in rows.collect())
    for k in range(max(0, drawn - total + marked), min(marked, drawn) + 1):
        assert abs(got[k] - n * chance(total, marked, drawn, k)) <= 1.01
    assert sum(got.values()) == n


@pytest.mark.parametrize("sizes, shards", [([5, 0, 17, 1, 30, 8, 2], 4), ([3], 5), ([100] * 40, 7), ([], 3)])
def test_matrix_adds_up(spark, sizes, shards):
    counts = spark.createDataFrame(list(enumerate(sizes)), "id long, n long")
    matrix, partitions, rows = communication_matrix(counts, shards, 3)
    found = {r["id"]: r["part"] for r in matrix.collect()}
    assert (partitions, rows) == (len(sizes), sum(sizes))
    assert {i: sum(p) for i, p in found.items()} == dict(enumerate(sizes))
    if sizes:
        assert [sum(c) for c in zip(*found.values())] == [rows // shards + (s < rows % shards) for s in range(shards)]


def check(found, rows, shards, shard="shard", slot="slot"):
    sizes = Counter(r[shard] for r in found)
    assert len(found) == rows and max(sizes.values(), default=0) - min(sizes.values(), default=0) <= 1
    assert set(sizes) <= set(range(shards)) and (rows < shards or len(sizes) == shards)
    slots = {}
    for r in found:
        slots.setdefault(r[shard], []).append(r[slot])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("rows_per_block", [7, 20_000])
def test_exact_and_gapless(spark, tmp_path, rows_per_block):
    docs = stored(spark, documents(spark, [(i, f"text {i % 3}") for i in range(500)]).repartition(9), tmp_path / "d")
    found = shuffle(docs, 24, rows_per_block=rows_per_block)
    first, again = found.collect(), found.collect()
    check(first, 500, 24)
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in first} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}


def test_uniform(spark, tmp_path):
    """Over many seeds the first rows of a partition reach every shard alike, and neighbours part."""
    docs = stored(spark, spark.range(24).selectExpr("id AS doc_id").repartition(3), tmp_path / "d")
    shards, together = Counter(), 0
    for seed in range(60):
        at = {r["doc_id"]: r["shard"] for r in shuffle(docs, 4, seed=seed * 10).collect()}
        shards.update(at[i] for i in (0, 1, 2))
        together += at[0] == at[1]
    assert all(abs(n - 45) < 25 for n in shards.values())
    assert together < 30


def test_awkward_rows(spark, tmp_path):
    rows = [(1, "a"), (1, "a"), (None, None), (None, None), (2, ""), (3, "x" * 100_000)]
    docs = clashing(documents(spark, rows), "shard", "slot", "id", "part", "place", "_block", "_value", "doc")
    found = shuffle(stored(spark, docs, tmp_path / "d"), 3)
    assert found.columns == [*docs.columns, "shard_", "slot_"]
    check(found.collect(), 6, 3, "shard_", "slot_")
    assert sorted(map(str, found.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    assert shuffle(documents(spark, [], tmp_path / "e"), 3).collect() == []


def test_query(spark):
    import zlib

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = op1_shard(spark, sf).collect()
    check(found, len(texts), 24)
    for r in found:
        assert (r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 8, zlib.crc32(texts[r["doc_id"]]))
        assert (r["law"], r["grown_shard"]) == ("rows", None)
