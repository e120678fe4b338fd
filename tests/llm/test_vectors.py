import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import clashing
from lapwise.llm.ann import nearest, walk
from lapwise.llm.queries import op3_top_k, op10_nearest
from lapwise.llm.topk import threshold_top, top_k

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    return clashing(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA), "row", "vector", "score", "rank", "_q", "_c")


def brute(rows, measure, each, limit):
    """Best ``limit`` by ``measure``; ``rows`` are (id, vector) that take part."""
    out = []
    for i, (q, v) in enumerate(rows):
        if q % each == 0:
            scored = sorted((-measure(v, w), k) for j, (k, w) in enumerate(rows) if j != i)[:limit]
            out += [(q, n + 1, k, -s) for n, (s, k) in enumerate(scored)]
    return sorted(out)


def product(v, w):
    return sum(int(np.floor(64 * np.float64(a))) * int(np.floor(64 * np.float64(b))) for a, b in zip(v, w))


def cosine(v, w):
    n = max(len(v), len(w))
    v, w = (np.pad(np.array(x, np.float32).astype(float), (0, n - len(x))) for x in (v, w))
    return float((v / np.linalg.norm(v)) @ (w / np.linalg.norm(w)))


def got(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("seed", range(6))
def test_threshold_algorithm_stops_right(seed):
    dice = np.random.default_rng(seed)
    vectors = np.floor(dice.normal(size=(700, 1 + seed)) * (3 if seed % 2 else 40))
    queries, k = vectors[:40], 5
    best = threshold_top(queries, vectors, np.arange(40), np.arange(700), k)
    for i in range(40):
        scores = vectors @ queries[i]
        want = [j for j in np.lexsort([np.arange(700), -scores]) if j != i][:k]
        assert best[i][:, 0].tolist() == want


def test_exact_with_ties_and_odd_vectors(spark):
    dice = np.random.default_rng(1)
    good = [(i, [float(x) for x in dice.integers(-2, 3, 4) / 8]) for i in range(60)]
    good += [(60, [0.5, 0.25]), (61, []), (62, [0.0] * 4), (63, [3e7, -3e7, 1.0, 2.0]), (20, [0.125] * 4), (20, [0.125] * 4)]
    bad = [(80, None), (100, [NAN, 1.0, 1.0, 1.0]), (120, [INF, 1.0, 1.0, 1.0]), (140, [None, 1.0, 1.0, 1.0]), (None, [9.0] * 4)]
    df = table(spark, good + bad)
    want = [(q, r, v, s) for q, r, v, s in brute(good, product, 20, 20)]
    assert got(top_k(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 20)) == want


def test_large_whole_numbers(spark):
    rows = [(0, [1e9, 1.0]), (1, [1e5, 2.0]), (2, [100003.0, 3.0]), (3, [-1e5, 0.0]), (5, [1e14, 0.0])]
    found = got(top_k(table(spark, rows), "vec_id", "embedding", F.col("vec_id") == 0, 4))
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in rows]
    want = brute(rows, product, 100, 4)
    assert found == [(q, r, v, min(s, 2**63 - 1)) for q, r, v, s in want]


@pytest.mark.parametrize("search", [top_k, nearest])
def test_none_and_few(spark, search):
    assert got(search(table(spark, []), "vec_id", "embedding", F.col("vec_id") % 2 == 0, 5)) == []
    assert got(search(table(spark, [(0, [1.0, 2.0])]), "vec_id", "embedding", F.col("vec_id") % 2 == 0, 5)) == []
    assert len(got(search(table(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [1.0, 1.0])]), "vec_id", "embedding", F.col("vec_id") % 2 == 0, 5))) == 4
    assert got(search(table(spark, [(1, [1.0, 2.0]), (3, [2.0, 1.0])]), "vec_id", "embedding", F.col("vec_id") % 2 == 0, 5)) == []


def test_nearest_with_copies_and_odd_vectors(spark):
    dice = np.random.default_rng(2)
    common = [float(x) for x in dice.normal(size=6).astype(np.float32)]
    good = [(i, common) for i in range(40)] + [(i, [float(x) for x in dice.normal(size=6).astype(np.float32)]) for i in range(40, 90)]
    good += [(100, [1.0]), (101, [2.0]), (102, [1e30] * 6), (103, [1e-30] * 6)]
    bad = [(150, None), (200, [NAN] * 6), (250, [0.0] * 6), (300, [INF] * 6), (350, []), (400, [1.0, None]), (None, common)]
    found = got(nearest(table(spark, good + bad), "vec_id", "embedding", F.col("vec_id") % 50 == 0, 5, visit=1.0))
    want = brute(good, cosine, 50, 5)
    assert [f[:2] for f in found] == [w[:2] for w in want]
    assert all(abs(f[3] - w[3]) < 1e-12 for f, w in zip(found, want))
    assert [f[2] for f in found if f[0] == 0] == [1, 2, 3, 4, 5]


def test_cells_come_in_order():
    dice = np.random.default_rng(3)
    first, second, sizes = dice.random(7), dice.random(9), dice.integers(0, 3, (7, 9))
    cells = walk(first, second, sizes, int(sizes.sum()))
    sums = [first[i] + second[j] for i, j in cells]
    assert sums == sorted(sums) and len(cells) == (sizes > 0).sum()
    some = walk(first, second, sizes, 10)
    assert some == cells[:len(some)] and 10 <= sum(sizes[c] for c in some) < 13


def recall(spark, sf):
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids, all_ = np.array([k for k, _ in rows]), np.stack([v / np.linalg.norm(v) for _, v in rows])
    found = {}
    for q, _, v, _ in got(op10_nearest(spark, sf)):
        found.setdefault(q, set()).add(v)
    hits = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        scores = all_ @ all_[i]
        scores[i] = -9
        best = ids[np.lexsort([ids, -scores])[:5]]
        hits, total = hits + len(found[ids[i]] & set(best.tolist())), total + len(best)
    return hits / total


def test_recall(spark):
    assert recall(spark, "/root/testdata/sf0.1") >= 0.9


def test_top_k_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    whole = np.floor(64 * np.array([v for _, v in rows], float))
    scores, ids = (whole @ whole.T).astype(int), [k for k, _ in rows]
    want = []
    for i, q in enumerate(ids):
        if q % 20 == 0:
            order = [j for j in np.lexsort([ids, -scores[i]]) if j != i][:20]
            want += [(q, n + 1, ids[j], int(scores[i][j])) for n, j in enumerate(order)]
    assert got(op3_top_k(spark, sf)) == sorted(want)
