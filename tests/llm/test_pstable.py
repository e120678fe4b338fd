import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import clashing
from lapwise.llm import pstable
from lapwise.llm.pstable import WIDTH, linked_sets, near_vectors, shared_cell, tables_for
from lapwise.llm.queries import op12_near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return clashing(df, "vector", "first", "second", "class", "size", "least", "root", "links", "n_links", "component_id", "codes", "nth")


def brute(rows, cosine=0.98):
    """Per row its id, links and component, by all pairs."""
    def fit(row):
        key, vector, label = row
        return key is not None and label is not None and vector and None not in vector and np.isfinite(vector).all() and any(vector)

    width = max([len(v) for _, v, _ in rows if v], default=0)
    wide = [np.pad(np.array(v, np.float32).astype(float), (0, width - len(v))) if fit((k, v, n)) else None for k, v, n in rows]
    # A common factor first: squares of very large or small components leave the doubles' range.
    wide = [None if v is None else v / np.abs(v).max() for v in wide]
    near = {
        i: [j for j in range(len(rows)) if i != j and wide[i] is not None and wide[j] is not None and rows[i][2] == rows[j][2]
            and wide[i] @ wide[j] / np.linalg.norm(wide[i]) / np.linalg.norm(wide[j]) >= cosine]
        for i in range(len(rows))
    }
    out = []
    for i, (key, _, _) in enumerate(rows):
        reached, ahead = {i}, [i]
        while ahead:
            fresh = set(near[ahead.pop()]) - reached
            reached |= fresh
            ahead += fresh
        out.append((key, len(near[i]), min((rows[j][0] for j in reached if rows[j][0] is not None), default=None)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id").collect()), key=repr)


def planted(dice, groups, members, dims=16, spread=0.02, labels=3):
    """Clusters whose pairs stand around the threshold, and chains of neighbours."""
    rows = []
    for g in range(groups):
        center = dice.normal(size=dims)
        center /= np.linalg.norm(center)
        for m in range(members):
            rows.append((center + dice.normal(size=dims) * spread * (1 + m % 3), int(g % labels)))
    a, b = dice.normal(size=dims), dice.normal(size=dims)
    a /= np.linalg.norm(a)
    b -= a * (a @ b)
    b /= np.linalg.norm(b)
    rows += [(a * np.cos(t) + b * np.sin(t), 1) for t in np.arange(0, 3, 0.15)]
    order = dice.permutation(len(rows))
    return [(int(k) * 3 + 1, [float(x) for x in rows[i][0].astype(np.float32)], rows[i][1]) for k, i in enumerate(order)]


@pytest.mark.parametrize("per_block", [1024, 5])
def test_clusters_and_chains(spark, per_block):
    rows = planted(np.random.default_rng(per_block), 12, 25)
    rows += [(5000 + i, rows[7][1], rows[7][2]) for i in range(30)] + [(9000, rows[7][1], 2 - rows[7][2] if rows[7][2] != 1 else 0)]
    want = brute(rows)
    assert max(n for _, n, _ in want) > 29 and len({c for _, _, c in want}) < len(rows) / 2
    found = near_vectors(table(spark, rows), "vec_id", "embedding", F.col("label"), classes_per_block=per_block, rows_per_task=200)
    assert got(found) == want


def test_odd_rows(spark):
    good = [1.0, 0.5, 0.25]
    rows = [
        (10, good, 1), (10, good, 1), (10, [0.0, 0.0, 1.0], 1), (7, good, None), (3, good, 2), (12, [2.0, 1.0, 0.5], 1), (None, good, 1),
        (13, None, 1), (14, [0.0] * 3, 1), (15, [], 1), (16, [1.0, None, 0.25], 1), (17, [NAN, 0.5, 0.25], 1), (18, [INF, 0.5, 0.25], 1),
        (19, [1.0, 0.5, 0.25, 0.0, 0.0], 1), (20, [1e30, 0.5e30, 0.25e30], 1), (21, [1e-30, 0.5e-30, 0.25e-30], 1), (22, [-1.0, -0.5, -0.25], 1),
        (23, [-0.0, 0.0, 1.0], 1), (4, [1.0, 0.5, 0.25, 0.0], 3), (5, [4.0, 2.0, 1.0, 0.01], 3), (6, [1.0], 4), (8, [1.0, 0.2], 4), (9, [1.0, 0.3], 4),
    ]
    found = got(near_vectors(table(spark, rows), "vec_id", "embedding", F.col("label")))
    assert found == brute(rows)
    assert (None, 0, None) in found and (3, 0, 3) in found and (22, 0, 22) in found


def test_none(spark):
    assert got(near_vectors(table(spark, []), "vec_id", "embedding", F.col("label"))) == []
    assert got(near_vectors(table(spark, [(4, None, 1)]), "vec_id", "embedding", F.col("label"))) == [(4, 0, 4)]


def test_chances():
    """The number of tables follows from how often vectors at the threshold share a cell."""
    dice = np.random.default_rng(5)
    for distance in (0.1, 0.2, 1.0, 2**0.5):
        steps = dice.normal(size=200_000) * distance
        offset = dice.random(200_000) * WIDTH
        assert abs((np.floor((steps + offset) / WIDTH) == np.floor(offset / WIDTH)).mean() - shared_cell(distance)) < 0.005
    for n in (1, 100, 10_000, 10**9):
        cells, tables = tables_for(n, 0.98)
        assert (1 - shared_cell(0.2) ** cells) ** tables <= pstable.MISS * 1.0001
        assert n * shared_cell(2**0.5) ** cells <= pstable.STRANGERS * 1.0001 or cells == 2
    assert tables_for(1000, 1.0)[1] == 1


def test_a_pair_counts_in_its_first_table_only():
    vectors = np.tile(np.array([[1.0, 0.0]]), (3, 1))
    unit = {
        "vector": vectors, "label": np.array([1, 1, 1]), "size": np.array([1, 10, 100]), "side": np.zeros(3, int), "table": 1,
        "codes": np.array([[7, 5], [7, 5], [8, 5]]),
    }
    total, root = pstable.compare(unit, True, 0.98)
    assert total.tolist() == [100, 100, 11] and root.tolist() == [0, 0, 0]


def test_linked_sets():
    links = np.zeros((6, 6), bool)
    for a, b in ((5, 3), (3, 1), (4, 2)):
        links[a, b] = links[b, a] = True
    assert linked_sets(links).tolist() == [0, 1, 2, 1, 2, 1]


def test_query_over_clusters_of_the_test_tables(spark):
    """The planted clusters of a larger table, one of them large, against all pairs."""
    sf = "/root/testdata/check_h"
    data = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    vectors = np.stack(data["embedding"]).astype(float)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    labels, ids = data["label"].to_numpy(), data["vec_id"].to_numpy()
    near = (vectors @ vectors.T >= 0.98) & (labels[:, None] == labels)
    np.fill_diagonal(near, False)
    root = linked_sets(near)
    least = {r: ids[root == r].min() for r in np.unique(root)}
    want = sorted(((int(i), int(n), int(least[r])) for i, n, r in zip(ids, near.sum(axis=1), root)), key=repr)
    assert got(op12_near_vectors(spark, sf)) == want
