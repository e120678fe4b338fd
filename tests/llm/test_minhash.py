import random

import numpy as np
import pytest

from helpers import clashing, documents
from lapwise.llm.graph import components
from lapwise.llm.minhash import least_matches, near_duplicates, rows_per_band
from lapwise.llm.queries import op4_near_duplicates


def brute(rows, width, percent):
    """Component (smallest key) of every row, all pairs compared."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        size = min(width, len(words))
        sets.append({tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least.setdefault(find(i), []).append(key)
    return [(min((k for k in least[find(i)] if k is not None), default=None), len(sets[i])) for i in range(len(rows))]


def edited(dice, words, changes):
    words = list(words)
    for _ in range(changes):
        words[dice.randrange(len(words))] = f"w{dice.randrange(10**6)}"
    return words


def check(df, rows, width, percent):
    got = sorted((r["doc_id"], r["component_id"], r["n_shingles"]) for r in df.where("doc_id is not null").collect())
    want = sorted((k, c, n) for (k, _), (c, n) in zip(rows, brute(rows, width, percent)) if k is not None)
    assert got == want


@pytest.mark.parametrize("part", [3, 500])
def test_groups_of_near_copies(spark, part):
    """Chains and stars of copies, below and above the size of a part."""
    dice = random.Random(part)
    rows, key = [], 0
    for group in range(6):
        base = [f"g{group}x{i}" for i in range(150)]
        for _ in range(14):
            rows.append((key, " ".join(edited(dice, base, dice.randrange(6)))))
            key += 1
        drift = base
        for _ in range(6):
            drift = edited(dice, drift, 2)
            rows.append((key, " ".join(drift)))
            key += 1
    dice.shuffle(rows)
    check(near_duplicates(documents(spark, rows), "text", "doc_id", 3, 85, part, 2 * part), rows, 3, 85)


def test_awkward_rows(spark):
    rows = [(5, "A b c"), (3, "a B C"), (9, "a b"), (8, "a  b"), (7, "a"), (6, None), (4, ""), (2, " \t"), (1, "x y z w"),
            (1, "x y z w"), (11, "x y z w"), (12, "a b cÄ"), (13, "a b cä"), (14, "word " * 50_000), (10, "word " * 40_000)]
    docs = clashing(documents(spark, rows), "n", "row", "node", "high", "root", "name", "key")
    check(near_duplicates(docs, "text", "doc_id", 3, 85), rows, 3, 85)
    kept = near_duplicates(docs, "text", "doc_id", 3, 85).where("kept").collect()
    groups = {c for c, _ in brute(rows, 3, 85)}
    assert sorted(r["doc_id"] for r in kept) == sorted(groups)


def test_null_keys_and_repeated_keys(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (1, "p q r s"), (1, "t u v w"), (2, "a b c d"), (None, "lonely words here")]
    found = near_duplicates(documents(spark, rows), "text", "doc_id", 3, 85).collect()
    assert sorted(str(r["component_id"]) for r in found) == ["1", "1", "2", "2", "2", "None"]
    assert sum(r["kept"] for r in found) == 4


def test_empty_table(spark):
    assert near_duplicates(documents(spark, []), "text", "doc_id").collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(op4_near_duplicates(spark, sf), rows, 3, 85)


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(60)] + [(i, 100) for i in range(101, 130)] + [(7, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 130)}


def test_bounds_lose_few_pairs():
    """At the threshold itself a pair is pruned with the chosen chance at most."""
    dice = np.random.default_rng(5)
    steps = least_matches(85, 180)
    matches = np.cumsum(dice.random((20_000, 180)) < 0.85, axis=1)
    lost = np.zeros(len(matches), bool)
    for n, least in steps:
        lost |= matches[:, n - 1] < least
    assert lost.sum() <= 4
    unlike = np.cumsum(dice.random((20_000, 180)) < 0.3, axis=1)
    assert (unlike[:, steps[1][0] - 1] < steps[1][1]).mean() > 0.95
    assert (rows_per_band(85), rows_per_band(80)) == (6, 4)
