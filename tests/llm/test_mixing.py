import hashlib
import re

import pytest

from helpers import clashing, documents
from lapwise.llm.mixing import mix, targets, words
from lapwise.llm.queries import op9_mix


def fill(sizes, weights=(5, 2, 1), share=1.5, repeat=2):
    """Targets by resharing what is above until nothing is. Sources in order, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, left = {}, share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        total = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / total >= repeat * sizes[s]]
        if not above:
            return fixed | {s: left * weight[s] / total for s in free}
        for s in above:
            fixed[s] = repeat * sizes[s]
        left = share * sum(sizes.values()) - sum(fixed.values())
        if len(fixed) == len(order):
            return fixed


def brute(rows):
    """``rows`` (key, size, source): taken by the queue, everything in memory."""
    sizes = {}
    for _, size, source in rows:
        sizes[source] = sizes.get(source, 0) + size
    target = fill(sizes)
    place = lambda k, t: int(hashlib.md5(f"{'null' if k is None else k}:{t}".encode()).hexdigest()[:13], 16)
    queue = []
    for source in sizes:
        copies = sorted((t, place(k, t), k is not None, k, n, i) for i, (k, n, s) in enumerate(rows) for t in (0, 1) if s == source and n and target[source])
        used = 0
        for t, p, _, k, n, i in copies:
            used += n
            queue.append((used / target[source], "" if source is None else "=" + source, t, p, n, i))
    taken, used, budget = [0] * len(rows), 0, 1.5 * sum(sizes.values())
    for *_, n, i in sorted(queue):
        used += n
        if used > budget:
            break
        taken[i] += n
    return target, taken


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100, "d": 1}, {"x": 10}, {"a": 5, "b": 0, "c": 900, None: 50}, {"a": 0}, {f"s{i}": i * i for i in range(40)}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in targets(df).collect()}
    want = fill(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) <= 1e-9 * (1 + want[s]) for s in want)


@pytest.mark.parametrize("rows_per_block", [10, 20_000])
def test_same_as_brute_force(spark, rows_per_block):
    rows = [(i, (i * 37) % 91, "hot" if i % 3 == 0 else f"s{i % 7}" if i % 7 else None) for i in range(400)]
    df = clashing(spark.createDataFrame(rows, "k long, n long, s string"), "target", "taken", "row", "place", "all", "name", "_block")
    found = mix(df, "k", "n", "s", rows_per_block=rows_per_block)
    assert found.columns == [*df.columns, "source_size", "target_", "taken_"]
    target, taken = brute(rows)
    got = {r["k"]: r["taken_"] for r in found.collect()}
    assert got == {k: t for (k, _, _), t in zip(rows, taken)}


def test_awkward_rows(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (None, "d e", None), (2, None, "y"), (3, "", "x"), (4, "w " * 50_000, "z"), (5, " \t\n", "z")]
    docs = documents(spark, rows)
    sized = docs.select("doc_id", "source", words("text").alias("size"))
    assert [r["size"] for r in sized.collect()] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    found = mix(sized, "doc_id", "size", "source").collect()
    assert len(found) == len(rows) and all(r["taken"] % r["size"] == 0 and r["taken"] <= 2 * r["size"] if r["size"] else not r["taken"] for r in found)
    empty = documents(spark, []).select("doc_id", "source", words("text").alias("size"))
    assert mix(empty, "doc_id", "size", "source").collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = [(r["doc_id"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")), r["source"]) for r in docs]
    target, taken = brute(rows)
    got = {r["doc_id"]: r for r in op9_mix(spark, sf).collect()}
    for (k, n, s), t in zip(rows, taken):
        assert (got[k]["size"], got[k]["taken"]) == (n, t) and abs(got[k]["target"] - target[s]) < 1e-6
