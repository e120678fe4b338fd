import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helpers import clashing, documents, stored
from test_minhash import brute as near_brute
from test_mixing import brute as mix_brute
from test_packing import check_sequences, ids_of, pieces_of
from test_secrets import brute as secret_brute

STAGES = dict(corpus_pipeline.STAGES)
FILLER = "the cat sat on the mat and the dog ran after it"


def run(spark, folder, name, docs):
    return stored(spark, STAGES[name](spark, docs, "unused"), folder / name)


def marked(text):
    data, out, at = text.encode(), b"", 0
    for begin, _, end in secret_brute(data):
        if begin >= at:
            out += data[at:begin] + b"[secret]"
        at = max(at, end)
    return (out + data[at:]).decode()


def test_each_stage_on_the_one_before(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns = docs.columns
    kept = run(spark, tmp_path, "language", docs)
    assert kept.columns == columns and kept.count() == docs.count()

    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    alone = run(spark, tmp_path, "near_duplicates", kept)
    groups = {c for c, _ in near_brute(rows, 5, 80)}
    assert alone.columns == columns and sorted(r["doc_id"] for r in alone.collect()) == sorted(groups)
    assert len(groups) < len(rows)

    before = {r["doc_id"]: r for r in alone.collect()}
    clean = run(spark, tmp_path, "secrets", alone)
    after = clean.collect()
    assert clean.columns == columns and len(after) == len(before)
    for r in after:
        assert r["text"] == marked(before[r["doc_id"]]["text"]) and r["n_chars"] == len(r["text"])

    sizes = [(r["doc_id"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])), r["source"]) for r in after]
    mixed = run(spark, tmp_path, "mixing", clean)
    want = Counter({k: t // n for (k, n, _), t in zip(sizes, mix_brute(sizes)[1]) if t})
    assert mixed.columns == columns and Counter(r["doc_id"] for r in mixed.collect()) == want

    texts = [(r["doc_id"], r["text"]) for r in mixed.collect()]
    packed = run(spark, tmp_path, "packing", mixed).collect()
    pieces = sorted((k, n, *p) for k, t in texts for n, p in enumerate(pieces_of(ids_of(t), 2048)))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == pieces
    check_sequences(packed, 2048)

    whole = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, packed))


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_awkward_documents(spark, tmp_path, name):
    rows = [(1, FILLER, "x"), (1, FILLER, "x"), (1, FILLER + " and more", None), (None, "other words that nobody else has here", None),
            (None, None, "x"), (2, "", "y"), (3, "12 34", "y", None), (4, "token = abcdef " + FILLER, "z", None), (5, "word " * 30_000, "z")]
    docs = clashing(documents(spark, rows), "_key", "_hash", "_nth", "_found", "_spans", "_times", "size", "taken", "row", "key", "p", "doc", "found", "times", "nth")
    docs = stored(spark, docs, tmp_path / "docs")
    found = run(spark, tmp_path, name, docs)
    assert found.columns == docs.columns
    assert all(r["_found"] == r["doc"] == r["nth"] == r["times"] == "x" for r in found.collect())
    got = Counter((r["doc_id"], (r["text"] or "")[:30]) for r in found.collect())
    first = Counter((r[0], (r[1] or "")[:30]) for r in rows)
    if name == "language":
        assert first - got == Counter({(None, ""): 1, (2, ""): 1, (3, "12 34"): 1})
        assert all(r["lang"] for r in found.collect())
    elif name == "near_duplicates":
        # The two equal rows and the nearly equal one are one group.
        assert got == first - Counter({(1, FILLER[:30]): 2})
    elif name == "secrets":
        assert sum(got.values()) == len(rows) and (4, ("[secret] " + FILLER)[:30]) in got
    else:
        assert all(n <= 2 * first[k] for k, n in got.items()) and (2, "") not in got


def test_junk_and_unknown_scripts_go(spark, tmp_path):
    dice = random.Random(4)
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "bcdfghjklmnpqrstvwxz", "".join(map(chr, range(0x430, 0x450))), "".join(map(chr, range(0x3B1, 0x3CA))),
                 "".join(map(chr, range(0x4E00, 0x5E00))), "0123456789abcdef"]
    junk = [(-n, " ".join("".join(dice.choice(alphabets[n % 6]) for _ in range(dice.randint(3, 9))) for _ in range(60)), "a", None) for n in range(1, 121)]
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    # Some real texts without a label, too.
    real = real.withColumn("lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang")))
    docs = stored(spark, real.unionByName(documents(spark, junk)), tmp_path / "docs")
    found = [r["doc_id"] for r in run(spark, tmp_path, "language", docs).collect()]
    assert sum(k < 0 for k in found) <= 3
    assert sum(k >= 0 for k in found) == real.where("text RLIKE '\\\\p{L}'").count()


def test_languages_without_labels_keep_all_with_letters(spark, tmp_path):
    rows = [(1, FILLER, "a", None), (2, "12 34", "a", None), (3, "\u0436\u0437 \u0438", "a", None)]
    found = run(spark, tmp_path, "language", documents(spark, rows, tmp_path / "docs")).collect()
    assert sorted((r["doc_id"], r["lang"]) for r in found) == [(1, None), (3, None)]


@pytest.mark.parametrize("name", list(STAGES))
def test_no_documents(spark, tmp_path, name):
    docs = documents(spark, [], tmp_path / "docs")
    assert run(spark, tmp_path, name, docs).collect() == []
