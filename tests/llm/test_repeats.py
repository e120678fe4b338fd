import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import clashing, documents
from lapwise.llm.queries import op7_repeats
from lapwise.llm.repeats import LENGTH, repeated_spans, triggers


def brute(rows):
    """Spans by row, every 100-byte string looked up. Rows with the same key and text are one document."""
    seen, found = set(), {}
    for key, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        cover = np.zeros(len(data) + 1, int)
        for i in range(len(data) - LENGTH + 1):
            piece = data[i:i + LENGTH]
            if piece in seen:
                cover[i] += 1
                cover[i + LENGTH] -= 1
            seen.add(piece)
        edges = np.diff(np.pad((np.cumsum(cover[:-1]) > 0).astype(int), 1))
        found[key, text] = list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))
    return found


def texts(seed, count):
    """Texts made of shared passages, cut at any byte, some periodic."""
    dice = random.Random(seed)
    letters = "abcdeé \n"
    passages = ["".join(dice.choice(letters) for _ in range(dice.randint(60, 700))) for _ in range(6)]
    passages += ["ab" * 150, "x" * 400, "-" * 99, "z" * 101]
    out = []
    for _ in range(count):
        parts = []
        for _ in range(dice.randint(0, 4)):
            p = dice.choice(passages)
            a, b = sorted((dice.randint(0, len(p)), dice.randint(0, len(p))))
            parts += [p[a:b] if dice.random() < 0.7 else p, "".join(dice.choice(letters) for _ in range(dice.randint(0, 60)))]
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("settings", [{}, {"contexts_per_task": 7}, {"most_contexts": 2}])
def test_same_as_brute_force(spark, settings):
    rows = list(enumerate(texts(len(settings) + 1, 80)))
    random.Random(3).shuffle(rows)
    want = brute(rows)
    docs = documents(spark, rows).repartition(5)
    for r in repeated_spans(docs, "text", "doc_id", **settings).collect():
        assert [tuple(s) for s in r["repeats"]] == want[r["doc_id"], r["text"]], r["doc_id"]


def test_awkward_rows(spark):
    long = "".join(random.Random(9).choice("abcdefgh") for _ in range(3000))
    rows = [(4, long), (2, long[500:900]), (4, long), (None, long[100:250]), (7, None), (8, ""), (9, "x" * 99), (10, "x" * 100), (11, "x" * 250), (2, "x" * 120)]
    docs = clashing(documents(spark, rows), "repeats", "_key", "_mark", "key", "mark", "doc", "places")
    want = brute(rows)
    found = repeated_spans(docs, "text", "doc_id")
    assert found.columns == [*docs.columns, "repeats_"]
    found = found.collect()
    assert len(found) == len(rows)
    for r in found:
        assert [tuple(s) for s in r["repeats_"]] == want[r["doc_id"], r["text"]]


@pytest.mark.parametrize("partitions", [1, 4])
@pytest.mark.parametrize("settings", [{}, {"most_contexts": 2}])
def test_equal_rows_keep_what_occurs_first_in_them(spark, partitions, settings):
    dice = random.Random(9)
    long, other = ("".join(dice.choice("abcdefgh") for _ in range(3000)) for _ in range(2))
    rows = [(4, long), (2, long[500:900]), (4, long), (4, other), (4, long), (None, other), (None, other), (6, long[700:2000] + other), (6, long[700:2000] + other)]
    want = brute(rows)
    assert want[None, other] == [] and want[4, long] == [(500, 900)]
    docs = documents(spark, rows).repartition(partitions)
    found = repeated_spans(docs, "text", "doc_id", **settings).collect()
    assert len(found) == len(rows)
    for r in found:
        assert [tuple(s) for s in r["repeats"]] == want[r["doc_id"], r["text"]], r["doc_id"]


def test_texts_of_one_id_that_share_a_short_hash(spark):
    """Different texts of equal or null ids, among them some whose 64-bit hashes agree in 31 bits."""
    dice = random.Random(1)
    shared = "".join(dice.choice("abcdefgh") for _ in range(300)) + "."
    words = spark.range(150_000).select(F.concat(F.lit(shared), F.sha2(F.col("id").cast("string"), 512)).alias("text"))
    words = words.withColumn("short", F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)))
    clash = words.groupBy("short").agg(F.collect_list("text").alias("t")).where("size(t) > 1").limit(3).collect()
    texts = [t for r in clash for t in r["t"]]
    assert len(texts) >= 2
    for key in (7, None):
        found = repeated_spans(documents(spark, [(key, t) for t in texts]), "text", "doc_id").collect()
        spans = sorted(tuple(map(tuple, r["repeats"])) for r in found)
        # A letter or two after the shared part may agree as well.
        assert spans[0] == () and all(len(s) == 1 and s[0][0] == 0 and 301 <= s[0][1] < 306 for s in spans[1:])


def test_many_rows_without_an_id(spark):
    texts = spark.range(20_000).select(F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2(F.concat(F.lit("b"), "id"), 256)).alias("text"))
    docs = texts.unionByName(texts.where(F.col("text").startswith("00"))).select(F.lit(None).cast("bigint").alias("doc_id"), "text")
    assert repeated_spans(docs, "text", "doc_id").where("size(repeats) > 0").count() == 0


@pytest.mark.parametrize("kind", ["string", "int", "date"])
def test_ids_of_any_kind(spark, kind):
    rows = list(enumerate(texts(11, 40)))
    want = brute(rows)
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("doc_id").cast("int"))
    own = {"string": F.format_string("id%03d", "doc_id"), "int": F.col("doc_id").cast("int"), "date": day}[kind]
    docs = documents(spark, rows).withColumn("n", F.col("doc_id")).withColumn("doc_id", own).repartition(3)
    for r in repeated_spans(docs, "text", "doc_id").collect():
        assert [tuple(s) for s in r["repeats"]] == want[r["n"], r["text"]]


def test_empty_table(spark):
    assert repeated_spans(documents(spark, []), "text", "doc_id").collect() == []


def test_stretches_find_the_same_triggers(monkeypatch):
    from lapwise.llm import repeats

    data = "".join(texts(5, 60)).encode()
    whole = triggers(data)
    monkeypatch.setattr(repeats, "_STRETCH", 333)
    for one, cut in zip(whole, triggers(data)):
        assert (one == cut).all()


def test_every_string_holds_a_trigger():
    data = "".join(texts(6, 40)).encode()
    places = triggers(data)[0]
    for i in range(len(data) - LENGTH + 1):
        at = np.searchsorted(places, i)
        assert at < len(places) and places[at] <= i + 68


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want, of = brute(rows), dict(rows)
    for r in op7_repeats(spark, sf).collect():
        data, spans = (of[r["doc_id"]] or "").encode(), want[r["doc_id"], of[r["doc_id"]]]
        rest = np.ones(len(data), bool)
        for a, b in spans:
            rest[a:b] = False
        left = np.frombuffer(data, np.uint8)[rest].tobytes()
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(data), len(data) - len(left), len(spans))
        assert r["kept_sha256"] == hashlib.sha256(left).hexdigest()
