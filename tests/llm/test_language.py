import zlib

import numpy as np
from pyspark.sql import functions as F

from helpers import clashing, documents
from lapwise.llm.common import unit
from lapwise.llm.language import fit, predict_language, with_floors
from lapwise.llm.queries import op5_language_id


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = [r for r in op5_language_id(spark, sf).collect() if r["held_out"]]
    assert len(found) > 200
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in found) >= 0.98 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_awkward_rows(spark):
    rows = [(1, "the cat and the dog", "a", "en"), (2, "der Hund und die Katze", "a", "de"), (3, None, "a", "en"),
            (4, "", "a", "de"), (5, "12 34 !?", None, "en"), (None, "the dog and the cat", "a", None), (1, "the cat and the dog", "a", "en")]
    docs = clashing(documents(spark, rows), "score", "lang_pred", "total")
    profiles = fit(docs, "text", "lang", "doc_id")
    assert profiles.languages == ("de", "en")
    found = [tuple(r["p"]) for r in docs.withColumn("p", predict_language("text", profiles)).collect()]
    assert [f[0] for f in found] == ["en", "de", "und", "und", "und", "en", "en"]
    assert found[0] == found[6] and found[2] == ("und", 0.0)


def test_nothing_to_learn_from(spark):
    profiles = fit(documents(spark, []), "text", "lang", "doc_id")
    assert profiles.predict("some words") == ("und", 0.0)


def test_long_text_is_read_whole(spark):
    from lapwise.llm import language

    text = "the cat and the dog " * 200_000
    grams, counts = language._grams(text)
    assert counts.sum() > 10 * 200_000
    # In one stretch or several, the same counts.
    whole = dict(zip(grams.tolist(), counts.tolist()))
    stretch, language._STRETCH = language._STRETCH, 1009
    try:
        short = text[:20_000]
        cut = dict(zip(*(x.tolist() for x in language._grams(short))))
    finally:
        language._STRETCH = stretch
    assert cut == dict(zip(*(x.tolist() for x in language._grams(short))))
    assert set(cut) == set(whole)


def test_sample_is_bounded_and_repeatable(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first, second = (fit(docs, "text", "lang", "doc_id", sample=200) for _ in range(2))
    assert first.languages == second.languages
    assert (first.prototypes == second.prototypes).all()


def test_rare_languages_are_learned(spark):
    rows = [(n, f"the cat and the dog number {n}", "a", "en") for n in range(2000)]
    rows += [(n, f"der Hund und die Katze {n}", "a", "de") for n in range(2000, 2003)]
    for seed in range(3):
        docs = documents(spark, [(k + 10_000 * seed, *rest) for k, *rest in rows])
        assert fit(docs, "text", "lang", "doc_id", sample=20).languages == ("de", "en")


def plain_vector(text, signs):
    """A document's vector by the definition: letter by letter, 3-gram by 3-gram."""
    words, word = [], []
    for letter in (text or "").lower() + " ":
        if letter.isalpha():
            word.append(ord(letter) - 96 if "a" <= letter <= "z" else 27 + ord(letter) % 37)
        elif word:
            words.append(word)
            word = []
    counts = {}
    for word in words:
        padded = [0, *word, 0]
        for gram in zip(padded, padded[1:], padded[2:]):
            counts[gram] = counts.get(gram, 0) + 1
    total = np.zeros(signs.shape[1])
    for (a, b, c), n in counts.items():
        total += n * np.roll(signs[a], 2) * np.roll(signs[b], 1) * signs[c]
    return total


def test_query_is_the_same_as_by_definition(spark):
    """Prototypes of all labelled documents that are not held out, and cosines with them."""
    sf = "/root/testdata/sf0.001"
    signs = np.random.default_rng(20240229).integers(0, 2, (64, 512), np.int8) * 2.0 - 1
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()
    vectors = {r["doc_id"]: plain_vector(r["text"], signs) for r in rows}
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows}
    prototypes = {}
    for r in rows:
        length = np.linalg.norm(vectors[r["doc_id"]])
        if not held[r["doc_id"]] and r["lang"] is not None and length:
            prototypes[r["lang"]] = prototypes.get(r["lang"], 0) + vectors[r["doc_id"]] / length
    found = {r["doc_id"]: r for r in op5_language_id(spark, sf).collect()}
    assert len(found) == len(rows) == 200
    for key, vector in vectors.items():
        assert found[key]["held_out"] == held[key]
        if not vector.any():
            assert (found[key]["lang_pred"], found[key]["score"]) == ("und", 0.0)
            continue
        cosines = {n: p @ vector / np.linalg.norm(p) / np.linalg.norm(vector) for n, p in prototypes.items()}
        best = max(cosines, key=cosines.get)
        assert abs(found[key]["score"] - max(0, cosines[best])) < 1e-3
        assert found[key]["lang_pred"] == best or cosines[best] - cosines[found[key]["lang_pred"]] < 1e-3


def test_every_labelled_document_is_learned_from(spark):
    docs = spark.range(24_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.sha2(F.col("id").cast("string"), 256)).alias("text"), F.lit("en").alias("lang")
    )
    assert (fit(docs, "text", "lang", "doc_id").prototypes == fit(docs, "text", "lang", "doc_id", sample=10**9).prototypes).all()


def test_floors_count_every_labelled_document(spark):
    """Documents unlike their language, one in twenty, that a sample of 2,000 by their keys would leave out."""
    place = unit(F.col("id").cast("string"), "language floors")
    rows = spark.range(4_000).select("id", place.alias("place")).collect()
    odd = {r["id"] for r in sorted(rows, key=lambda r: -r["place"])[:200]}
    assert all(r["place"] >= 0.5 for r in rows if r["id"] in odd)
    plain = "the cat and the dog went down to the old house by the river number "
    docs = [(k, f"{plain}{k}", "a", "en") for k in range(4_000) if k not in odd]
    profiles = fit(documents(spark, docs), "text", "lang", "doc_id")
    unlike = "zxqj vkqz jxwq qvzk xjkq wqzv kzjx qxvj zkwq vjqx"
    docs = documents(spark, [*docs, *((k, unlike, "a", "en") for k in odd)])
    assert profiles.own(unlike, "en") < 0.1
    assert with_floors(profiles, docs, "text", "lang").floors == (max(0.0, profiles.own(unlike, "en")),)
