import hashlib
import math
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import clashing, documents
from lapwise.llm.importance import features, gains, pieces, resample

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {upper: upper + 32 for upper in range(65, 91)}


def runs_of(text, width=2):
    words = WORDS.findall((text or "").translate(LOWER))
    return [" ".join(words[i:i + n]) for n in range(1, width + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, percent=25, least=20, width=2, buckets=10_000, seed=7):
    def count(texts):
        counts = [0] * buckets
        for text in texts:
            for f in runs_of(text, width):
                counts[zlib.crc32(f.encode()) % buckets] += 1
        return counts

    s, t = count(text for _, text in docs), count(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out = []
    for key, text in docs:
        of = [gain[zlib.crc32(f.encode()) % buckets] for f in runs_of(text, width)]
        weight = sum(of) // len(of) if of else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(of), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [r for r, (_, text) in zip(out, docs) if len(runs_of(text, 1)) >= least]
    for n, row in enumerate(sorted(able, key=lambda r: (-r[3], r[0] is not None, r[0] or 0))[:percent * len(able) // 100]):
        row[4] = n + 1
    return out


def got(df):
    return [tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()]


def same(found, want):
    return sorted(map(repr, found)) == sorted(map(repr, map(tuple, want)))


TEXTS = [
    None, "", " \t\n", "-- --", "Word", "word WORD", "Ähre É x 字字 a1-b2", "\x00nul\x00 seven", "x" * 50_000, "a b " * 30_000,
    *[f"the quick fox {i} jumps over {i % 7} lazy dogs near " * (1 + i % 9) for i in range(60)],
]


@pytest.mark.parametrize("width", [1, 2, 3])
def test_awkward_texts(spark, width):
    docs = list(enumerate(TEXTS))
    target = ["lazy dogs near the fox", None, "", "seven words"]
    df = clashing(documents(spark, docs), "n_features", "weight", "score", "rank", "place", "enough", "bucket", "n")
    goal = clashing(documents(spark, list(enumerate(target))).select("text"), "bucket", "n")
    found = got(resample(df, "text", "doc_id", goal, "text", width=width, least_words=9, buckets=500))
    assert same(found, brute(docs, target, width=width, least=9, buckets=500))
    assert sum(r[4] is not None for r in found) == 15  # of 61 that are long enough


def test_repeated_and_null_ids_and_ranges(spark, monkeypatch):
    monkeypatch.setattr("lapwise.llm.importance._ROWS_PER_RANGE", 7)
    docs = [(i // 2, TEXTS[10 + i % 60]) for i in range(80)] + [(None, TEXTS[i]) for i in (0, 30, 30, 40)]
    found = got(resample(documents(spark, docs), "text", "doc_id", documents(spark, [(1, "quick fox")]), "text", least_words=5))
    want = brute(docs, ["quick fox"], least=5)
    ranks = sorted(r[4] for r in found if r[4])
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) == sum(r[4] is not None for r in want)
    # Rows of one id and score may take each other's rank.
    assert sorted((r[4], r[3], repr(r[0])) for r in found if r[4]) == sorted((r[4], r[3], repr(r[0])) for r in want if r[4])
    assert same([r[:4] for r in found], [r[:4] for r in want])


def test_empty_tables(spark):
    none = documents(spark, [])
    assert got(resample(none, "text", "doc_id", documents(spark, [(1, "x")]), "text")) == []
    docs = [(i, t) for i, t in enumerate(TEXTS[10:30])]
    assert same(got(resample(documents(spark, docs), "text", "doc_id", none, "text")), brute(docs, []))


def test_text_ids(spark):
    docs = documents(spark, [(i, TEXTS[20 + i]) for i in range(9)]).withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    found = got(resample(docs, "text", "doc_id", documents(spark, [(1, "dogs")]), "text"))
    assert same(found, brute([(f"d{i}", TEXTS[20 + i]) for i in range(9)], ["dogs"]))


def test_pieces_cover_all_texts():
    texts = pa.array(TEXTS)
    for most in (1, 10, 1000, 1 << 30):
        parts = list(pieces(texts, most))
        assert [at for at, _ in parts] == [sum(len(p) for _, p in parts[:i]) for i in range(len(parts))]
        assert pa.concat_arrays([p for _, p in parts]).equals(texts)
        assert all(len(p) == 1 or sum(len((t or "").encode()) for t in p.to_pylist()) <= most for _, p in parts)


def test_large_arrow_strings():
    for kind in (pa.string(), pa.large_string()):
        out = [(b.tolist(), t.tolist()) for b, t in features(pa.array(["b a b a", "a b"], kind), 2, 10_000)]
        crc = [zlib.crc32(w) % 10_000 for w in (b"b", b"a", b"b a", b"a b")]
        assert out == [([crc[0], crc[1], crc[0], crc[1], crc[1], crc[0]], [0, 0, 0, 0, 1, 1]), ([crc[2], crc[3], crc[2], crc[3]], [0, 0, 0, 1])]


def test_gain_of_equal_counts_is_none():
    import numpy as np

    assert gains(np.array([3, 5]), np.array([3, 5])).tolist() == [0, 0]
