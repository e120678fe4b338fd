import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from helpers import clashing, documents
from lapwise.llm.packing import Encoder, default_vocabulary, fullest, pack, pack_documents, plan_bins
from lapwise.llm.queries import op8_pack

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]


def pieces_of(ids, capacity):
    first = (len(ids) - 1) % capacity + 1
    borders = [0, *range(first, len(ids) + 1, capacity)]
    return [(a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for a, b in zip(borders, borders[1:])]


def check_sequences(rows, capacity, start="offset", sequence="sequence_id"):
    sequences = {}
    for r in rows:
        sequences.setdefault(r[sequence], []).append((r[start], r["length"]))
    for parts in sequences.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_ids_equal_the_tokenizers():
    dice = random.Random(1)
    parts = ["the", " ", "  ", "\n", "\n\n", "\t", " \n ", "it's", "IT'S", "é", "日本", " ", " ", "123", "4567", "!?", "<|endoftext|>", "é", "🙂", "'", "\r\n", "\x00", "\x1c"]
    encode = Encoder(*default_vocabulary())
    for _ in range(4000):
        text = "".join(dice.choice(parts) + dice.choice(["", " ", ""]) for _ in range(dice.randint(0, 12)))
        assert np.frombuffer(encode(text), "<u4").tolist() == ids_of(text)[:-1], text


def test_cache_may_be_dropped(monkeypatch):
    from lapwise.llm import packing

    monkeypatch.setattr(packing, "_CACHE_LIMIT", 3)
    encode = Encoder(*default_vocabulary())
    text = "one two three four five six seven one two"
    assert np.frombuffer(encode(text), "<u4").tolist() == ids_of(text)[:-1]


@pytest.mark.parametrize("seed", range(30))
def test_fullest_combination(seed):
    """As full as any combination with the longest piece."""
    dice = random.Random(seed)
    capacity = dice.randint(10, 60)
    counts = Counter(dice.randint(1, capacity) for _ in range(dice.randint(1, 12)))
    longest = max(counts)
    sums = {longest}
    rest = list((counts - Counter([longest])).elements())
    for n in rest:
        sums |= {s + n for s in sums if s + n <= capacity}
    chosen = fullest(dict(counts), capacity)
    assert sum(n * m for n, m in chosen.items()) == max(sums)
    assert all(m <= counts[n] for n, m in chosen.items()) and chosen[longest] >= 1


def test_plan_uses_every_piece_once():
    dice = random.Random(4)
    counts = Counter(min(2048, int(dice.expovariate(1 / 500)) + 1) for _ in range(20_000))
    plan, used = plan_bins(dict(counts), 2048), Counter()
    for chosen, times in plan:
        assert sum(n * m for n, m in chosen.items()) <= 2048
        for n, m in chosen.items():
            used[n] += m * times
    assert used == counts
    assert sum(t for _, t in plan) <= -(-sum(n * c for n, c in counts.items()) // 2048) + 1


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c  d"), (4, "word " * 9000), (5, "x" * 50_000), (3, "a b")]
    docs = clashing(documents(spark, rows), "piece", "start", "length", "sequence_id", "offset", "size")
    found = pack_documents(docs, "text", "doc_id", capacity=64).collect()
    want = sorted((str(k), n, *p) for k, t in rows for n, p in enumerate(pieces_of(ids_of(t), 64)))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    assert check_sequences(found, 64) <= -(-sum(w[3] for w in want) // 64) + 1
    assert pack_documents(documents(spark, []), "text", "doc_id").collect() == []


def test_pieces_with_clashing_columns(spark):
    pieces = clashing(spark.createDataFrame([(i, i % 9 + 1) for i in range(200)], "k long, length int"), "sequence_id", "offset", "size", "rank", "place", "_block")
    found = pack(pieces, "length", ["k"], 16, rows_per_block=5)
    assert found.columns == [*pieces.columns, "sequence_id_", "offset_"]
    assert check_sequences(found.collect(), 16, "offset_", "sequence_id_") <= -(-sum(i % 9 + 1 for i in range(200)) // 16) + 1


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = op8_pack(spark, sf).collect()
    want = sorted((k, n, *p) for k, t in docs.items() for n, p in enumerate(pieces_of(ids_of(t), 2048)))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    assert check_sequences(found, 2048) <= 1.01 * sum(w[3] for w in want) / 2048 + 1
