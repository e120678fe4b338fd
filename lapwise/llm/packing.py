"""Packing pieces of documents into sequences of bounded length by minimum bin slack.

Pieces of the same length are alike, so bins are planned on the number of pieces of each length: at
most ``capacity`` rows, whatever the size of the corpus. A bin starts with the longest length
left; a subset-sum programme over the lengths left (a bitset of reachable sums, one bit per
token) finds the fullest combination with it, and the combination is taken as often as the
lengths last. Each combination uses up a length or leaves too few of one to repeat, so the plan is
bounded by ``capacity`` too and may be broadcast.

Pieces then get a rank within their length, and the plan says which sequence and place each rank
has. Ranks are counted in blocks, so a length that a third of all pieces have takes many tasks.

A document's ids are its text's ids and one closing 0; a null text is an empty one. Longer
documents are cut so that only the first piece is short of ``capacity``. Equal rows are packed
like any others; extra columns stay.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from base64 import b64decode
from collections.abc import Iterator
from functools import cached_property, lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.llm.common import ROWS_PER_BLOCK, blocks_for, free_name, running_total, unit, whole_row
from lapwise.session import durable

CAPACITY = 2048
_CACHE_LIMIT = 150_000
_SPACES = re.compile(r"\s\s")


class Encoder:
    """Ids of texts as little-endian 32-bit words, the same as ``tokenizers`` gives for whole texts.

    No token crosses a single blank, so a text is cut at its blanks, and the ids of each part are
    kept for when it comes again. Parts come from the same vocabulary by its ranks. Texts with
    white space in a row, or a special token's name, go to ``tokenizers`` whole.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str) -> None:
        import tiktoken

        self.vocabulary = vocabulary
        with open(vocabulary, encoding="utf-8") as described:
            self.special = [token["content"] for token in json.load(described)["added_tokens"]]
        with open(ranks, "rb") as lines:
            table = {b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.parts = tiktoken.Encoding("parts", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.known: dict[str, bytes] = {}

    @cached_property
    def whole(self):
        """The tokenizer itself, loaded by the first text that needs it: it takes much memory."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.vocabulary)

    def _learn(self, parts: list[str]) -> None:
        if len(self.known) + len(parts) > _CACHE_LIMIT:
            self.known = {}
        for part in parts:
            if part not in self.known:
                self.known[part] = array("I", self.parts.encode_ordinary(" " + part)).tobytes()

    def __call__(self, text: str) -> bytes:
        if _SPACES.search(text) or any(name in text for name in self.special):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        first, *parts = text.split(" ")
        begin = array("I", self.parts.encode_ordinary(first)).tobytes()
        try:
            return begin + b"".join(map(self.known.__getitem__, parts))
        except KeyError:
            self._learn(parts)
        return begin + b"".join(map(self.known.__getitem__, parts))


@lru_cache(maxsize=2)
def encoder(vocabulary: str, ranks: str, pattern: str) -> Encoder:
    return Encoder(vocabulary, ranks, pattern)


def default_vocabulary() -> tuple[str, str, str]:
    import public_tokenizers

    files = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
    return *map(public_tokenizers.path, files), public_tokenizers.PATTERN


def cut(text: Column | str, capacity: int = CAPACITY, vocabulary: tuple[str, str, str] | None = None) -> Column:
    """``array<struct<start, length, ids_crc32, ids>>``: the pieces of a document, in order."""
    vocabulary = vocabulary or default_vocabulary()
    piece = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    @F.arrow_udf("array<struct<start:bigint,length:bigint,ids_crc32:bigint>>")
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder(*vocabulary)
        for batch in batches:
            found = []
            for value in batch:
                ids = encode(value.as_py() or "") + bytes(4)
                total = len(ids) // 4
                borders = [0, *range((total - 1) % capacity + 1, total + 1, capacity)]
                found.append([
                    {"start": a, "length": b - a, "ids_crc32": zlib.crc32(ids[4 * a:4 * b])}
                    for a, b in zip(borders, borders[1:])
                ])
            yield pa.array(found, pa.list_(piece))

    return pieces(text)


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest combination of available lengths that has the longest of them: length to number."""
    longest = max(counts)
    room = capacity - longest
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        if reach >> room & 1:
            break
        left = min(counts[length] - (length == longest), room // length)
        part = 1
        while left > 0 and not reach >> room & 1:
            part = min(part, left)
            left -= part
            wider = (reach | reach << length * part) & ((2 << room) - 1)
            if wider != reach:
                steps.append((length, part, reach))
                reach = wider
            part *= 2
    total, chosen = reach.bit_length() - 1, {longest: 1}
    for length, part, before in reversed(steps):
        if not before >> total & 1:
            total -= length * part
            chosen[length] = chosen.get(length, 0) + part
    return chosen


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations and how often each is used, until no piece is left."""
    counts, plan = {n: c for n, c in counts.items() if c}, []
    while counts:
        chosen = fullest(counts, capacity)
        times = min(counts[n] // m for n, m in chosen.items())
        plan.append((chosen, times))
        for n, m in chosen.items():
            counts[n] -= m * times
            if not counts[n]:
                del counts[n]
    return plan


def pack(
    pieces: DataFrame, length: str, order: list[str], capacity: int = CAPACITY, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` (with underscores where ``pieces`` has them).

    ``pieces`` must give the same rows when read twice (a stored table or a checkpoint); ``order``
    names columns that tell pieces of one length apart. Lengths are 1 to ``capacity``.
    """
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()}
    rows, sequence, taken = [], 0, dict.fromkeys(counts, 0)
    for chosen, times in plan_bins(counts, capacity):
        offset = 0
        for n, m in sorted(chosen.items(), reverse=True):
            rows.append({"_length": n, "_from": taken[n], "_to": taken[n] + m * times, "_each": m, "_first": sequence, "_at": offset})
            taken[n] += m * times
            offset += n * m
        sequence += times
    names = ["_length", "_from", "_to", "_each", "_first", "_at"]
    # From Arrow, so that the plan holds the rows and Spark knows their size.
    table = pa.Table.from_pylist(rows, pa.schema([(n, pa.int64()) for n in names]))
    ranked = running_total(
        pieces.select(
            whole_row(pieces).alias("doc"), F.col(length).cast("bigint").alias("size"), F.struct(*order).alias("ties"),
            unit(*[F.col(c) for c in order]).alias("place"),
        ),
        ["size"], "place", ["ties"], F.lit(1), "rank", blocks_for(sum(counts.values()), rows_per_block),
    )
    turn = F.col("rank") - 1 - F.col("_from")
    return (
        ranked.join(
            F.broadcast(spark.createDataFrame(table)),
            (F.col("size") == F.col("_length")) & (F.col("rank") > F.col("_from")) & (F.col("rank") <= F.col("_to")),
        )
        .select(
            "doc.*", (F.col("_first") + F.floor(turn / F.col("_each"))).alias(free_name(pieces, "sequence_id")),
            (F.col("_at") + turn % F.col("_each") * F.col("size")).alias(free_name(pieces, "offset")),
        )
    )


def pack_documents(
    docs: DataFrame, text: str, key: str, capacity: int = CAPACITY, vocabulary: tuple[str, str, str] | None = None
) -> DataFrame:
    """One row per piece: ``key``, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = durable(
        docs.select(F.col(key), F.posexplode(cut(text, capacity, vocabulary)).alias("piece", "_p"))
        .select(key, "piece", "_p.start", "_p.length", "_p.ids_crc32")
    )
    return pack(pieces, "length", [key, "piece", "ids_crc32"], capacity)
