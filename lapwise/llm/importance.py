"""Resampling documents towards a target distribution, by hashed n-grams weighed with Arrow kernels.

Texts are lower-cased (A-Z only) and split into words of digits, ``a-z`` and everything beyond ASCII. Features
are all runs of 1 to ``width`` consecutive words, joined by one space; a feature's bucket is the CRC-32 of its UTF-8
bytes modulo ``buckets``. Per batch of texts, words become indices into a dictionary of the batch; a run of n words
is the pair of the run of n - 1 that it begins with and its last word, dictionary-encoded anew. So each
different run is hashed once, from the CRC of its beginning, and everything per occurrence is ``take``,
``bincount`` and sums by segment.

The first pass counts buckets over all documents and over all target texts: a task adds up what it reads and hands
on one row per bucket. Their logarithmic gains (``buckets`` numbers) go with the second pass, which weighs
every document. A hash of the id adds Gumbel noise, so that the highest scores are a draw without replacement;
ranks come from one range sort and the sizes of its partitions, never from a single task.

Null and empty texts have no features and weight 0. A null id is hashed as empty text. Rows that repeat
are rows of their own, ties between them settled arbitrarily but once. Without documents the result
is empty; without target texts the gains follow from the documents alone. A text is always taken whole; batches
are cut by bytes, so only a single text can make one large.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.llm.common import blocks_for
from lapwise.session import durable

_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BYTES_AT_ONCE = 4 << 20
_ROWS_PER_RANGE = 100_000
_MOST_RANGES = 4096


def pieces(texts: pa.Array, most: int = _BYTES_AT_ONCE) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive slices of about ``most`` bytes, each with the place of its first text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, texts[at:end]
        at = end


def runs(texts: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length of run up to ``width``: CRCs of the different runs, and per occurrence the run and its text."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), _BETWEEN_WORDS)
    words, text = pc.list_flatten(lists), pc.list_parent_indices(lists)
    there = pc.greater(pc.binary_length(words), 0)
    encoded = pc.dictionary_encode(words.filter(there))
    text = text.filter(there).to_numpy().astype(np.int64)
    index = encoded.indices.to_numpy().astype(np.int64)
    different = encoded.dictionary.cast(pa.binary() if pa.types.is_string(words.type) else pa.large_binary()).to_pylist()
    spaced = [b" " + word for word in different]
    crcs, run = [zlib.crc32(word) for word in different], index
    for n in range(1, width + 1):
        yield np.array(crcs, np.int64), run, text[:len(run)]
        if n < width:
            # Runs end with their text; the place of one that would go on into the next holds -1.
            inside = (text[n:] == text[:max(len(text) - n, 0)]) & (run[:max(len(text) - n, 0)] >= 0)
            pair = np.where(inside, run[:len(inside)] * len(different) + index[n:], -1)
            both = pc.dictionary_encode(pa.array(pair, mask=~inside))
            begins, last = np.divmod(both.dictionary.to_numpy(), max(len(different), 1))
            crcs = [zlib.crc32(spaced[w], crcs[b]) for b, w in zip(begins.tolist(), last.tolist())]
            run = pc.fill_null(both.indices, -1).to_numpy().astype(np.int64)


def features(texts: pa.Array, width: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of run: bucket and text of every occurrence."""
    for crcs, run, text in runs(texts, width):
        there = run >= 0
        yield (crcs % buckets)[run[there]], text[there]


def bucket_counts(rows: DataFrame, text: str, width: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, part in pieces(batch.column(0)):
                for bucket, _ in features(part, width, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": filled.astype(np.int32), "n": total[filled]})

    texts = rows.select(F.col(text).cast("string"))
    counted = texts.mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    table, total = counted.toArrow(), np.zeros(buckets, np.int64)
    total[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """By bucket, a thousand times the logarithm of how much more often the target has it, floored; one is added to each count."""
    every_source, every_target = float(source.sum() + len(source)), float(target.sum() + len(target))
    ratios = ((target + 1.0) * every_source) / ((source + 1.0) * every_target)
    return np.array([math.floor(1000 * math.log(r)) for r in ratios.tolist()], np.int64)


def _weigh(batches: Iterator[pa.RecordBatch], gain: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1)
        number, total = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for at, part in pieces(texts):
            for bucket, text in features(part, width, len(gain)):
                counts = np.bincount(text, minlength=len(part))
                number[at:at + len(part)] += counts
                # Occurrences come text by text: one sum per segment.
                first = np.flatnonzero(counts)
                begins = np.cumsum(counts)[first] - counts[first]
                if len(first):
                    total[at + first] += np.add.reduceat(gain[bucket], begins)
        weight = np.where(number > 0, total // np.maximum(number, 1), 0)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "n_features": number, "weight": weight})


def noise(doc_id: Column, seed: int) -> Column:
    """A thousand times a Gumbel variate, floored, from the first 32 bits of a hash of ``seed:doc_id``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("bigint")


def resample(
    docs: DataFrame, text: str, doc_id: str, target: DataFrame, target_text: str, percent: int = 25, least_words: int = 20,
    width: int = 2, buckets: int = 10_000, seed: int = 7,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank``: every document, with a rank if it is drawn.

    Of the documents of at least ``least_words`` words, ``percent`` in a hundred are drawn, highest scores first, ties
    to smaller ids.
    """
    source = bucket_counts(docs, text, width, buckets)
    gain = gains(source, bucket_counts(target, target_text, width, buckets))
    kind = docs.schema[doc_id].dataType.simpleString()
    weighed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        partial(_weigh, gain=gain, width=width), f"doc_id {kind}, n_features bigint, weight bigint"
    )
    # A text of n words has n + (n - 1) + ... runs, as far as it has words enough.
    least = sum(max(0, least_words - n) for n in range(width))
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn(
        "enough", F.col("n_features") >= least
    )
    scored = durable(scored)
    there, able = scored.agg(F.count(F.lit(1)), F.count_if("enough")).first()
    order = F.col("enough").desc(), F.col("score").desc(), F.col("doc_id").asc()
    ranges = scored.repartitionByRange(min(_MOST_RANGES, blocks_for(there, _ROWS_PER_RANGE)), *order, F.col("weight"), F.col("n_features"))
    # Sorted once and stored: place holds the number of the range above its lowest 33 bits, and the place inside.
    placed = durable(ranges.sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()))
    in_range = F.shiftright("place", 33)
    sizes = placed.groupBy(in_range.alias("range")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, begins = 0, {}
    for range_, n in sorted(sizes):
        begins[range_], before = before, before + n
    starts = F.array(*[F.lit(begins.get(r, 0)).cast("bigint") for r in range(max(begins, default=0) + 1)])
    rank = F.get(starts, in_range.cast("int")) + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    drawn = F.when(rank <= percent * able // 100, rank)
    return placed.select("doc_id", "n_features", "weight", "score", drawn.alias("rank"))
