"""Long repeated strings across all documents, by prefix-free parsing.

A text is parsed at triggers: places whose 32-byte rolling hash is the smallest of some 69 places in
a row. Every string of 100 bytes has 69 such places, so it holds a whole trigger string, chosen by
the string's own bytes alone: equal strings hold it at the same place. So a trigger string and
what stands around it (its context: 68 bytes before, 100 from it on) decide all strings of 100 bytes
that hold it, and a trigger string that occurs once in the corpus repeats nothing.

1. Each trigger gives the hash of its string and of its context. Occurrences with the same context
   repeat each other whole; all but the first are marked. Within a batch of documents they are
   marked at once and only the first goes on, so frequent passages stay small in the shuffle.
2. Trigger strings with several contexts are the borders of repeats. Their distinct contexts form a
   dictionary. It is sorted twice: by what comes before the trigger, read backwards, and by what follows
   (suffix orders of the dictionary and of the parse, with the lengths neighbours have in common).
   A string that starts d bytes before its trigger is a class of the first order at depth d joined
   with a class of the second at depth 100 - d; all but the first of each joined class are marked.
3. Marks meet the texts: every byte under a marked string is removed.

Only contexts of strings that repeat with differing surroundings are sorted; the suffix order of the
rest of the corpus would say nothing more about repeats. Sorting takes tasks of about
``contexts_per_task``. A trigger string with more than ``most_contexts`` contexts does not fit one: its
strings are compared by 128-bit hashes as single rows instead, with the same result.

First means: smaller key, nulls before all, then earlier start. Keys that are no whole numbers are ordered as text.
Rows with the same key and text are one document and get the same result; of rows with the same key and other texts
one is before the other. Texts of one key are told apart by 95 bits of hash: of n such texts two are taken
for one with a chance below n * n / 2 ** 95. Contexts are compared by 64 bits among those of equal trigger strings, whose own
hash has 64 more. Null texts are empty, texts below 100 bytes keep all. Texts are read in stretches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.llm.common import free_name, whole_row
from lapwise.session import durable

LENGTH = 100
TRIGGER = 32
BEFORE = LENGTH - TRIGGER  # most bytes of a string before its trigger
CONTEXTS_PER_TASK = 50_000
MOST_CONTEXTS = 100_000
_STRETCH = 1 << 20
_NO_KEY = -(1 << 63)
_MULTIPLIERS = np.random.default_rng(20240402).integers(0, 1 << 62, 16, np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray, i: int) -> np.ndarray:
    x = x * _MULTIPLIERS[i]
    return x ^ (x >> np.uint64(31))


def _over(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        values = pick(values[:-have], values[have:])
        have *= 2
    return pick(values[:len(values) - (width - have)], values[width - have:]) if have < width else values


def triggers(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the triggers, hashes of their strings, hashes of their contexts."""
    found = [_triggers_of(data, at, min(at + _STRETCH, len(data))) for at in range(0, len(data), _STRETCH)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(parts) for parts in zip(*found))


def _triggers_of(data: bytes, begin: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low, high = max(0, begin - 2 * LENGTH), min(len(data), end + 2 * LENGTH)
    if high - low < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    # Bytes count from 1; 0 stands for what lies outside the document.
    levels = [np.zeros(high - low + 2 * LENGTH, np.uint64)]
    levels[0][LENGTH:-LENGTH] = np.frombuffer(data, np.uint8, high - low, low)
    levels[0][LENGTH:-LENGTH] += np.uint64(1)
    for i in range(5):
        last, step = levels[-1], 1 << i
        levels.append(_mixed(last[:-step], i) + last[step:])
    eight, full = levels[3], levels[5]
    inside = _mixed(full[LENGTH:len(full) - LENGTH], 5)
    least = _over(inside, BEFORE + 1, np.minimum)
    edge = np.zeros(BEFORE, np.uint64)
    chosen = np.flatnonzero(_over(np.concatenate([edge, least, edge]), BEFORE + 1, np.maximum) == inside)
    chosen = chosen[(chosen + low >= begin) & (chosen + low < end)]
    at = chosen + LENGTH - BEFORE
    context = np.zeros(len(at), np.uint64)
    for i in range(5):
        context = _mixed(context + full[at + 32 * i], 6 + i)
    context = _mixed(context + eight[at + 160], 11)
    return chosen + low, inside[chosen], context


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigger occurrences of ``key, mark, more, alone, text`` rows.

    Those whose context comes earlier in the batch are repeats already: a document's are one row of ``places``, under ``alone``,
    a string of its own. Of equal rows in a batch one is read; equal rows of several batches give equal occurrences.
    """
    for batch in batches:
        keys, order_of = batch.column(0), _ranks(batch.column(0))
        marks, mores, alone = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2, 3))
        parts, last = [], None
        for n in np.lexsort([mores, marks, order_of]).tolist():
            value = batch.column(4)[n]
            data = value.as_buffer().to_pybytes() if value.is_valid else b""
            if last == (order_of[n], data):
                continue
            last = order_of[n], data
            places, strings, contexts = triggers(data)
            parts.append((np.full(len(places), n, np.int32), places.astype(np.int32), strings, contexts))
        if not parts:
            continue
        row, place, string, context = (np.concatenate(p) for p in zip(*parts))
        del parts
        # Stable, so the first of equals is the earliest.
        order = np.lexsort([context, string])
        same = np.ones(max(len(order) - 1, 0), bool)
        for part in (string, context):
            sorted_ = part[order]
            same &= sorted_[1:] == sorted_[:-1]
        done = np.zeros(len(order), bool)
        done[order[1:][same]] = True
        del order, same, sorted_
        fresh = ~done
        begins = np.flatnonzero(np.diff(row[done], prepend=-1))
        owners, sizes = row[done][begins], np.diff(np.append(begins, done.sum()))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(place[done]))
        rows = np.concatenate([row[fresh], owners])
        nothing = np.zeros(len(owners), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([string[fresh].view(np.int64), alone[owners]])),
                pa.array(np.concatenate([context[fresh].view(np.int64), nothing])),
                keys.take(pa.array(rows)), pa.array(marks[rows]),
                pa.array(mores[rows] << 32 | np.concatenate([place[fresh], nothing])),
                pa.concat_arrays([pa.nulls(int(fresh.sum()), lists.type), lists]),
            ],
            ["string", "context", "key", "mark", "at", "places"],
        )


def _ranks(keys: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The order of keys of any kind, nulls first."""
    return pc.rank(keys, "ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)


def _borders(left: np.ndarray, string: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort order of the rows of ``left`` within a string, and how many bytes each has in common with the one before."""
    width = -left.shape[1] % 8
    words = np.pad(left, ((0, 0), (0, width))).view(">u8")
    order = np.lexsort([*words.T[::-1], string])
    rows = left[order]
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), left.shape[1])
    common[string[order][1:] != string[order][:-1]] = -1
    return order, np.concatenate([[-1], common])


def repeated_starts(string: np.ndarray, before: list[bytes], after: list[bytes]) -> np.ndarray:
    """Which strings (row: context, column: bytes before the trigger) occur in an earlier row.

    Rows are contexts in order of their place; ``before`` has up to 68 bytes, ``after`` up to 100.
    """
    rows = len(string)
    sizes = np.array([[len(b), len(a)] for b, a in zip(before, after)])
    left = np.frombuffer(b"".join(b[::-1].ljust(BEFORE, b"\0") for b in before), np.uint8).reshape(rows, BEFORE)
    right = np.frombuffer(b"".join(a.ljust(LENGTH, b"\0") for a in after), np.uint8).reshape(rows, LENGTH)
    (by_left, same_left), (by_right, same_right) = _borders(left, string), _borders(right, string)
    repeated = np.zeros((rows, BEFORE + 1), bool)
    left_class, right_class = np.empty(rows, np.int64), np.empty(rows, np.int64)
    for depth in range(BEFORE + 1):
        left_class[by_left] = np.cumsum(same_left < depth)
        right_class[by_right] = np.cumsum(same_right < LENGTH - depth)
        there = np.flatnonzero((sizes[:, 0] >= depth) & (sizes[:, 1] >= LENGTH - depth))
        joined = right_class[there] * (rows + 1) + left_class[there]
        again = np.ones(len(there), bool)
        again[np.unique(joined, return_index=True)[1]] = False
        repeated[there[again], depth] = True
    return repeated


def _sorted_contexts(table: pa.Table) -> pa.Table:
    """Ranges of marked starts, from a task's contexts."""
    order = np.lexsort([table["at"].to_numpy(), table["mark"].to_numpy(), _ranks(table["key"].combine_chunks())])
    table = table.take(pa.array(order))
    mark, at = table["mark"].to_numpy(), table["at"].to_numpy()
    repeated = repeated_starts(
        table["string"].to_numpy(), table["before"].to_pylist(), table["after"].to_pylist()
    )
    # Runs of depths, as ranges of starts.
    edges = np.diff(np.pad(repeated.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edges == 1)
    last = np.nonzero(edges == -1)[1] - 1
    place = at[row] & 0xFFFFFFFF
    return pa.table({
        "key": table["key"].take(pa.array(row)), "mark": mark[row], "more": at[row] >> 32, "low": place - last, "high": place - first,
    })


def _contexts(text: Column, wanted: Column) -> Column:
    kind = pa.struct([("string", pa.int64()), ("at", pa.int64()), ("hot", pa.bool_()), ("before", pa.binary()), ("after", pa.binary())])

    @F.arrow_udf("array<struct<string:bigint,at:bigint,hot:boolean,before:binary,after:binary>>")
    def cut_out(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, places in batches:
            rows = []
            for value, many in zip(texts, places):
                data = value.as_buffer().to_pybytes() if value.is_valid else b""
                row = []
                for one in many.as_py():
                    p = one["at"] & 0xFFFFFFFF
                    row.append({**one, "before": data[max(0, p - BEFORE):p], "after": data[p:p + LENGTH]})
                rows.append(row)
            yield pa.array(rows, pa.list_(kind))

    return cut_out(text, wanted)


def _single_strings(before: Column, after: Column) -> Column:
    """``array<struct<depth, high, low>>``: every string of a context by its hash."""
    kind = pa.struct([("depth", pa.int64()), ("high", pa.int64()), ("low", pa.int64())])

    @F.arrow_udf("array<struct<depth:bigint,high:bigint,low:bigint>>")
    def hashed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for lefts, rights in batches:
            rows = []
            for b, a in zip(lefts.to_pylist(), rights.to_pylist()):
                depths = range(max(0, LENGTH - len(a)), len(b) + 1)
                digests = [xxhash.xxh3_128_digest(b[len(b) - d:] + a[:LENGTH - d]) for d in depths]
                pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2).tolist()
                rows.append([{"depth": d, "high": h, "low": w} for d, (h, w) in zip(depths, pairs)])
            yield pa.array(rows, pa.list_(kind))

    return hashed(before, after)


def spans(size: int, places: np.ndarray, ranges: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of bytes under marked strings: around marked triggers and at ranges of starts."""
    steps = np.zeros(size + 1, np.int32)
    low, high = np.maximum(places - BEFORE, 0), np.minimum(places, size - LENGTH)
    low = np.concatenate([low, [r["low"] for r in ranges]]).astype(np.int64)
    high = np.concatenate([high, [r["high"] for r in ranges]]).astype(np.int64)
    np.add.at(steps, low, 1)
    np.add.at(steps, high + LENGTH, -1)
    covered = np.pad((np.cumsum(steps[:-1]) > 0).astype(np.int8), 1)
    edges = np.diff(covered)
    return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))


def _removed(text: Column, places: Column, ranges: Column) -> Column:
    @F.arrow_udf("array<struct<start:bigint,end:bigint>>")
    def removed(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, marked, more in batches:
            rows = []
            for value, some, many in zip(texts, marked, more):
                some, many = some.as_py() or [], many.as_py() or []
                size = len(value.as_buffer()) if value.is_valid and (some or many) else 0
                found = spans(size, np.array(some, np.int64), many) if size else []
                rows.append([{"start": a, "end": b} for a, b in found])
            yield pa.array(rows, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))

    return removed(text, places, ranges)


def repeated_spans(
    docs: DataFrame, text: str, key: str, contexts_per_task: int = CONTEXTS_PER_TASK, most_contexts: int = MOST_CONTEXTS
) -> DataFrame:
    """``docs`` with ``repeats``, ``array<struct<start, end>>``: bytes under 100-byte strings that started earlier."""
    out = free_name(docs, "repeats")
    whole = docs.schema[key].dataType.typeName() in {"byte", "short", "integer", "long"}
    kind = "bigint" if whole else "string"
    # Without nulls, so that joins stay plain; nulls are before all.
    named = F.coalesce(F.col(key).cast(kind), F.lit(_NO_KEY)) if whole else F.coalesce(F.concat(F.lit("="), F.col(key).cast(kind)), F.lit(""))
    keyed = docs.select(
        whole_row(docs).alias("doc"), named.alias("_key"), F.xxhash64(F.col(text)).alias("_mark"),
        F.xxhash64(F.lit(7), F.col(text)).bitwiseAND(F.lit(0x7FFFFFFF)).alias("_more"),
    )
    own_text, same = F.col("doc")[text], ["key", "mark", "more"]

    def of_doc(prefix: str = "") -> Column:
        mine = F.col("_key") == F.col(f"{prefix}key")
        return mine & (F.col("_mark") == F.col(f"{prefix}mark")) & (F.col("_more") == F.col(f"{prefix}more"))

    found = keyed.select("_key", "_mark", "_more", F.xxhash64("_key", "_mark", "_more"), own_text.alias("text")).mapInArrow(
        _occurrences, f"string bigint, context bigint, key {kind}, mark bigint, at bigint, places array<int>"
    ).repartition("string")
    of_string = Window.partitionBy("string")
    # Occurrences of one key, mark and place are of equal rows, none before the other.
    first = Window.partitionBy("string", "context").orderBy("key", "mark", "at")
    ranked = (
        found.withColumn("turn", F.rank().over(first))
        .withColumn("mixed", F.min("context").over(of_string) != F.max("context").over(of_string))
        .withColumn("many", F.count(F.lit(1)).over(of_string))
    )
    done, again = F.col("places").isNotNull(), F.col("turn") > 1
    border = F.struct("string", "at", (F.col("many") > most_contexts).alias("hot"))
    later = F.when(~done & again, F.array(F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")))
    marks = durable(
        ranked.where(done | again | F.col("mixed"))
        .groupBy("key", "mark", F.shiftright("at", 32).alias("more"))
        .agg(
            F.array_distinct(F.flatten(F.collect_list(F.coalesce("places", later)))).alias("places"),
            F.collect_set(F.when(~done & ~again, border)).alias("borders"),
        )
    )
    contexts = (
        keyed.select("_key", "_mark", "_more", own_text.alias("text")).dropDuplicates(["_key", "_mark", "_more"])
        .join(marks.where(F.size("borders") > 0), of_doc())
        .select("key", "mark", F.explode(_contexts(F.col("text"), F.col("borders"))).alias("c")).select("key", "mark", "c.*")
    )
    contexts = durable(contexts)
    total = contexts.count()
    task = F.pmod(F.xxhash64("string"), F.lit(max(1, -(-total // contexts_per_task))))
    ranges = (
        contexts.where("not hot").select(task.alias("task"), "string", "key", "mark", "at", "before", "after")
        .groupBy("task").applyInArrow(_sorted_contexts, f"key {kind}, mark bigint, more bigint, low bigint, high bigint")
    )
    # A string is named by its start: its other triggers name the same string.
    begins = (F.col("at") - F.col("s.depth")).alias("begin")
    hot = contexts.where("hot").select("key", "mark", "at", F.explode(_single_strings(F.col("before"), F.col("after"))).alias("s"))
    hot = hot.select("key", "mark", begins, "s.high", "s.low")
    start = F.struct("key", "mark", "begin")
    earliest = hot.groupBy("high", "low").agg(F.min(start).alias("first"))
    later = hot.join(earliest, ["high", "low"]).where(~start.eqNullSafe(F.col("first")))
    place = F.col("begin").bitwiseAND(F.lit(0xFFFFFFFF))
    single = later.select("key", "mark", F.shiftright("begin", 32).alias("more"), place.alias("low"), place.alias("high"))
    by_doc = ranges.unionByName(single).groupBy(*same).agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    all_marks = marks.drop("borders").join(by_doc, same, "left")
    all_marks = all_marks.toDF(*[f"_m_{c}" for c in all_marks.columns])
    return (
        keyed.join(all_marks, of_doc("_m_"), "left")
        .select("doc.*", _removed(own_text, F.col("_m_places"), F.col("_m_ranges")).alias(out))
    )


def kept(text: Column, repeats: Column) -> Column:
    """The bytes of a text that are left."""

    @F.arrow_udf("binary")
    def rest(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, cuts in batches:
            rows = []
            for value, found in zip(texts, cuts.to_pylist()):
                data, at, parts = value.as_buffer().to_pybytes() if value.is_valid else b"", 0, []
                for span in found:
                    parts.append(data[at:span["start"]])
                    at = span["end"]
                rows.append(b"".join([*parts, data[at:]]))
            yield pa.array(rows, pa.binary())

    return rest(text, repeats)
