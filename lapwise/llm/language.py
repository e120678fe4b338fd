"""Language identification with hyperdimensional profiles.

Every letter has a random vector of signs. An n-gram's vector binds its letters: each letter's
vector is rotated by its place in the n-gram and they are multiplied. A document's vector bundles
(adds up) the vectors of its n-grams, a language's prototype bundles the vectors of its labelled
documents, each at the same length. The prediction is the prototype with the largest cosine.

Letters are compared in lower case; everything else separates words and counts as one blank. Texts
are read whole, in stretches, so memory does not grow with their length. A null text, and one
without letters, is ``und`` with score 0. Equal texts get equal predictions, and of prototypes
at the same cosine the first language by name wins.

Prototypes come from every labelled document, unless a caller asks for a ``sample``: then from at most about that many, as
many of each language, taken by a hash of key and text. Vectors are rounded to whole numbers before they are added, so the
sum does not depend on the order of tasks. Only the prototypes (languages times dimensions) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.llm.common import unit

UNKNOWN = "und"
DIMENSIONS = 512
_SLOTS = 64  # blank, a to z, and 37 slots that other letters share
_STRETCH = 1 << 20
_UNIT_LENGTH = 10_000
FLOOR_SHARE = 0.02
# The cosine of unlike vectors has a deviation of 1 / sqrt(dimensions); different 3-grams that tell nothing.
_NOISE = 4.0
_FEW = 16


@lru_cache(maxsize=1)
def _slot_table() -> np.ndarray:
    """Slot of every code point of a lower-case text; 0 for what is no letter."""
    slots = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        if chr(point).isalpha():
            slots[point] = point - 96 if 97 <= point <= 122 else 27 + point % 37
    return slots


class _Vectors:
    """Vectors of 3-grams of slots, made when first met."""

    def __init__(self, dimensions: int) -> None:
        signs = np.random.default_rng(20240229).integers(0, 2, (_SLOTS, dimensions), np.int8) * 2 - 1
        self.letters = [np.roll(signs, turn, axis=1).astype(np.int8) for turn in (2, 1, 0)]
        self.row = np.full(_SLOTS**3, -1, np.int32)
        self.known = np.zeros((1024, dimensions), np.int8)
        self.count = 0

    def of(self, grams: np.ndarray) -> np.ndarray:
        fresh = grams[self.row[grams] < 0]
        if len(fresh):
            while self.count + len(fresh) > len(self.known):
                self.known = np.concatenate([self.known, np.zeros_like(self.known)])
            a, b, c = fresh // _SLOTS**2, fresh // _SLOTS % _SLOTS, fresh % _SLOTS
            bound = self.letters[0][a] * self.letters[1][b] * self.letters[2][c]
            self.known[self.count:self.count + len(fresh)] = bound
            self.row[fresh] = np.arange(self.count, self.count + len(fresh))
            self.count += len(fresh)
        return self.known[self.row[grams]]


@lru_cache(maxsize=2)
def _vectors(dimensions: int) -> _Vectors:
    return _Vectors(dimensions)


def _grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The 3-grams of a text and how often each occurs."""
    counts, last = {}, np.zeros(1, np.uint8)
    pieces = []
    for at in range(0, len(text), _STRETCH):
        points = np.frombuffer(text[at:at + _STRETCH].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        slots = np.concatenate([last, _slot_table()[points]])
        if at + _STRETCH >= len(text):
            slots = np.append(slots, np.uint8(0))
        keep = np.ones(len(slots), bool)
        keep[1:] = (slots[1:] != 0) | (slots[:-1] != 0)
        slots = slots[keep].astype(np.int32)
        if len(slots) >= 3:
            pieces.append(np.unique(slots[:-2] * _SLOTS**2 + slots[1:-1] * _SLOTS + slots[2:], return_counts=True))
        last = slots[-2:].astype(np.uint8)
    if len(pieces) == 1:
        grams, number = pieces[0]
    else:
        for some, many in pieces:
            for g, n in zip(some.tolist(), many.tolist()):
                counts[g] = counts.get(g, 0) + n
        grams, number = np.array(list(counts), np.int32), np.array(list(counts.values()), np.int64)
    # " x " aside, a 3-gram with a blank in the middle joins two words and says little.
    middle = grams // _SLOTS % _SLOTS != 0
    return grams[middle], number[middle]


def document_vector(text: str | None, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """The bundled vector; ``None`` if the text has no letters."""
    grams, number = _grams(text or "")
    if not len(grams):
        return None
    return number.astype(np.float32) @ _vectors(dimensions).of(grams).astype(np.float32)


@dataclass(frozen=True)
class Profiles:
    languages: tuple[str, ...]
    prototypes: np.ndarray  # one row per language, each of length 1
    floors: tuple[float, ...] = ()  # the score below which a text is unlike a language

    def predict(self, text: str | None) -> tuple[str, float]:
        vector = document_vector(text, self.prototypes.shape[1]) if self.languages else None
        length = 0.0 if vector is None else float(np.linalg.norm(vector))
        if not length:
            return UNKNOWN, 0.0
        cosines = self.prototypes @ vector.astype(np.float64) / length
        best = int(np.argmax(cosines))
        return self.languages[best], float(min(1.0, max(0.0, cosines[best])))

    def own(self, text: str | None, name: str) -> float | None:
        """The cosine with one language; ``None`` where 3-grams are too few to tell."""
        known = name in self.languages and len(_grams(text or "")[0]) >= _FEW
        vector = document_vector(text, self.prototypes.shape[1]) if known else None
        length = 0.0 if vector is None else float(np.linalg.norm(vector))
        return float(self.prototypes[self.languages.index(name)] @ vector.astype(np.float64)) / length if length else None

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """The prediction, and whether the text has letters and is not unlike every language."""
        name, score = self.predict(text)
        if name in self.languages and self.floors and score >= max(self.floors[self.languages.index(name)], 1e-9):
            return name, score, True
        different = len(_grams(text or "")[0])
        # Without floors there is nothing to compare with; a few 3-grams do not tell.
        return name, score, 0 < different and (not any(self.floors) or different < _FEW)


def fit(labelled: DataFrame, text: str, lang: str, key: str, sample: int | None = None, dimensions: int = DIMENSIONS) -> Profiles:
    """Prototypes of the languages in ``labelled``; rows without a language take no part."""
    labelled = labelled.where(F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).cast("string").alias("key")
    )
    counts = {} if sample is None else {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if sample is not None and sum(counts.values()) > sample:
        # The same number of each language, all of a rare one.
        each = sample / len(counts)
        part = F.create_map(*[F.lit(x) for name, rows in counts.items() for x in (name, each / rows)])
        chance = unit(F.coalesce("key", F.lit("")), F.coalesce("text", F.lit("")), F.lit("language sample"))
        labelled = labelled.where(chance < part[F.col("lang")])

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, name in zip(batch.column(0), batch.column(1).to_pylist()):
                vector = document_vector(value.as_py(), dimensions)
                if vector is not None and (length := np.linalg.norm(vector)):
                    whole = np.rint(vector * (_UNIT_LENGTH / length)).astype(np.int64)
                    sums[name] = sums[name] + whole if name in sums else whole
        for name, total in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [name], "total": [total.tolist()]})

    found = (
        labelled.select("text", "lang").mapInArrow(bundle, "lang string, total array<bigint>")
        .select("lang", F.posexplode("total").alias("at", "part"))
        .groupBy("lang", "at").agg(F.sum("part").alias("part"))
        .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("parts"))
        .select("lang", "parts.part").collect()
    )
    found = sorted((r["lang"], np.array(r["part"], np.float64)) for r in found if any(r["part"]))
    if not found:
        return Profiles((), np.zeros((0, dimensions)))
    return Profiles(tuple(n for n, _ in found), np.stack([v / np.linalg.norm(v) for _, v in found]))


def judge_language(text: Column | str, profiles: Profiles) -> Column:
    """``struct<lang, score, like>`` of a text column; ``like`` is false for texts unlike every language."""

    @F.arrow_udf("struct<lang:string,score:double,like:boolean>")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [profiles.judge(value.as_py()) for value in batch]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[2] for f in found], pa.bool_())],
                ["lang", "score", "like"],
            )

    return judged(text)


def predict_language(text: Column | str, profiles: Profiles) -> Column:
    """``struct<lang, score>`` of a text column."""

    @F.arrow_udf("struct<lang:string,score:double>")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [profiles.predict(value.as_py()) for value in batch]
            yield pa.StructArray.from_arrays(
                [pa.array([n for n, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                ["lang", "score"],
            )

    return predicted(text)


def with_floors(profiles: Profiles, labelled: DataFrame, text: str, lang: str, share: float = FLOOR_SHARE) -> Profiles:
    """``profiles`` with a floor for each language: the ``share`` quantile of its own documents' cosines, at most ``_NOISE``.

    Noise has cosines of some 1 / sqrt(dimensions) in size, so four times that bounds it; documents of a language
    that score less lower its floor; those too short to tell take no part. Learned from every labelled document.
    """
    if not profiles.languages:
        return profiles
    labelled = labelled.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))

    @F.arrow_udf("double")
    def own_score(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, names in batches:
            yield pa.array([profiles.own(v.as_py(), n) for v, n in zip(texts, names.to_pylist())], pa.float64())

    low = (
        labelled.select("lang", own_score("text", "lang").alias("score")).where("score IS NOT NULL")
        .groupBy("lang").agg(F.percentile_approx("score", share, 10_000).alias("low")).collect()
    )
    low = {r["lang"]: r["low"] for r in low}
    noise = _NOISE / profiles.prototypes.shape[1] ** 0.5
    return replace(profiles, floors=tuple(max(0.0, min(noise, low.get(n, 0.0))) for n in profiles.languages))
