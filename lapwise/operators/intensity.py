"""Workout intensity of each lap, matched through workout step numbers.

Per file, two lists in file order: intensities (nulls left out) and step numbers of all
messages that carry them. Distinct steps, in order of first appearance, pair with
intensities by position; each occurrence of a paired step then stands for one lap, if
there are as many occurrences as laps. When intensities are fewer than steps, a missing
step number takes no intensity and moves those behind it one place on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lapwise.operators.skew import MEASURED, heavy_join, measured, running, totals


def align_intensity(
    messages: DataFrame,
    laps: DataFrame,
    key: str = "file",
    seq: str = "seq",
    number: str = "number",
    min_rows: float | None = None,
) -> DataFrame:
    """``laps`` with ``intensity``.

    ``messages`` has ``key, seq, has_intensity, intensity, has_step, step``; the flags say
    whether the message carries the field at all. ``laps`` numbers its laps from 1. Files
    are counted once: with no hot file among ``messages``, nothing below can be hot.
    """
    min_rows = measured(messages, [key], min_rows)
    if min_rows == MEASURED:
        by_lap = _by_lap(messages, key, seq)
    else:
        by_lap = _by_lap_hot(messages, key, seq, min_rows)
    by_lap = by_lap.select(key, F.col("_nth").cast(laps.schema[number].dataType).alias(number), "_taken", "intensity")
    counted = totals(laps.drop("intensity"), [key], {"_laps": ("count", F.lit(1))}, min_rows)
    return (
        counted.join(by_lap, [key, number], "left")
        .withColumn("intensity", F.when(F.col("_taken") == F.col("_laps"), F.col("intensity")))
        .drop("_taken", "_laps")
    )


def _by_lap(messages: DataFrame, key: str, seq: str) -> DataFrame:
    """``_by_lap_hot`` where no file is hot: all steps are windows within files, so one scan and one exchange do."""
    no = {c: F.lit(None).cast(messages.schema[c].dataType).alias(c) for c in ("intensity", "step")}
    uses = F.array(
        F.struct(F.col("has_intensity").alias("_use"), F.lit(False).alias("_shown"), "intensity", no["step"]),
        F.struct(F.col("has_step").alias("_use"), F.lit(True).alias("_shown"), no["intensity"], "step"),
    )
    rows = messages.where(F.col(key).isNotNull()).select(key, seq, F.inline(uses)).where("_use").drop("_use")

    def over(*more: str) -> WindowSpec:
        return Window.partitionBy(key, *more)

    so_far = over("_shown").orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Whole files first, as they are dealt for the first window. Only files that carry the field pair anything at all.
    rows = rows.withColumns({"_words": F.count("intensity").over(over()), "_carries": F.max(~F.col("_shown")).over(over())})
    rows = rows.where("_carries").drop("_carries")
    rows = rows.withColumn("_nth_word", F.count("intensity").over(so_far) - 1)
    rows = rows.withColumn("_seen", F.min(seq).over(over("_shown", "step")))
    rows = rows.withColumn("_place", F.dense_rank().over(over("_shown").orderBy("_seen", "step")) - 1)
    rows = rows.withColumns({
        "_steps": F.max(F.when(F.col("_shown"), F.col("_place") + 1)).over(over()),
        "_null_place": F.min(F.when(F.col("_shown") & F.col("step").isNull(), F.col("_place"))).over(over()),
    })
    rows = _with_modes(rows).withColumn("_pairs", F.col("_shown") & _takes_part()).withColumn(
        "_word", F.when(F.col("_pairs"), _word()).when(F.col("intensity").isNotNull(), F.col("_nth_word"))
    )
    rows = rows.withColumn("intensity", F.max("intensity").over(over("_word"))).where("_pairs")
    return rows.select(
        key, F.row_number().over(over().orderBy(seq)).alias("_nth"), F.count(F.lit(1)).over(over()).alias("_taken"),
        F.when(F.col("_word").isNotNull(), F.col("intensity")).alias("intensity"),
    )


def _by_lap_hot(messages: DataFrame, key: str, seq: str, min_rows: float) -> DataFrame:
    """Occurrences of paired steps with their number ``_nth`` in the file, how many are ``_taken``, and ``intensity``."""
    carried = messages.where("has_intensity AND intensity IS NOT NULL").select(key, seq, "intensity")
    shown = messages.where("has_step").select(key, seq, "step")

    words = _places(carried, key, seq, min_rows).select(key, F.col("_place").alias("_word"), "intensity")
    steps = distinct_in_order(shown, key, "step", seq, min_rows)

    steps = totals(
        steps, [key],
        {"_steps": ("count", F.lit(1)), "_null_place": ("min", F.when(F.col("step").isNull(), F.col("_place")))},
        min_rows,
    )
    # Only files that carry the field pair anything at all.
    word_counts = messages.where("has_intensity").groupBy(key).agg(F.count("intensity").alias("_words"))
    paired = (
        _with_modes(heavy_join(steps, word_counts, [key], "inner", min_rows))
        .where(_takes_part())
        .withColumn("_word", _word())
        .join(words, [key, "_word"], "left")
        .select(key, _null_safe("step"), "intensity")
    )
    taken = heavy_join(shown.withColumn("_step", _null_safe("step")), paired, [key, "_step"], "inner", min_rows)
    numbered = running(taken, [key], [seq], {"_nth": ("count", F.lit(1))}, min_rows=min_rows)
    return totals(numbered, [key], {"_taken": ("count", F.lit(1))}, min_rows)


def _takes_part() -> Column:
    """Whether a step, after ``_with_modes``, pairs with a word or with the place left open."""
    real = F.col("step").isNotNull() | F.col("_padded") | F.col("_only_null")
    return real & (F.col("_place") < F.col("_paired"))


def _word() -> Column:
    """Place of the word that a step takes: words behind the padded place have moved one on; the place itself has none."""
    straight = ~F.col("_padded") | (F.col("_place") < F.col("_null_place"))
    return F.when(straight, F.col("_place")).when(F.col("_place") > F.col("_null_place"), F.col("_place") - 1)


def distinct_in_order(
    df: DataFrame, key: str, value: str, seq: str, min_rows: float | None = None
) -> DataFrame:
    """Distinct values per ``key``, with ``_place`` from 0 in order of first appearance."""
    first_seen = df.groupBy(key, value).agg(F.min(seq).alias("_seen"))
    return _places(first_seen, key, "_seen", min_rows)


def _places(df: DataFrame, key: str, seq: str, min_rows: float | None) -> DataFrame:
    """Position in the list of the file, from 0."""
    return running(df, [key], [seq], {"_place": ("count", F.lit(1))}, min_rows=min_rows).withColumn(
        "_place", F.col("_place") - 1
    )


def _null_safe(name: str):
    """A join key that lets a missing step meet a missing step."""
    return F.coalesce(F.col(name).cast("string"), F.lit("none")).alias("_step")


def _with_modes(steps: DataFrame) -> DataFrame:
    """How each file pairs, from list lengths and the place of the missing step."""
    return (
        steps.withColumn("_only_null", (F.col("_steps") == 1) & F.col("_null_place").isNotNull())
        .withColumn(
            "_padded",
            (F.col("_words") < F.col("_steps")) & F.col("_null_place").isNotNull() & ~F.col("_only_null"),
        )
        .withColumn(
            "_paired",
            F.when(F.col("_padded"), F.greatest(F.col("_words"), F.col("_null_place")) + 1).otherwise(F.col("_words")),
        )
    )
