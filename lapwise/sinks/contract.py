"""Typed rows for a table, and the rows that cannot become one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.schemas import TEXT_LIMITS, columns

REASONS = "reasons"
RAW = "raw"


def to_type(c: Column, kind: str, source: str) -> Column:
    """``c`` as ``kind``; null where it does not fit. Whole numbers round halves away from 0."""
    if source in {"double", "float"}:
        c = F.when(~F.isnan(c), c)
    if kind in {"smallint", "int", "bigint"} and source not in {"smallint", "int", "bigint"}:
        exact = c.try_cast("bigint") if source == "string" else F.lit(None).cast("bigint")
        return F.coalesce(exact, F.round(c.try_cast("decimal(38,6)"), 0)).try_cast(kind)
    if kind == "double":
        number = c.try_cast("double")
        return F.when(~F.isnan(number), number)
    if kind == "timestamp" and source == "string":
        return F.try_to_timestamp(c)
    if kind == "timestamp_ntz" and source == "string":
        # What the clock showed; a zone is dropped.
        return c.try_cast("timestamp_ntz")
    if kind == "string" and source == "string":
        return F.rtrim(c)
    return c.try_cast(kind)


def checked(df: DataFrame, table: str, keep: list[str] = ()) -> DataFrame:
    """``df`` with the table's columns and types, plus ``reasons``: the columns that do not fit, or an empty text.

    Columns the frame lacks are null, columns the table lacks are dropped but for ``keep``.
    """
    have = dict(df.dtypes)
    layout = columns(table)
    limits = TEXT_LIMITS[table]
    typed, names, faults = {}, [], []
    for name, kind in layout:
        if name not in have:
            names.append(F.lit(None).cast(kind).alias(name))
            continue
        # Typed in a step of its own, so that the checks below do not type it anew.
        typed[f"_t_{name}"] = to_type(F.col(name), kind, have[name])
        value = F.col(f"_t_{name}")
        given = F.col(name).isNotNull()
        if have[name] in {"double", "float"}:
            given = given & ~F.isnan(name)
        elif have[name] == "string":
            given = given & (F.lower(name) != "nan")
        bad = given & value.isNull()
        if name in limits:
            bad = bad | (F.length(value) > limits[name])
        names.append(value.alias(name))
        faults.append(F.when(bad, F.lit(name)))
    if "activity_id" not in have:
        raise ValueError(f"rows for {table} need an activity_id")
    faults.append(F.when(F.col("activity_id").isNull(), F.lit("activity_id")))
    return df.withColumns(typed).select(*keep, *names, F.concat_ws(",", *faults).alias(REASONS))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Rows in the table's columns and types; values that do not fit become null."""
    return checked(df, table).drop(REASONS)


def with_raw(df: DataFrame, table: str) -> DataFrame:
    """``checked`` rows; those with ``reasons`` also keep the row as it came, as JSON in ``raw``.

    Writing JSON costs more than all the checks, so it is left to rows that need it.
    """
    tested = checked(df.withColumn("_came", F.struct(*df.columns)), table, keep=["_came"])
    return tested.select(
        F.when(F.col(REASONS) != "", F.to_json("_came")).alias(RAW), *[c for c in tested.columns if c != "_came"]
    )


def split(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Rows that fit, typed; and the others as they came, with ``reasons``.

    A load that needs both reads its input once by writing ``with_raw`` rows instead.
    """
    tested = with_raw(df, table)
    good = tested.where(F.col(REASONS) == "").drop(REASONS, RAW)
    bad = tested.where(F.col(REASONS) != "").select("activity_id", REASONS, RAW)
    return good, bad
