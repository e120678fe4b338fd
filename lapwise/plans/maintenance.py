"""Corrections to stored tables, in place: only the loads that hold a changed row get new files, for that table alone.

The change shows all at once, when the ledger names the new files; broken off before, the store is as it was.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.functions import names
from lapwise.operators.laps import number_in_order
from lapwise.sinks.contract import conform
from lapwise.sinks.load import POWER, backfill_power, update_pool
from lapwise.sources.messages import message_rows
from lapwise.sources.tables import FITS, LOAD, Store


def refresh_pool(
    store: Store, messages: DataFrame, id_of: Callable[[Column], Column] = names.activity_id
) -> list[str]:
    """Give ``session`` the pool lengths and units that the files of ``messages`` have; the loads that changed.

    ``id_of`` says which activity a file is: ``names.made_id`` for stores of watch files.
    """
    decoded = message_rows(messages, "session").select(
        id_of(F.col("file")).alias("activity_id"),
        "file", "seq", "sub_sport", F.col("pool_length").try_cast("double").alias("pool_length"), "pool_length_unit",
    )
    return _correct(
        store, "session", ["pool_length", "pool_length_unit"], lambda rows: update_pool(rows, decoded, ["file", "seq"])
    )


def refresh_power(
    store: Store, messages: DataFrame, id_of: Callable[[Column], Column] = names.activity_id
) -> list[str]:
    """Fill missing power values of ``lap`` from the files of ``messages``; ``id_of`` as for the pool."""
    numbered = number_in_order(message_rows(messages, "lap"), "file", ["seq"])
    decoded = conform(
        numbered.withColumn("activity_id", id_of(F.col("file"))), "lap"
    )
    return _correct(store, "lap", POWER, lambda rows: backfill_power(rows, decoded, ["start_time"]))


def _correct(
    store: Store, table: str, values: list[str], correct: Callable[[DataFrame], DataFrame]
) -> list[str]:
    """Apply ``correct``, which changes ``values`` of rows and keeps all columns, to the loads where it changes any."""
    before = F.struct(*values)
    corrected = correct(store.with_loads(table).where(FITS).withColumn("_before", before))
    loads = [r[0] for r in corrected.where(~F.col("_before").eqNullSafe(before)).select(LOAD).distinct().collect()]
    if loads:
        rows = store.with_loads(table, loads)
        store.amend({table: correct(rows.where(FITS)).unionByName(rows.where(~F.col(FITS)))}, loads, f"{table} corrected")
    return loads
