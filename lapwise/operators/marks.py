"""Incremental filters: how far earlier loads came, and what lies beyond."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.functions.values import NO_ACTIVITY_YET
from lapwise.schemas import DAY


def _moment(now: datetime | None) -> Column:
    """``now`` as a literal; a time without a zone is UTC."""
    if now is None:
        return F.current_timestamp()
    if now.tzinfo is None:
        now = now.replace(tzinfo=timezone.utc)
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit((now - epoch) // timedelta(microseconds=1)))


def high_water(activities: DataFrame, now: datetime | None = None, time: str = "timestamp") -> DataFrame:
    """One row, ``after``: the latest activity time before ``now``, or 1900-01-01 12:00 UTC."""
    default = F.to_timestamp(F.lit(NO_ACTIVITY_YET))
    return activities.where(F.col(time) < _moment(now)).agg(F.coalesce(F.max(time), default).alias("after"))


def high_water_date(activities: DataFrame, today: date | None = None, time: str = "timestamp") -> DataFrame:
    """One row, ``after``: the latest activity date up to ``today``; null without one."""
    # Compared with the next midnight, so the filter reaches the scan.
    midnight = F.date_add(F.current_date() if today is None else F.lit(today), 1).cast(activities.schema[time].dataType)
    return activities.where(F.col(time) < midnight).agg(F.to_date(F.max(time)).alias("after"))


def newer_files(
    files: DataFrame, file_time: Column, after: datetime, now: datetime | None = None, until_now: bool = False
) -> DataFrame:
    """Rows whose file time is past ``after`` and, on request, not past ``now``.

    Rows stored by ``day`` (that of the file time) are read from the mark's day on only.
    """
    keep = file_time > _moment(after)
    if until_now:
        keep = keep & (file_time <= _moment(now))
    if DAY in files.columns:
        utc = after.astimezone(timezone.utc) if after.tzinfo else after
        keep = keep & (F.col(DAY) >= F.lit(utc.date()))
    return files.where(keep)


def untimed(files: DataFrame, file_time: Column) -> DataFrame:
    """Rows whose file name holds no time; they are stored without a day."""
    return files.where(file_time.isNull() & F.col(DAY).isNull() if DAY in files.columns else file_time.isNull())
