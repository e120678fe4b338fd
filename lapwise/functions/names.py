"""What file names say: activity id, time, and which files belong together."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def activity_id(file: Column) -> Column:
    """``{time}_{id}.ext`` or ``{time}_{id}_summary.json``; null when the id is no number."""
    return F.regexp_extract(base_name(file), r"^[^_]*_([^_.]+)", 1).try_cast("bigint")


def export_time(file: Column) -> Column:
    """Time before the first ``_``, written with ``.`` for ``:``; UTC unless it names an offset."""
    text = F.replace(F.split_part(base_name(file), F.lit("_"), F.lit(1)), F.lit("."), F.lit(":"))
    return F.try_to_timestamp(text)


def watch_time(file: Column) -> Column:
    """``YYYY-MM-DD-HH-MM-SS.ext``, in UTC."""
    text = F.split_part(base_name(file), F.lit("."), F.lit(1))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd-HH-mm-ss"))


def file_date(file: Column) -> Column:
    """The date before ``T``."""
    return F.split_part(base_name(file), F.lit("T"), F.lit(1)).try_cast("date")


def pair_key(file: Column) -> Column:
    """Equal for an activity file and its summary."""
    return F.regexp_replace(base_name(file), r"(_summary\.json|\.fit)$", "")


def made_id(file: Column) -> Column:
    """Id for a file whose name has none: positive, and the same on every run.

    Made from the path as given, so files of one name in two folders are two activities. Should
    two paths still share one, ``sinks.load.reject_shared_ids`` finds them.
    """
    return F.xxhash64(file).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))
