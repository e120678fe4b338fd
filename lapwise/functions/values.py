"""Value conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SEMICIRCLES_PER_DEGREE = 2**32 / 360
METRES_PER_MILE = 1609.335
NO_ACTIVITY_YET = "1900-01-01T12:00:00Z"


def degrees(semicircles: Column) -> Column:
    return semicircles.cast("double") / F.lit(SEMICIRCLES_PER_DEGREE)


def miles(metres: Column) -> Column:
    return metres / F.lit(METRES_PER_MILE)


def seconds_to_duration(seconds: Column) -> Column:
    return F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def lenient_time(text: Column) -> Column:
    """UTC time, or null where the text is no time."""
    return F.try_to_timestamp(text)


def nested(json: Column, path: str) -> Column:
    """Value at a dotted path of a JSON text, as text; digits index lists; null when absent."""
    steps = "".join(f"[{p}]" if p.isdigit() else f"['{p}']" for p in path.split("."))
    return F.get_json_object(json, f"${steps}")


def first_filled(*texts: Column) -> Column:
    """The first text that is neither null nor empty."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])


def title_words(text: Column) -> Column:
    """``lap_swimming`` as ``Lap_Swimming``: a capital after everything that is no letter."""
    pieces = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(pieces, F.initcap), "")


def default_name(sport: Column, num_sessions: Column, city: Column, county: Column) -> Column:
    """``{city or county} {Sport}``; ``Multisport`` for several sessions; the sport alone without a place."""
    kind = F.when(num_sessions > 1, "Multisport").otherwise(F.coalesce(title_words(sport), F.lit("Unknown")))
    return F.concat_ws(" ", first_filled(city, county), kind)
