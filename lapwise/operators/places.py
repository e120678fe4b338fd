"""Nearest place to a position, from a gazetteer table instead of a web service.

Places are cut into a tree of cells that follows their density: each level cuts every cell into ``BRANCHES`` parts of about
equally many places, by latitude and by longitude in turn. A cell knows the box that its places fill on the unit
sphere, and one of its places. A position walks down from the root with the nearest place known so far:
among the parts of a cell, the places they name bring that bound down, and parts whose box lies farther away than the bound are
left out. What remains are a few leaves; their places are measured exactly. So every position gets its true
nearest place, at poles and the date line as elsewhere, and one far from all places meets no more of them than one in their midst.

A level costs an equi join on cells. Cuts are found from counts of the whole table and are at most
``BRANCHES ** (DEEPEST - 1)`` rows of ``BRANCHES - 1`` numbers, which go with the plan. Each position is looked up once, however
many rows have it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.functions.values import first_filled
from lapwise.session import durable

EARTH_KM = 6371.0088
BRANCHES = 16
DEEPEST = 4
PLACES_PER_LEAF = 16
_AXES = ["_x", "_y", "_z"]
_SIDES = [f"{end}{axis}" for axis in _AXES for end in ("least", "most", "some")]
_PARTS = f"array<struct<cell:bigint,{','.join(f'{side}:double' for side in _SIDES)}>>"
# Distances on the unit sphere beyond any doubt of rounding: six millimetres on the ground.
_HAIR = 1e-9


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half = lambda a, b: F.pow(F.sin((F.radians(b) - F.radians(a)) / 2), 2)
    h = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def _sphere(lat: Column, lon: Column, prefix: str = "") -> dict[str, Column]:
    lat, lon = F.radians(lat), F.radians(lon)
    return dict(zip([prefix + a for a in _AXES], [F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)]))


def _square(values: list[Column]) -> Column:
    return sum((v * v for v in values[1:]), values[0] * values[0])


def _cell_below(cell: Column, cuts: list[list[float] | None], axis: str) -> Column:
    """The part of ``cell`` a place is in, by the cell's ``cuts``."""
    known = F.from_json(F.lit(json.dumps(cuts)), "array<array<double>>")
    below = F.filter(F.get(known, cell.cast("int")), lambda cut: cut < F.col(axis))
    return cell * BRANCHES + F.size(below)


def _boxes() -> list[Column]:
    some = F.min(F.struct(*_AXES))
    return [
        c for axis in _AXES
        for c in (F.min(axis).alias(f"least{axis}"), F.max(axis).alias(f"most{axis}"), some[axis].alias(f"some{axis}"))
    ]


class _Tree:
    """Places by cell, and the parts of each cell above the leaves."""

    def __init__(self, places: DataFrame, per_leaf: int) -> None:
        level, cell, self.depth, self.cells = 0, F.lit(0).cast("bigint"), DEEPEST, places
        shares = [n / BRANCHES for n in range(1, BRANCHES)]
        self.root: list = []
        while level < max(self.depth, 2):
            axis = ("_plat", "_plon")[level % 2]
            self.cells = self.cells.withColumn(f"_cell{level}", cell)
            found = self.cells.groupBy(f"_cell{level}").agg(
                F.count(F.lit(1)), F.percentile_approx(axis, shares, 1000), F.struct(*_boxes())
            ).collect()
            if level == 0:
                places_there = sum(r[1] for r in found)
                fits = [d for d in range(1, DEEPEST + 1) if places_there <= per_leaf * BRANCHES**d]
                self.depth = min(fits, default=DEEPEST)
            if level == 1:
                self.root = [{"cell": r[0], **r[3].asDict()} for r in found]
            cuts: list = [None] * BRANCHES**level
            for r in found:
                cuts[r[0]] = list(r[2])
            cell, level = _cell_below(F.col(f"_cell{level}"), cuts, axis), level + 1
        if level == self.depth:
            self.cells = self.cells.withColumn(f"_cell{level}", cell)
        self.leaf = f"_cell{self.depth}"

    def parts(self, level: int) -> DataFrame:
        """``_cell, _parts`` for each cell of a level; at most ``BRANCHES`` parts each."""
        below = self.cells.groupBy(f"_cell{level}", F.col(f"_cell{level + 1}").alias("cell")).agg(*_boxes())
        return below.groupBy(F.col(f"_cell{level}").alias("_cell")).agg(F.collect_list(F.struct("cell", *_SIDES)).alias("_parts"))


def _down(frontier: DataFrame) -> DataFrame:
    """From cells with their ``_parts`` to the parts that may hold the nearest place."""
    here = {axis: F.col(axis) for axis in _AXES}
    named = F.transform("_parts", lambda p: _square([p[f"some{a}"] - here[a] for a in _AXES]))
    nearer = frontier.withColumn("_bound", F.least("_bound", F.array_min(named)))
    each = nearer.select("_lat", "_lon", *_AXES, "_bound", F.explode("_parts").alias("_part"))
    part = F.col("_part")
    off = [F.greatest(part[f"least{a}"] - here[a], here[a] - part[f"most{a}"], F.lit(0.0)) for a in _AXES]
    return each.where(_within(_square(off))).select("_lat", "_lon", *_AXES, "_bound", part["cell"].alias("_cell"))


def _within(square: Column) -> Column:
    return square <= F.pow(F.sqrt("_bound") + _HAIR, 2)


def nearest_place(
    starts: DataFrame,
    places: DataFrame,
    latitude: str = "start_position_lat",
    longitude: str = "start_position_long",
    max_km: float | None = None,
    per_leaf: int = PLACES_PER_LEAF,
) -> DataFrame:
    """``starts`` with ``city, county`` of the nearest place; both null without a position.

    ``places`` has ``latitude, longitude, city, town, village, county``. Equally near (to a
    millimetre): the first by name. ``max_km`` leaves out places farther away. ``per_leaf`` is about how many places a
    leaf holds and changes the work only.
    """
    known = _nearest(starts, places, latitude, longitude, max_km, per_leaf)
    same = (F.col(latitude).cast("double") == F.col("_lat")) & (F.col(longitude).cast("double") == F.col("_lon"))
    return starts.join(known, same, "left").drop("_lat", "_lon")


def measured_places(
    starts: DataFrame, places: DataFrame, latitude: str, longitude: str, max_km: float | None = None,
    per_leaf: int = PLACES_PER_LEAF,
) -> DataFrame:
    """``_lat, _lon, _km, city, county``: the places whose distance the search measures for each position."""
    named = places.select(
        F.col("latitude").cast("double").alias("_plat"), F.col("longitude").cast("double").alias("_plon"),
        first_filled(F.col("city"), F.col("town"), F.col("village")).alias("city"),
        F.nullif(F.col("county"), F.lit("")).alias("county"),
    ).where("_plat IS NOT NULL AND _plon IS NOT NULL AND NOT isnan(_plat) AND NOT isnan(_plon)")
    # Of places at one position the first by name.
    first = F.min(F.struct(F.coalesce("city", F.lit("")).alias("a"), F.coalesce("county", F.lit("")).alias("b"), "city", "county"))
    spots = named.groupBy("_plat", "_plon").agg(first.alias("_first")).select("_plat", "_plon", "_first.city", "_first.county")
    tree = _Tree(durable(spots.withColumns(_sphere(F.col("_plat"), F.col("_plon")))), per_leaf)

    here = starts.select(F.col(latitude).cast("double").alias("_lat"), F.col(longitude).cast("double").alias("_lon"))
    here = here.where("_lat IS NOT NULL AND _lon IS NOT NULL").distinct().withColumns(_sphere(F.col("_lat"), F.col("_lon")))
    # Squares of chords; none is longer than the diameter.
    most = 4.0 if max_km is None else 4 * F.pow(F.sin(F.least(F.lit(max_km / EARTH_KM), F.lit(3.1415926)) / 2), 2)
    root = F.from_json(F.lit(json.dumps(tree.root)), _PARTS)
    frontier = _down(here.withColumn("_bound", F.lit(most) + _HAIR).withColumn("_parts", root))
    for level in range(1, tree.depth):
        frontier = _down(frontier.join(tree.parts(level), "_cell"))
    leaves = tree.cells.select(
        F.col(tree.leaf).alias("_cell"), "_plat", "_plon", "city", "county", *[F.col(a).alias(f"_p{a}") for a in _AXES]
    )
    met = frontier.join(leaves, "_cell").where(_within(_square([F.col(f"_p{a}") - F.col(a) for a in _AXES])))
    away = haversine_km(F.col("_lat"), F.col("_lon"), F.col("_plat"), F.col("_plon"))
    return met.select("_lat", "_lon", away.alias("_km"), "city", "county")


def _nearest(
    starts: DataFrame, places: DataFrame, latitude: str, longitude: str, max_km: float | None, per_leaf: int
) -> DataFrame:
    measured = measured_places(starts, places, latitude, longitude, max_km, per_leaf)
    rank = F.struct(F.round("_km", 6), F.coalesce("city", F.lit("")), F.coalesce("county", F.lit("")))
    best = measured.groupBy("_lat", "_lon").agg(F.min_by(F.struct("city", "county", "_km"), rank).alias("_place"))
    if max_km is not None:
        best = best.where(F.col("_place._km") <= max_km)
    return best.select("_lat", "_lon", "_place.city", "_place.county")
