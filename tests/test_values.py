import datetime
import math

import pytest
from pyspark.sql import functions as F

from lapwise.functions import names
from lapwise.functions.values import default_name, first_filled, lenient_time, nested, title_words
from lapwise.operators.marks import high_water, newer_files
from lapwise.operators.numbering import dense_numbers
from lapwise.operators.places import nearest_place
from lapwise.operators.sports import activities_over, activity_totals, classify_sport, longest_multi_session
from lapwise.sinks.contract import conform, split
from lapwise.sources.sidecar import flatten
from lapwise.sinks.load import insert_if_absent, reject_shared_ids, update_pool, serial_ids


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def micros(c):
    return F.unix_micros(c)


def test_names(spark):
    lit = F.lit
    assert one(spark, names.activity_id(lit("/x/2024-01-15T08.30.00_42.fit")), names.activity_id(lit("t_42_summary.json"))) == (42, 42)
    assert one(spark, names.activity_id(lit("nothing.fit"))) == (None,)
    want = int(datetime.datetime(2024, 1, 15, 8, 30, tzinfo=datetime.timezone.utc).timestamp() * 1e6)
    assert one(
        spark,
        micros(names.export_time(lit("2024-01-15T08.30.00_42.fit"))),
        micros(names.export_time(lit("2024-01-15T10.30.00+02.00_42.fit"))),
        micros(names.watch_time(lit("2024-01-15-08-30-00.fit"))),
    ) == (want, want, want)
    assert one(spark, names.export_time(lit("soon_42.fit")), names.watch_time(lit("soon.fit"))) == (None, None)
    assert one(spark, names.file_date(lit("2024-01-15T08.30.00_42.fit"))) == (datetime.date(2024, 1, 15),)
    assert one(spark, names.pair_key(lit("a_1.fit")), names.pair_key(lit("/b/a_1_summary.json"))) == ("a_1", "a_1")


_PATHS = ("a.b.1.c", "a.b.7.c", "a.z", "n", "a.b.0", "o.p", "o", "q.r.s")


def test_flatten_is_each_path_alone(spark):
    docs = ['{"a": {"b": [1, {"c": "x"}]}, "n": null}', '{"a": 5, "n": 1.50}', "no json", None, "[]", '{"a": {"b": [7, {"c": [2]}], "z": true}}', '{"o": {"p": "x\\u00e9"}, "q": {"r": {"s": 1e3}}}', '{"q": {"r": 1, "s": 2}, "n": "5"}']
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    out = flatten(df, "doc", {p: f"p{i}" for i, p in enumerate(_PATHS)})
    want = df.select("doc", *[nested(F.col("doc"), p) for p in _PATHS])
    assert list(map(tuple, out.collect())) == list(map(tuple, want.collect()))


def test_values(spark):
    lit = F.lit
    doc = lit('{"a": {"b": [1, {"c": "x"}]}, "n": null}')
    assert one(spark, *[nested(doc, p) for p in _PATHS]) [:5] == ("x", None, None, None, "1")
    assert one(spark, title_words(lit("lap_swimming")), title_words(lit("RUNNING"))) == ("Lap_Swimming", "Running")
    odd = "e-bike_riding 2x in göteborg"
    assert one(spark, title_words(lit(odd))) == (odd.title(),)
    null = lit(None).cast("string")
    assert one(spark, first_filled(null, lit(""), lit("v"))) == ("v",)
    assert one(
        spark, default_name(lit("running"), lit(1), lit("Town"), lit("County")), default_name(lit("running"), lit(3), lit(""), lit("County")),
        default_name(null, lit(None).cast("int"), null, null),
    ) == ("Town Running", "County Multisport", "Unknown")
    assert one(spark, lenient_time(lit("never"))) == (None,)


def test_contract(spark):
    rows = spark.createDataFrame(
        [("1", "22.5", "0.96", "nan"), ("2", "-22.5", "0.9", "7"), (None, "40000", "x", "1e3"), ("4", None, None, None)],
        "activity_id string, heart_rate string, fractional_cadence string, distance string",
    )
    typed = {r["activity_id"]: r for r in conform(rows, "record").collect()}
    assert (typed[1]["heart_rate"], typed[1]["fractional_cadence"], typed[1]["distance"]) == (23, None, None)
    assert (typed[2]["heart_rate"], float(typed[2]["fractional_cadence"]), typed[2]["distance"]) == (-23, 0.9, 7.0)
    good, bad = split(rows, "record")
    assert sorted(r["activity_id"] for r in good.collect()) == [2, 4]
    assert sorted(r["reasons"] for r in bad.collect()) == [
        "fractional_cadence", "heart_rate,fractional_cadence,activity_id",
    ]
    with pytest.raises(ValueError):
        conform(rows, "weather")
    padded = spark.createDataFrame([(1, "race           ")], "activity_id long, category string")
    assert conform(padded, "activity").first()["category"] == "race"


def test_loads(spark):
    new = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 3), (3, "d", 4)], "activity_id long, file string, v int")
    stored = spark.createDataFrame([(2,)], "activity_id long")
    assert sorted(map(tuple, insert_if_absent(new, stored, ["file"]).collect())) == [(1, "a", 1), (3, "d", 4)]
    assert [r[0] for r in reject_shared_ids(new).collect()] == [1]
    sessions = spark.createDataFrame(
        [(1, "lap_swimming", 10.0, "m"), (1, "open_water", 10.0, "m"), (2, "lap_swimming", None, None)],
        "activity_id long, sub_sport string, pool_length double, pool_length_unit string",
    )
    updates = spark.createDataFrame(
        [(1, "lap_swimming", 1, 50.0, "m"), (1, "lap_swimming", 2, 22.86, None), (1, "open_water", 3, 5.0, "m"), (2, "lap_swimming", 4, None, "yd")],
        "activity_id long, sub_sport string, seq long, pool_length double, pool_length_unit string",
    )
    assert sorted(map(tuple, update_pool(sessions, updates, ["seq"]).collect())) == [
        (1, "lap_swimming", 22.0, "m"), (1, "open_water", 10.0, "m"), (2, "lap_swimming", 0.0, "yd"),
    ]


def test_local_times_keep_their_clock(spark):
    texts = ["2024-03-01 09:00:00", "2024-03-01T09:00:00+02:00", "2024-03-01 09:00:00Z", "noon", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "activity_id long, local_timestamp string")
    got = [r["local_timestamp"] for r in conform(rows, "activity").orderBy("activity_id").collect()]
    assert got == [datetime.datetime(2024, 3, 1, 9)] * 3 + [None] * 2


def test_dense_numbers(spark):
    df = spark.createDataFrame([(i * 7919 % 1000 if i % 10 else None, i) for i in range(1000)], "v int, i int").repartition(7)
    want = sorted(((r["v"] is not None, r["v"] or 0, r["i"]) for r in df.collect()))
    for size in (1000, 90):
        got = dense_numbers(df, ["v", "i"], "n", after=5, rows_per_range=size).orderBy("n").collect()
        assert [r["n"] for r in got] == list(range(6, 1006))
        assert [r["i"] for r in got] == [i for _, _, i in want]
    assert dense_numbers(df.limit(0), ["i"], "n").collect() == []
    plan = dense_numbers(df, ["i"], "n")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_serial_ids(spark):
    stored, new = spark.range(3, 8).toDF("activity_id"), spark.createDataFrame([("c",), ("a",), ("b",)], "file string")
    assert {(r["file"], r["activity_id"]) for r in serial_ids(new, stored, ["file"]).collect()} == {("a", 8), ("b", 9), ("c", 10)}
    assert {r["activity_id"] for r in serial_ids(new, stored.limit(0), ["file"]).collect()} == {1, 2, 3}


def test_sports_and_order_of_reports(spark):
    sessions = spark.createDataFrame(
        [(1, "running", 5.0), (1, None, 5.0), (2, "running", 1.0), (2, "cycling", 9.0), (3, None, None), (4, "running", 2.0)],
        "activity_id long, sport string, total_distance double",
    )
    assert {tuple(r) for r in classify_sport(sessions).collect()} == {(1, "running"), (2, "multi_sport"), (3, None), (4, "running")}
    activities = spark.createDataFrame(
        [(1, 20000.0, 2, 10), (2, 30000.0, 2, 20), (3, None, 2, 30), (4, 15000.0, 1, None), (5, 99999.0, 1, 5)],
        "activity_id long, adjusted_distance double, num_sessions int, timestamp int",
    )
    assert [r["activity_id"] for r in activities_over(activities, sessions).collect()] == [4, 1]
    longest = longest_multi_session(activities, sessions).select("activity_id", "total_distance", "sum_distance").collect()
    assert list(map(tuple, longest)) == [(3, None, None), (2, 9.0, 9.0), (2, 1.0, 1.0), (1, 5.0, 10.0)]
    totals = sessions.withColumn("total_timer_time", F.lit(None).cast("double"))
    assert {tuple(r) for r in activity_totals(totals).collect()} == {(1, 10.0, 0.0), (2, 10.0, 0.0), (3, 0.0, 0.0), (4, 2.0, 0.0)}


def test_marks_keep_microseconds(spark):
    at = datetime.datetime(2024, 1, 15, 11, 59, 59, 123457)
    files = spark.createDataFrame([(at + datetime.timedelta(microseconds=i),) for i in (-1, 0, 1)], "t timestamp_ntz")
    kept = newer_files(files, F.col("t").cast("timestamp"), at)
    assert [r[0] for r in kept.collect()] == [at + datetime.timedelta(microseconds=1)]


def test_mark_without_activities(spark):
    none = spark.createDataFrame([], "timestamp timestamp")
    after = high_water(none).select(F.unix_micros("after")).first()[0]
    assert after == int(datetime.datetime(1900, 1, 1, 12, tzinfo=datetime.timezone.utc).timestamp()) * 1_000_000


@pytest.mark.parametrize("per_leaf", [1, 16])
def test_places(spark, per_leaf):
    places = spark.createDataFrame(
        [(0.0, 179.99, "East", "e"), (0.0, -179.5, "West", "w"), (50.0, 7.0, None, "Hill"), (50.05, 7.0, "Dale", None)],
        "latitude double, longitude double, city string, county string",
    ).withColumns({"town": F.lit(None).cast("string"), "village": F.lit("")})
    starts = spark.createDataFrame(
        [(1, 0.0, -179.99), (2, 50.01, 7.0), (3, 50.04, 7.01), (4, -33.0, 20.0), (5, None, None), (6, 0.0, -179.99)],
        "id int, start_position_lat double, start_position_long double",
    )
    got = {r["id"]: (r["city"], r["county"]) for r in nearest_place(starts, places, per_leaf=per_leaf).collect()}
    assert got == {
        1: ("East", "e"), 2: (None, "Hill"), 3: ("Dale", None), 4: (None, "Hill"), 5: (None, None), 6: ("East", "e"),
    }
    got = {r["id"]: (r["city"], r["county"]) for r in nearest_place(starts, places, per_leaf=per_leaf, max_km=3).collect()}
    assert got == {
        1: ("East", "e"), 2: (None, "Hill"), 3: ("Dale", None), 4: (None, None), 5: (None, None), 6: ("East", "e"),
    }


def test_places_against_all(spark):
    """The nearest of all places, near poles and the date line too."""
    import math
    import random

    dice = random.Random(7)
    spot = lambda: (math.degrees(math.asin(dice.uniform(-1, 1))), dice.uniform(-180, 180))
    places = [(*spot(), f"p{i}") for i in range(60)] + [(89.9, 10.0, "pole"), (-89.9, 0.0, "south")]
    starts = [(i, *spot()) for i in range(200)] + [(200, 90.0, 0.0), (201, 89.95, -170.0), (202, -90.0, 50.0), (203, 0.0, 180.0)]

    def apart(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        return math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2

    df = spark.createDataFrame(starts, "id int, start_position_lat double, start_position_long double")
    towns = spark.createDataFrame(places, "latitude double, longitude double, city string").withColumns(
        {c: F.lit(None).cast("string") for c in ("town", "village", "county")}
    )
    got = {r["id"]: r["city"] for r in nearest_place(df, towns, per_leaf=1).collect()}
    assert got == {i: min(places, key=lambda p: apart(lat, lon, p[0], p[1]))[2] for i, lat, lon in starts}


def test_places_far_away(spark):
    """A dense spot and starts far from it: what is measured grows with the starts, not with the places."""
    from lapwise.operators.places import measured_places

    towns = spark.range(5000).select(
        (47 + F.rand(1) / 50).alias("latitude"), (8 + F.rand(2) / 50).alias("longitude"), F.concat(F.lit("p"), "id").alias("city"),
        F.lit(None).cast("string").alias("town"), F.lit(None).cast("string").alias("village"), F.lit(None).cast("string").alias("county"),
    )
    towns = spark.createDataFrame(towns.toArrow())
    starts = spark.range(400).select("id", (F.rand(3) * 160 - 80).alias("lat"), (F.rand(4) * 360 - 180).alias("lon"))
    starts = spark.createDataFrame(starts.toArrow())
    few = starts.where("id < 100")
    counts = [measured_places(df, towns, "lat", "lon").count() for df in (few, starts)]
    assert counts[1] < 5 * counts[0] and counts[1] < 400 * 40
    spots = {r["city"]: (r["latitude"], r["longitude"]) for r in towns.collect()}

    def apart(a, b):
        (a, b), (c, d) = ([math.radians(x) for x in p] for p in (a, b))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return round(2 * 6371.0088 * math.asin(math.sqrt(h)), 6)

    for r in nearest_place(few, towns, "lat", "lon").collect():
        least = min((apart((r["lat"], r["lon"]), at), name) for name, at in spots.items())
        assert apart((r["lat"], r["lon"]), spots[r["city"]]) == least[0]


def test_places_take_few_jobs(spark):
    """The tree is built from a bounded number of jobs, whatever the starts."""
    towns = spark.createDataFrame(
        [(i % 90 / 1.5, i / 7.0, f"p{i}", None, None, None) for i in range(1000)],
        "latitude double, longitude double, city string, town string, village string, county string",
    )
    spark.sparkContext.setJobGroup("places", "")
    nearest_place(spark.range(9).select("id", F.col("id").alias("lat"), F.col("id").alias("lon")), towns, "lat", "lon")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("places")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(jobs) <= 8


def test_places_of_odd_kinds(spark):
    layout = "latitude double, longitude double, city string, town string, village string, county string"
    nan = float("nan")
    starts = spark.createDataFrame([(1, 10.0, 10.0), (2, None, 5.0), (3, nan, 5.0)], "id int, lat double, lon double")
    got = lambda places, **more: {
        r["id"]: r["city"] for r in nearest_place(starts, spark.createDataFrame(places, layout), "lat", "lon", **more).collect()
    }
    assert got([]) == {1: None, 2: None, 3: None}
    one = (10.0, 10.5, "b", None, None, "x")
    assert got([(None, 1.0, "n", None, None, None), (nan, 1.0, "n", None, None, None), one]) == {1: "b", 2: None, 3: None}
    # Equal positions, equal distances, one meridian.
    assert got([one, (10.0, 10.5, "a", None, None, "x"), (10.0, 9.5, "aa", None, None, None)])[1] == "a"
    line = [(i / 100, 10.0, f"p{i:04}", None, None, None) for i in range(2000)]
    assert got(line, per_leaf=2)[1] == "p1000"
    assert got([one], max_km=10) == {1: None, 2: None, 3: None}
