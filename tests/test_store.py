"""The ledger, loads in any order, corrections in place, buckets."""

import json
import os
import pathlib
import shutil
from datetime import datetime, timedelta, timezone
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.operators.efforts import fastest_efforts
from lapwise.operators.laps import assign_laps
from lapwise.plans import maintenance, reports
from lapwise.plans.ingest import LoadShrinks, load_connect
from lapwise.schemas import LAYOUTS
from lapwise.sources.sidecar import read_sidecars, summaries_since
from lapwise.sources.tables import LOAD, Store
from lapwise.streaming.incremental import follow, follow_pieces, message_stream

from messages import RUN, SWIM, connect_frame, frame, run, swim, watch_frame

APRIL = "2024-04-01T00.00.00_110.fit"


def april():
    yield from ((name, fields | {"timestamp": "2024-04-01 00:00:00"} if name == "activity" else fields) for name, fields in run())


@pytest.fixture(scope="module")
def none(spark):
    return read_sidecars_of_nothing(spark)


def read_sidecars_of_nothing(spark):
    from lapwise.sources.sidecar import PATHS

    kinds = {"workout_feel": "double", "effort": "double", "adjusted_distance": "double", "adjusted_duration": "double"}
    return spark.createDataFrame([], ", ".join(["file string", "pair string", *[f"{n} {kinds.get(n, 'string')}" for n in PATHS.values()]]))


def counts(store):
    """Rows by table, in one job."""
    rows = reduce(DataFrame.unionByName, [store.read(t).select(F.lit(t).alias("t")) for t in LAYOUTS])
    return dict.fromkeys(LAYOUTS, 0) | {r["t"]: r["count"] for r in rows.groupBy("t").count().collect()}


def ids(store):
    return sorted(r[0] for r in store.read("activity").select("activity_id").collect())


def entries(store):
    return {r[LOAD]: r for r in store.ledger().collect()}


def files_of(base, table):
    return {str(f) for f in pathlib.Path(base, table).rglob("*.parquet")}


def utc(time):
    return time.astimezone(timezone.utc)


class Broken(Store):
    """Stops before the events are written."""

    def write(self, table, rows, run):
        if table == "event":
            raise RuntimeError("stopped")
        super().write(table, rows, run)


@pytest.fixture(scope="module")
def months(spark, none, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("months")))
    load_connect(store, connect_frame(spark), none, "march")
    load_connect(store, frame(spark, {APRIL: april}), none, "april")
    return store


def copy_of(store, folder):
    shutil.copytree(store.base, folder)
    return Store(store.spark, str(folder))


def test_load_again_after_a_newer_one(spark, none, months, tmp_path):
    """March, April, March again: nothing goes, and the ledger says what was done."""
    store = copy_of(months, tmp_path / "store")
    before, noted = counts(store), entries(store)
    assert ids(store) == [101, 102, 110]
    load_connect(store, connect_frame(spark), none, "march")
    assert counts(store) == before
    load_connect(store, frame(spark, {APRIL: april}), none, "april")
    assert counts(store) == before
    after = entries(store)
    assert set(after) == {"march", "april"}
    for name, rows in noted.items():
        for c in ("source", "mark", "newest", "counts"):
            assert after[name][c] == rows[c]
        assert after[name]["entry"] > rows["entry"]
    assert utc(noted["march"]["mark"]) == datetime(1900, 1, 1, 12, tzinfo=timezone.utc)
    assert utc(noted["april"]["mark"]) == utc(noted["march"]["newest"]) == datetime(2024, 3, 2, 9, 30, tzinfo=timezone.utc)
    assert noted["march"]["counts"]["record"] == 6 and noted["march"]["counts"]["record set aside"] == 1
    assert {t: sum(r["counts"][t] for r in after.values()) for t in LAYOUTS} == before

    # A rerun that broke off hides nothing, and leaves files that no load counts.
    with pytest.raises(RuntimeError):
        load_connect(Broken(spark, store.base), connect_frame(spark), none, "march")
    assert counts(store) == before and entries(store)["march"]["entry"] == 2
    left = {tuple(r[0].split("/load_id=")[1].split("/")[:2]) for r in store.unused().collect()}
    assert left == {("march", "run=1"), ("march", "run=3"), ("april", "run=1")}

    # Nor does a load shrink unasked.
    with pytest.raises(LoadShrinks, match="drop 1"):
        load_connect(store, frame(spark, {SWIM: swim}), none, "march")
    assert counts(store) == before
    load_connect(store, frame(spark, {SWIM: swim}), none, "march", may_shrink=True)
    assert ids(store) == [102, 110]


def test_a_load_that_broke_off_keeps_its_mark(spark, none, tmp_path):
    """Broken off, then a newer load, then run again: its files are still newer than its mark."""
    store = Store(spark, str(tmp_path))

    class Broken(Store):
        def commit(self, run):
            raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        load_connect(Broken(spark, store.base), connect_frame(spark), none, "a")
    load_connect(store, frame(spark, {APRIL: april}), none, "b")
    assert ids(store) == [110]
    load_connect(store, connect_frame(spark), none, "a")
    assert ids(store) == [101, 102, 110]


def test_mark_reads_no_activities(months, monkeypatch):
    newest = datetime(2024, 4, 1, tzinfo=timezone.utc)
    # Ahead of the newest time, the activities of that load tell.
    assert months.high_water(datetime(2024, 3, 2)) == datetime(2024, 3, 1, 8, tzinfo=timezone.utc)
    assert months.high_water(datetime(2024, 1, 1)) == datetime(1900, 1, 1, 12, tzinfo=timezone.utc)
    opened = []
    monkeypatch.setattr(Store, "_open", lambda self, table, layout, f=Store._open: (opened.append(table), f(self, table, layout))[1])
    assert months.high_water() == newest and months.high_water(but="april") == datetime(2024, 3, 2, 9, 30, tzinfo=timezone.utc)
    assert set(opened) == {"ledger"}


def test_two_streams_into_one_store(spark, none, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    connect_frame(spark).coalesce(1).write.parquet(str(tmp_path / "connect"))
    watch_frame(spark).coalesce(1).write.parquet(str(tmp_path / "watch"))
    connect = lambda progress: follow(
        message_stream(spark, str(tmp_path / "connect")), store, str(tmp_path / progress), lambda since: none
    ).awaitTermination(120)
    connect("p1")
    follow(message_stream(spark, str(tmp_path / "watch")), store, str(tmp_path / "p2")).awaitTermination(120)
    assert len(ids(store)) == 4 and {101, 102} < set(ids(store))  # one watch file is of the future
    before = counts(store)
    # A new checkpoint is a new stream: it finds everything stored.
    connect("p3")
    assert counts(store) == before
    assert sorted(r["source"] for r in entries(store).values()) == ["connect stream", "connect stream", "watch stream"]


def pieces(messages, folder, number, seqs):
    """A piece of an activity, arrived at a minute of its own."""
    path = folder / str(number)
    messages.where(F.col("seq").between(*seqs)).coalesce(1).write.parquet(str(path))
    for f in path.rglob("*.parquet"):
        os.utime(f, (1_700_000_000 + number * 60,) * 2)


def test_an_activity_in_pieces(spark, none, tmp_path):
    """Three batches, a restart, another file that lets time pass, and a piece that comes after the load."""
    folder, store = tmp_path / "messages", Store(spark, str(tmp_path / "store"))
    folder.mkdir()
    whole = frame(spark, {RUN: run})
    follow_on = lambda: follow_pieces(
        message_stream(spark, str(folder / "*")), lambda: spark.read.schema(whole.schema).parquet(str(folder / "*")), store,
        str(tmp_path / "progress"), lambda since: none, gap="5 minutes",
    ).awaitTermination(120)
    pieces(whole, folder, 1, (8, 99))
    follow_on()
    pieces(whole, folder, 3, (0, 2))
    follow_on()
    pieces(whole, folder, 4, (3, 5))
    follow_on()
    assert ids(store) == []
    pieces(frame(spark, {SWIM: swim}), folder, 20, (0, 99))
    follow_on()
    follow_on()
    assert ids(store) == [101] and store.read("record").where("activity_id = 101").count() < 6
    # Late: the activity is stored already; it is loaded anew with all its pieces.
    pieces(whole, folder, 30, (6, 7))
    follow_on()
    pieces(frame(spark, {APRIL: april}), folder, 60, (0, 99))
    follow_on()
    follow_on()
    assert ids(store) == [101, 102]
    batch = Store(spark, str(tmp_path / "batch"))
    load_connect(batch, frame(spark, {RUN: run, SWIM: swim}), none, "a")
    assert counts(store) == counts(batch)
    for t in LAYOUTS:
        assert store.read(t).exceptAll(batch.read(t)).isEmpty() and batch.read(t).exceptAll(store.read(t)).isEmpty()
    assert sorted(r["file"] for r in store.files().collect()) == [RUN, SWIM]


def test_correction_in_place(spark, months, tmp_path):
    """Only the load with a changed activity gets new files, of the corrected table alone."""
    store = copy_of(months, tmp_path / "store")
    base = store.base
    before, tables = counts(store), {t: files_of(base, t) for t in LAYOUTS}
    aside = store.set_aside("record").count()

    class Unnoted(Store):
        def _note(self, runs, done):
            raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        maintenance.refresh_pool(Unnoted(spark, base), connect_frame(spark))
    lengths = lambda: {r["sport"]: r["pool_length"] for r in store.read("session").where("activity_id = 102").collect()}
    assert lengths() == {"swimming": 22.86, "running": None}
    assert maintenance.refresh_pool(store, connect_frame(spark)) == ["march"]
    assert lengths() == {"swimming": 22.0, "running": None}
    fresh = files_of(base, "session") - tables["session"]
    assert fresh and all("/load_id=march/" in f for f in fresh)
    assert all(tables[t] == files_of(base, t) for t in LAYOUTS if t != "session")
    assert counts(store) == before and store.set_aside("record").count() == aside

    def powered():
        for name, fields in run():
            yield name, fields | ({"avg_power": "1", "max_power": "300"} if name == "lap" else {})

    assert maintenance.refresh_power(store, frame(spark, {RUN: powered})) == ["march"]
    laps = store.read("lap").where("activity_id = 101").orderBy("number").collect()
    assert [(r["avg_power"], r["max_power"]) for r in laps] == [(200, 300), (1, 300)]
    assert {t: sum(r["counts"][t] for r in entries(store).values()) for t in LAYOUTS} == before


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets(spark, none, months, tmp_path):
    plain, store = months, Store(spark, str(tmp_path / "store"), buckets=4)
    load_connect(store, connect_frame(spark), none, "march")
    load_connect(store, frame(spark, {APRIL: april}), none, "april")
    again = Store(spark, store.base)
    assert again.buckets == 4
    with pytest.raises(ValueError):
        Store(spark, store.base, buckets=5)
    # As another session does: by their place.
    for t in ("record", "lap"):
        spark.sql(f"DROP TABLE {store._registered(t, [])}")
    for t in LAYOUTS:
        assert again.read(t).exceptAll(plain.read(t)).isEmpty() and plain.read(t).exceptAll(again.read(t)).isEmpty()
    assert again.set_aside("record").count() == plain.set_aside("record").count() == 2

    best = reports.best_times(again, [100, 200])
    assert "Exchange" not in plan(best)
    want = reports.best_times(plain, [100, 200])
    assert best.exceptAll(want).isEmpty() and want.exceptAll(best).isEmpty() and best.count() > 0
    assigned = assign_laps(again.read("record").drop("lap"), again.read("lap"))
    assert "Exchange" not in plan(assigned)
    old = assign_laps(plain.read("record").drop("lap"), plain.read("lap"))
    assert assigned.exceptAll(old).isEmpty() and old.exceptAll(assigned).isEmpty()
    one = fastest_efforts(again.read("record"), [100], activity_id=101, clustered=True)
    assert "SelectedBucketsCount: 1 out of 4" in plan(one) and one.count() > 0


def test_summaries_are_found_by_name(spark, tmp_path):
    """Files that are older than a load's mark are not opened."""
    folder = tmp_path / "summaries"
    folder.mkdir()
    for month in range(1, 10):
        (folder / f"2024-0{month}-05T10.00.00_{month}_summary.json").write_text(json.dumps({"summaryDTO": {"distance": month}}))
    read = summaries_since(spark, str(folder))(datetime(2024, 7, 5, 10, tzinfo=timezone.utc))
    assert sorted(r["adjusted_distance"] for r in read.collect()) == [7, 8, 9]
    node = read._jdf.queryExecution().executedPlan()
    node = node.children().apply(0) if node.children().size() else node
    while node.children().size():
        node = node.children().apply(0)
    assert node.metrics().apply("numFiles").value() == 3
    assert read_sidecars(spark, str(folder)).count() == 9
    # A name in another time zone is of the day before at most.
    edge = summaries_since(spark, str(folder))(datetime(2024, 7, 6, 9, tzinfo=timezone.utc) - timedelta(hours=1))
    assert edge.count() == 3
