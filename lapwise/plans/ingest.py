"""Loads: from decoded messages to the seven stored tables.

One job takes all files. What the file name says is computed where it is needed, so ids
reach child rows without a join. What is new is judged against all other loads, by the mark
that the load's first run noted in the ledger: a load may be run again at any time, whole or broken off, before or
after newer ones, under its id or another, and each activity and its children are stored once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.functions import names
from lapwise.functions.values import default_name, lenient_time
from lapwise.operators.intensity import align_intensity
from lapwise.operators.laps import assign_laps, first_row, number_in_order, renumber_lengths
from lapwise.operators.marks import newer_files, untimed
from lapwise.operators.places import nearest_place
from lapwise.operators.skew import MEASURED, heavy_join, measured
from lapwise.operators.sports import activity_totals, fill_activity_time
from lapwise.schemas import CHILD_TABLES, LAYOUTS
from lapwise.session import durable, use_utc
from lapwise.sinks.contract import checked, with_raw
from lapwise.sinks.load import insert_if_absent, reject_shared_ids, with_parent
from lapwise.sources.messages import message_rows, route, workout_fields
from lapwise.sources.sidecar import PATHS
from lapwise.sources.tables import LOAD, Store, utc


@dataclass
class Load:
    """What a load would store: new activities with their ``file``, all messages, files left out and why."""

    activities: DataFrame
    messages: DataFrame
    activity_id: Column
    rejected: DataFrame


def derive(messages: DataFrame, activity_id: Column, min_rows: float | None = None) -> dict[str, DataFrame]:
    """Rows of the six child tables with ``file, seq, activity_id`` and all derived columns.

    ``activity_id`` is an expression over ``file``. Messages are counted per file once:
    with no hot file, no step below can meet a hot group.
    """
    limit = measured(messages, ["file"], min_rows)
    rows = {t: df.withColumn("activity_id", activity_id) for t, df in route(messages).items()}

    # By distance where places repeat, so that laps are numbered the same each time they are read.
    laps = number_in_order(rows["lap"], "file", ["seq", "total_distance"], "number", limit)
    laps, workout = laps.withColumn("number", F.col("number").cast("int")), workout_fields(messages)
    if limit != MEASURED:
        # With hot files, the steps below read both again and again; without, once for each table.
        laps, workout = durable(laps), durable(workout)
    rows["lap"] = align_intensity(workout, laps, min_rows=limit)

    points = rows["record"].withColumn("distance", F.col("distance").try_cast("double"))
    ends = laps.select("file", "number", F.col("total_distance").try_cast("double").alias("total_distance"))
    rows["record"] = assign_laps(points, ends, key="file", min_rows=limit)

    lengths = rows["length"].withColumn("message_index", F.col("message_index").try_cast("bigint"))
    rows["length"] = renumber_lengths(lengths, key="file", min_rows=limit)

    rows["file_id"] = fill_created(rows["file_id"], rows["activity"], limit)
    return {t: rows[t] for t in CHILD_TABLES}


def fill_created(file_ids: DataFrame, activities: DataFrame, min_rows: float | None = None) -> DataFrame:
    """``time_created`` as a time; where a file's first row has none, the activity's time."""
    first_time = first_row(activities.select("file", "seq", "timestamp"), ["file"], ["seq"])
    fallback = first_time.select("file", lenient_time(F.col("timestamp")).alias("_fallback"))
    limit = measured(file_ids, ["file"], min_rows)
    numbered = number_in_order(file_ids, "file", ["seq"], "_nth", limit)
    joined = heavy_join(numbered, fallback, ["file"], "left", limit)
    created = lenient_time(F.col("time_created"))
    filled = F.coalesce(created, F.when(F.col("_nth") == 1, F.col("_fallback")))
    return joined.withColumn("time_created", filled).drop("_nth", "_fallback")


def plan_connect(
    messages: DataFrame, sidecars: DataFrame, stored: DataFrame, after: datetime
) -> Load:
    """Files named ``{time}_{id}`` with a JSON summary each, newer than ``after``."""
    time = names.export_time(F.col("file"))
    fresh = newer_files(messages, time, after)
    flat = sidecars.groupBy("pair").agg(F.min_by(F.struct(*PATHS.values()), "file").alias("_summary"))
    activities = _timed(fresh).withColumn("pair", names.pair_key(F.col("file")))
    activities = activities.join(flat, "pair", "left").drop("pair").select("*", "_summary.*").drop("_summary")
    return _finish(fresh, activities, names.activity_id(F.col("file")), stored, untimed(messages, time))


def plan_watch(
    messages: DataFrame,
    places: DataFrame | None,
    stored: DataFrame,
    after: datetime,
    now: datetime | None = None,
    min_rows: float | None = None,
) -> Load:
    """Files named by their time alone: ids are made, totals and names derived."""
    time = names.watch_time(F.col("file"))
    fresh = newer_files(messages, time, after, now, until_now=True)
    numbers = ("total_distance", "total_timer_time", "start_position_lat", "start_position_long")
    sessions = message_rows(fresh, "session").withColumns({c: F.col(c).try_cast("double") for c in numbers})
    starts = first_row(sessions.select("file", "seq", "sport", *numbers[2:]), ["file"], ["seq"])
    if places is None:
        starts = starts.withColumns({c: F.lit(None).cast("string") for c in ("city", "county")})
    else:
        starts = nearest_place(starts, places)
    about = starts.select("file", "sport", "city", "county")
    activities = (
        _timed(fresh)
        .join(activity_totals(sessions, key="file"), "file", "left")
        .join(about, "file", "left")
        .withColumn(
            "activity_name",
            default_name(F.col("sport"), F.col("num_sessions").try_cast("int"), F.col("city"), F.col("county")),
        )
        .fillna(0.0, ["adjusted_distance", "adjusted_duration"])
        .drop("sport", "city", "county")
    )
    return _finish(
        fresh, activities, names.made_id(F.col("file")), stored, untimed(messages, time), ids_are_made=True
    )


def _timed(fresh: DataFrame) -> DataFrame:
    """First activity row of each file, its time filled from the sessions."""
    activities = first_row(message_rows(fresh, "activity"), ["file"], ["seq"])
    activities = activities.withColumn("timestamp", lenient_time(F.col("timestamp")))
    starts = message_rows(fresh, "session", ["start_time"]).select("file", lenient_time(F.col("start_time")).alias("start_time"))
    return fill_activity_time(activities, starts, key="file")


def _finish(
    fresh: DataFrame, activities: DataFrame, activity_id: Column, stored: DataFrame, without_time: DataFrame,
    ids_are_made: bool = False,
) -> Load:
    """Keep new activities that fit their table; of two files of one activity, the first by name.

    Every other file is rejected with its reason: those of messages ``without_time``, whose names hold no
    time; those without an activity or with one that does not fit; and those that share a made
    id, which tells nothing about either.
    """
    activities = activities.withColumn("activity_id", activity_id)

    def because(files: DataFrame, reason: Column) -> DataFrame:
        return files.select("file", F.lit("activity").alias("stage"), reason.alias("reason"))

    # Written once: the activities and the files left out are both picked from it.
    tested = durable(checked(activities, "activity", keep=["file"]))
    absent = fresh.select("file").distinct().join(tested.select("file"), "file", "left_anti")
    rejected = because(tested.where(F.col("reasons") != ""), F.col("reasons")).unionByName(
        because(absent, F.lit("no activity message"))
    ).unionByName(because(without_time.select("file").distinct(), F.lit("no time in the file name")))
    fit = tested.where(F.col("reasons") == "").drop("reasons")
    if ids_are_made:
        shared = reject_shared_ids(fit)
        doubled = fit.join(shared, "activity_id", "left_semi")
        rejected = rejected.unionByName(because(doubled, F.lit("id shared by several files")))
        fit = fit.join(shared, "activity_id", "left_anti")
    return Load(insert_if_absent(fit, stored, ["file"]), fresh, activity_id, rejected)


class LoadShrinks(ValueError):
    """A load run again would store fewer of the activities it has stored."""


def run_load(
    store: Store, load: Load, load_id: str, min_rows: float | None = None, source: str = "plan",
    mark: datetime | None = None, may_shrink: bool = False, takes_over: DataFrame | None = None,
) -> None:
    """Store a load, and note it in the ledger with its ``source`` and the ``mark`` its files are newer than.

    Run again with the same ``load_id``, it stands in for what that load stored, once it is whole. If activities
    would go that way, because files are missing now, it raises ``LoadShrinks`` and stores nothing, unless
    it ``may_shrink``. Activities that it ``takes_over`` (``activity_id, load_id`` as stored) leave their loads in the same
    moment as this one shows them. ``load`` must be planned against the store without ``load_id`` (``store.read(..., but=load_id)``).
    """
    # Fixed before the first write: the store may not change what counts as new.
    new = durable(load.activities)
    earlier = store.with_loads("activity", only=[load_id]).where("fits").select("activity_id")
    gone = 0 if may_shrink else earlier.join(new, "activity_id", "left_anti").count()
    if gone:
        raise LoadShrinks(f"load {load_id} would drop {gone} of its activities; allow it with may_shrink")
    run = store.begin(load_id, source, mark)
    limit = measured(load.messages, ["file"], min_rows)
    mine = with_parent(load.messages, new, key="file", min_rows=limit)
    for table, rows in derive(mine, load.activity_id, limit).items():
        store.write(table, with_raw(rows, table), run)
    store.write_rejected(load.rejected, run)
    store.write_files(new, run)
    store.write("activity", new, run)
    run.newest = utc(new.agg(F.max("timestamp")).first()[0])
    moved = []
    if takes_over is not None:
        takes_over = durable(takes_over.join(new, "activity_id", "left_semi").select("activity_id", LOAD))
        moved = [r[0] for r in takes_over.select(LOAD).distinct().collect()]
    if moved:
        left = {
            table: store.with_loads(table, moved).join(takes_over, ["activity_id", LOAD], "left_anti") for table in LAYOUTS
        }
        left["files"] = store.files().where(F.col(LOAD).isin(moved)).join(takes_over, ["activity_id", LOAD], "left_anti")
        store.amend(left, moved, f"moved to {load_id}", [run])
    else:
        store.commit(run)


Summaries = DataFrame | Callable[[datetime], DataFrame]


def load_connect(
    store: Store, messages: DataFrame, sidecars: Summaries, load_id: str, min_rows: float | None = None,
    may_shrink: bool = False,
) -> None:
    """Load all summarised files newer than the newest stored activity.

    ``sidecars`` are summaries, or a function that reads those not older than a time
    (``sources.sidecar.summaries_since``): then only files that can belong to the load are opened.
    """
    use_utc(store.spark)
    mark = mark_of(store, load_id)
    known = sidecars(mark) if callable(sidecars) else sidecars
    plan = plan_connect(messages, known, store.read("activity", but=load_id), mark)
    run_load(store, plan, load_id, min_rows, "connect", mark, may_shrink)


def load_watch(
    store: Store,
    messages: DataFrame,
    places: DataFrame | None,
    load_id: str,
    now: datetime | None = None,
    min_rows: float | None = None,
    may_shrink: bool = False,
) -> None:
    """Load all watch files newer than the newest stored activity and not in the future."""
    use_utc(store.spark)
    mark = mark_of(store, load_id, now)
    plan = plan_watch(messages, places, store.read("activity", but=load_id), mark, now, min_rows)
    run_load(store, plan, load_id, min_rows, "watch", mark, may_shrink)


def mark_of(store: Store, load_id: str, now: datetime | None = None) -> datetime:
    """The mark of the load's first run; for a new load, the newest activity time stored before ``now``."""
    first = store.first_mark(load_id)
    return store.high_water(now, but=load_id) if first is None else first
