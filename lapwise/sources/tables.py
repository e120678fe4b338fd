"""The stored tables: a folder of Parquet per table, and the ledger of what was loaded into them.

Every run of a load writes folders of its own, ``load_id`` and ``run``, and touches nothing that was stored before. The
ledger is append-only: a run that begins notes its load's mark, one that has written everything notes which run
now counts for each table, how many rows it stored and the newest activity time. Readers see, of each load, the
runs of its last finished entry. So a load shows all at once or not at all; run again, it shows what it stored before until
the new run is whole; and a correction replaces one table of the loads it concerns and leaves all other files alone.

With ``buckets``, records and laps are kept in that many buckets of activities, sorted by activity and time, and are
registered in the session's catalog by their place: searches by activity then need no exchange.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from lapwise.functions.values import NO_ACTIVITY_YET
from lapwise.schemas import LAYOUTS, columns, struct
from lapwise.sinks.contract import RAW, REASONS

LOAD = "load_id"
RUN = "run"
FITS = "fits"
CLUSTERED = {"record": ["activity_id", "timestamp"], "lap": ["activity_id", "number"]}
MANY_LOADS = 10_000
_ASIDE = [T.StructField(REASONS, T.StringType()), T.StructField(RAW, T.StringType())]
_FOLDERS = [T.StructField(LOAD, T.StringType()), T.StructField(RUN, T.StringType()), T.StructField(FITS, T.BooleanType())]
_REJECTED = T.StructType([T.StructField(c, T.StringType()) for c in ("file", "stage", "reason")])
_FILES = T.StructType([T.StructField("file", T.StringType()), T.StructField("activity_id", T.LongType())])
_LEDGER = T.StructType([
    T.StructField(LOAD, T.StringType()), T.StructField("entry", T.LongType()), T.StructField("done", T.BooleanType()),
    T.StructField("source", T.StringType()), T.StructField("mark", T.TimestampType()),
    T.StructField("newest", T.TimestampType()), T.StructField("noted", T.TimestampType()),
    T.StructField("runs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
])


@dataclass
class Run:
    """One attempt at a load: where it writes, and what it has written."""

    load_id: str
    entry: int
    source: str
    mark: datetime | None
    runs: dict[str, str]
    counts: dict[str, int]
    newest: datetime | None = None

    @property
    def name(self) -> str:
        return str(self.entry)


class Store:
    """Reads and writes the seven tables under ``base``.

    Rows that do not fit their table go to the same load, apart from the others, with the reasons and the row as it came.
    ``buckets`` is fixed when the store is made and read from there afterwards.
    """

    def __init__(self, spark: SparkSession, base: str, buckets: int | None = None):
        self.spark = spark
        self.base = base.rstrip("/")
        layout = T.StructType([T.StructField("buckets", T.IntegerType())])
        known = self._open("layout", layout).first()
        if known is None and buckets is not None:
            made = spark.createDataFrame([(buckets,)], layout).coalesce(1)
            made.write.mode("errorifexists").parquet(self.path("layout"))
        elif known is not None and buckets not in (None, known["buckets"]):
            raise ValueError(f"the store has {known['buckets']} buckets, not {buckets}")
        self.buckets = buckets if known is None else known["buckets"]
        self._entered: set[tuple[str, str, str]] = set()

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def clustered(self, table: str) -> bool:
        """Whether the table's rows come partitioned by activity."""
        return self.buckets is not None and table in CLUSTERED

    # The ledger

    def history(self) -> DataFrame:
        """Every entry ever made: runs that began, and runs and corrections that were finished (``done``)."""
        return self._open("ledger", _LEDGER)

    def ledger(self) -> DataFrame:
        """One row per stored load: its source, the mark it used, its newest activity time, counts of rows, and runs by table."""
        last = F.max_by(F.struct(*[c for c in _LEDGER.names if c != LOAD]), "entry")
        return self.history().where("done").groupBy(LOAD).agg(last.alias("_last")).select(LOAD, "_last.*").drop("done")

    def begin(self, load_id: str, source: str, mark: datetime | None = None) -> Run:
        """Note that a run of ``load_id`` begins. The first run's mark stays the load's mark."""
        seen = self.history().where(F.col(LOAD) == load_id).agg(F.max("entry"), F.min_by("mark", "entry")).first()
        run = Run(load_id, (seen[0] or 0) + 1, source, mark if seen[0] is None else utc(seen[1]), {}, {})
        self._note([run], False)
        return run

    def commit(self, run: Run) -> None:
        """Let the run count: the load's last write."""
        self._note([run], True)

    def first_mark(self, load_id: str) -> datetime | None:
        """The mark that the load's first run noted; none for a load not begun."""
        first = self.history().where(F.col(LOAD) == load_id).agg(F.min_by("mark", "entry")).first()[0]
        return utc(first)

    def high_water(self, now: datetime | None = None, but: str | None = None) -> datetime:
        """The newest stored activity time before ``now``, from the ledger; without load ``but``.

        Only of loads whose newest activity lies ahead of ``now``, activities are looked at.
        """
        now = now or datetime.now(timezone.utc)
        now = now if now.tzinfo else now.replace(tzinfo=timezone.utc)
        loads = [r for r in self.ledger().select(LOAD, "newest").collect() if r[LOAD] != but and r["newest"] is not None]
        marks = [utc(r["newest"]) for r in loads]
        before = [m for m in marks if m < now]
        ahead = [r[LOAD] for r, m in zip(loads, marks) if m >= now]
        if ahead:
            times = self._read("activity", struct("activity"), True, only=ahead)
            latest = times.where(F.col("timestamp") < F.lit(now)).agg(F.max("timestamp")).first()[0]
            before += [] if latest is None else [utc(latest)]
        return max(before, default=datetime.fromisoformat(NO_ACTIVITY_YET).astimezone(timezone.utc))

    def _note(self, runs: list[Run], done: bool) -> None:
        """Append entries as one file, which shows whole or not at all."""
        noted = datetime.now(timezone.utc)
        rows = [(r.load_id, r.entry, done, r.source, r.mark, r.newest, noted, r.runs, r.counts) for r in runs]
        self.spark.createDataFrame(rows, _LEDGER).coalesce(1).write.mode("append").parquet(self.path("ledger"))

    # The tables

    def read(self, table: str, but: str | None = None) -> DataFrame:
        """The table, without load ``but``; no rows where nothing was loaded yet."""
        return self._read(table, struct(table), fits=True, but=but)

    def with_loads(self, table: str, only: list[str] | None = None) -> DataFrame:
        """All rows, those set aside too, with ``load_id``, ``reasons``, ``raw`` and ``fits``."""
        kinds = T.StructType([*struct(table), *_ASIDE])
        return self._read(table, kinds, fits=None, only=only, extra=[LOAD, FITS])

    def set_aside(self, table: str) -> DataFrame:
        """Rows left out of the table: ``activity_id, reasons, raw``."""
        return self._read(table, T.StructType([struct("event")["activity_id"], *_ASIDE]), fits=False)

    def rejected(self) -> DataFrame:
        """Files left out whole: ``file, stage, reason``."""
        stored = self._open("rejected", T.StructType([*_REJECTED, *_FOLDERS[:2]]))
        return self._counting(stored, "rejected").select(*_REJECTED.names)

    def write(self, table: str, rows: DataFrame, run: Run) -> None:
        """Store ``rows`` in one pass, those with ``reasons`` apart.

        Within each file points are sorted by activity and time, and block filters on the
        activity let a query for one skip the other blocks. Without buckets neither needs a shuffle.
        """
        for f in _ASIDE:
            if f.name not in rows.columns:
                rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
        fits = F.coalesce(F.col(REASONS), F.lit("")) == ""
        raw = F.when(~fits, F.col(RAW)).alias(RAW)
        out = rows.select(*struct(table).names, REASONS, raw, fits.alias(FITS))
        seen = Observation()
        out = out.observe(seen, F.count_if(FITS).alias("n"), F.count_if(~F.col(FITS)).alias("aside"))
        self.put(table, out.withColumns({LOAD: F.lit(run.load_id), RUN: F.lit(run.name)}))
        run.runs[table] = run.name
        run.counts[table], run.counts[f"{table} set aside"] = seen.get["n"], seen.get["aside"]

    def put(self, table: str, rows: DataFrame) -> None:
        """Add rows that name their load and run; they count once an entry names the run."""
        names = [*struct(table).names, *[f.name for f in _ASIDE], *[f.name for f in _FOLDERS]]
        rows = rows.select(*names)
        if self.clustered(table):
            rows = rows.repartition(self.buckets, "activity_id")
        elif table in CLUSTERED:
            rows = rows.sortWithinPartitions(FITS, *CLUSTERED[table])
        writer = rows.write.mode("append").partitionBy(LOAD, RUN, FITS)
        writer = writer.option("parquet.bloom.filter.enabled#activity_id", str(table == "record").lower())
        if self.clustered(table):
            name = self._registered(table, [])
            writer.bucketBy(self.buckets, "activity_id").sortBy(*CLUSTERED[table]).format("parquet").saveAsTable(name)
        else:
            writer.parquet(self.path(table))

    def write_rejected(self, files: DataFrame, run: Run) -> None:
        files.select(*_REJECTED.names, F.lit(run.load_id).alias(LOAD), F.lit(run.name).alias(RUN)).write.mode(
            "append"
        ).partitionBy(LOAD, RUN).parquet(self.path("rejected"))
        run.runs["rejected"] = run.name

    def write_files(self, files: DataFrame, run: Run) -> None:
        """Note which file each activity of the run came from: ``file, activity_id``."""
        files.select(*_FILES.names, F.lit(run.load_id).alias(LOAD), F.lit(run.name).alias(RUN)).write.mode(
            "append"
        ).partitionBy(LOAD, RUN).parquet(self.path("files"))
        run.runs["files"] = run.name

    def files(self) -> DataFrame:
        """``file, activity_id, load_id`` of every stored activity."""
        stored = self._open("files", T.StructType([*_FILES, *_FOLDERS[:2]]))
        return self._counting(stored, "files").select(*_FILES.names, LOAD)

    def amend(self, changes: dict[str, DataFrame], loads: list[str], source: str, with_runs: list[Run] = ()) -> None:
        """Replace tables of ``loads``, each by all the rows it then has, those set aside too (as ``with_loads`` gives them).

        Other tables and other loads keep their files. The change shows all at once, together with ``with_runs``;
        broken off before, it leaves everything as it was.
        """
        name = f"c{uuid.uuid4().hex}"
        for table, rows in changes.items():
            if table == "files":
                rows.select(*_FILES.names, LOAD, F.lit(name).alias(RUN)).write.mode("append").partitionBy(LOAD, RUN).parquet(
                    self.path(table)
                )
            else:
                self.put(table, rows.withColumn(RUN, F.lit(name)))
        entries = {r[0]: r[1] for r in self.history().groupBy(LOAD).agg(F.max("entry")).where(F.col(LOAD).isin(loads)).collect()}
        amended = {}
        for r in self.ledger().where(F.col(LOAD).isin(loads)).collect():
            runs, counts = dict(r["runs"]), dict(r["counts"])
            for table in changes:
                runs[table] = name
                counts |= {table: 0, f"{table} set aside": 0} if table in LAYOUTS else {}
            amended[r[LOAD]] = Run(r[LOAD], entries[r[LOAD]] + 1, source, utc(r["mark"]), runs, counts, utc(r["newest"]))
        for table in set(changes) & set(LAYOUTS):
            kinds = T.StructType([*struct(table), *_FOLDERS])
            newest = F.max("timestamp") if table == "activity" else F.lit(None)
            there = self._open(table, kinds).where(F.col(RUN) == name).groupBy(LOAD, FITS).agg(
                F.count(F.lit(1)).alias("n"), newest.alias("newest")
            )
            if table == "activity":
                for run in amended.values():
                    run.newest = None
            for r in there.collect():
                run = amended[r[LOAD]]
                run.counts[table if r[FITS] else f"{table} set aside"] = r["n"]
                if table == "activity" and r[FITS]:
                    run.newest = utc(r["newest"])
        self._note([*amended.values(), *with_runs], True)

    def unused(self) -> DataFrame:
        """``file_path`` of files that no stored load counts: left by runs broken off, replaced or still going on."""
        parts = None
        for table in [*LAYOUTS, "files", "rejected"]:
            current = self._current(table, None, None).withColumn("table", F.lit(table))
            parts = current if parts is None else parts.unionByName(current)
        spot = F.regexp_extract("file_path", r"/([^/]+)/load_id=([^/]*)/run=([^/]*)/", 0)
        kept = F.concat(F.lit("/"), "table", F.lit("/load_id="), LOAD, F.lit("/run="), RUN, F.lit("/"))
        there = list_files(self.spark, self.base, "*.parquet").withColumn("spot", spot).where("spot <> ''")
        return there.join(parts.select(kept.alias("spot")), "spot", "left_anti").select("file_path")

    def register_views(self) -> None:
        """All seven tables as temporary views, for SQL."""
        for table in LAYOUTS:
            self.read(table).createOrReplaceTempView(table)

    def _open(self, table: str, layout: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(layout).parquet(self.path(table))
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], layout)
            raise

    def _current(self, table: str, but: str | None, only: list[str] | None) -> DataFrame:
        """``load_id, run`` of the runs that count for the table."""
        now = self.ledger().select(LOAD, F.col("runs")[table].alias(RUN)).where(F.col(RUN).isNotNull())
        if but is not None:
            now = now.where(F.col(LOAD) != but)
        return now if only is None else now.where(F.col(LOAD).isin(only))

    def _counting(
        self, stored: DataFrame, table: str, but: str | None = None, only: list[str] | None = None
    ) -> DataFrame:
        """Rows of the runs that count. Up to ``MANY_LOADS`` are named in the plan, so other folders are not read."""
        current = self._current(table, but, only)
        parts = current.limit(MANY_LOADS + 1).collect()
        if len(parts) > MANY_LOADS:
            return stored.join(current, [LOAD, RUN], "left_semi")
        return stored.where(_place().isin([f"{p[LOAD]}/{p[RUN]}" for p in parts]) if parts else F.lit(False))

    def _read(
        self, table: str, layout: T.StructType, fits: bool | None, but: str | None = None, only: list[str] | None = None,
        extra: list[str] = (),
    ) -> DataFrame:
        if self.clustered(table):
            parts = self._current(table, None, None).collect()
            stored = self.spark.table(self._registered(table, [(p[LOAD], p[RUN]) for p in parts]))
            # Under names without the table's: Spark then sees the same partitioning on both sides of a union.
            stored = stored.select(*[F.col(c).alias(c) for c in stored.columns])
        else:
            stored = self._open(table, T.StructType([*layout, *_FOLDERS]))
        if fits is not None:
            stored = stored.where(F.col(FITS) == fits)
        return self._counting(stored, table, but, only).select(*layout.names, *extra)

    def _registered(self, table: str, parts: list[tuple[str, str]]) -> str:
        """Name in the catalog, with the runs given; the table is entered by its place if this session does not know it."""
        name = f"lapwise_{table}_{zlib.crc32(self.base.encode()):08x}"
        kinds = ", ".join(f"`{n}` {k}" for n, k in [*columns(table), (REASONS, "string"), (RAW, "string")])
        order = ", ".join(f"`{c}`" for c in CLUSTERED[table])
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({kinds}, {LOAD} STRING, {RUN} STRING, {FITS} BOOLEAN) USING parquet "
            f"PARTITIONED BY ({LOAD}, {RUN}, {FITS}) CLUSTERED BY (activity_id) SORTED BY ({order}) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.path(table)}'"
        )
        fresh = {(table, load, run) for load, run in parts} - self._entered
        if fresh:
            text = lambda s: s.replace("\\", "\\\\").replace("'", "\\'")
            named = [
                f"PARTITION ({LOAD}='{text(load)}', {RUN}='{text(run)}', {FITS}={fits})"
                for _, load, run in sorted(fresh) for fits in ("true", "false")
            ]
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(named)}")
            self._entered |= fresh
        return name


def _place() -> Column:
    return F.concat_ws("/", LOAD, RUN)


def utc(time: datetime | None) -> datetime | None:
    """A collected time, which is local and without a zone, in UTC."""
    return None if time is None else time.astimezone(timezone.utc)


def list_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """``file, file_path`` of the files in a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("path").alias("file_path"))
