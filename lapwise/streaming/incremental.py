"""Loads that follow a folder of messages.

The file source remembers which files it has read, so late ones are loaded too, unlike a
batch load, which skips files older than the newest stored activity.

``follow`` takes each file of messages to hold whole activities. ``follow_pieces`` lets an activity arrive in pieces: it
is loaded when nothing more has come for a while. Every micro-batch is a load, named by the stream and its number: a
batch replayed after a failure replaces itself, and streams into one store never meet.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lapwise.functions import names
from lapwise.functions.values import NO_ACTIVITY_YET
from lapwise.plans.ingest import Load, plan_connect, plan_watch, run_load
from lapwise.schemas import MESSAGES
from lapwise.session import durable, use_utc
from lapwise.sources.messages import kept_by_name
from lapwise.sources.tables import LOAD, Store, utc

ARRIVED = "arrived"
_EVER = datetime.fromisoformat(NO_ACTIVITY_YET).astimezone(timezone.utc)


def message_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Messages as they come, with the time their file was written as ``arrived``."""
    reader = spark.readStream.schema(MESSAGES).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(*MESSAGES.names, F.col("_metadata.file_modification_time").alias(ARRIVED))


def follow(
    messages: DataFrame,
    store: Store,
    checkpoint: str,
    sidecars: Callable[[datetime], DataFrame] | None = None,
    places: DataFrame | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Load what has arrived and stop, or go on ``every`` interval.

    With ``sidecars`` (``sources.sidecar.summaries_since``), files are taken for summarised exports, otherwise for watch
    files. It is called for every micro-batch with the time of its oldest file, so summaries that arrive later are
    seen and older ones are not opened. All messages of an activity must arrive in one micro-batch: write them to one file.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        use_utc(batch.sparkSession)
        load_id = _load_id(batch.sparkSession, checkpoint, batch_id)
        # Every step of a load would read the whole batch anew. The next batch's messages take their place.
        kept = kept_by_name(batch, f"{checkpoint.rstrip('/')}/lapwise-messages")
        plan = _plan(kept, store.read("activity", but=load_id), sidecars, places)
        run_load(store, plan, load_id, source="connect stream" if sidecars else "watch stream")

    return _start(messages, load, checkpoint, every)


def follow_pieces(
    messages: DataFrame,
    stored_messages: Callable[[], DataFrame],
    store: Store,
    checkpoint: str,
    sidecars: Callable[[datetime], DataFrame] | None = None,
    places: DataFrame | None = None,
    gap: str = "30 minutes",
    late: str = "0 seconds",
    every: str | None = None,
) -> StreamingQuery:
    """The same for activities whose messages arrive in pieces, over any number of micro-batches.

    A session window over ``arrived`` runs per file, closes when nothing has come for ``gap`` and the watermark (``late``
    behind the newest arrival) has passed, and is appended once. The state holds a count per open file; the messages of
    closed ones are read from ``stored_messages``, the same folder read as a table. A piece that comes after its
    activity was loaded opens a session of its own; when that closes, the activity is loaded anew, whole, and
    moves from its old load to the new one in one step.
    """
    open_ = messages.withWatermark(ARRIVED, late).groupBy(F.session_window(ARRIVED, gap).alias("open"), "file")
    closed = open_.agg(F.count(F.lit(1)).alias("messages")).select("file", "messages", F.col("open.end").alias("closed"))

    def load(batch: DataFrame, batch_id: int) -> None:
        use_utc(batch.sparkSession)
        load_id = _load_id(batch.sparkSession, checkpoint, batch_id)
        files = durable(batch.select("file").distinct())
        if files.isEmpty():
            return
        again = store.files().where(F.col(LOAD) != load_id).join(files, "file", "left_semi").select("activity_id", LOAD)
        other = store.read("activity", but=load_id).join(again, "activity_id", "left_anti")
        whole = stored_messages().join(files, "file", "left_semi")
        run_load(
            store, _plan(whole, other, sidecars, places), load_id, takes_over=again,
            source="connect pieces" if sidecars else "watch pieces",
        )

    return _start(closed, load, checkpoint, every)


def _plan(
    batch: DataFrame, stored: DataFrame, sidecars: Callable[[datetime], DataFrame] | None, places: DataFrame | None
) -> Load:
    if sidecars is None:
        return plan_watch(batch, places, stored, _EVER)
    oldest = utc(batch.agg(F.min(names.export_time(F.col("file")))).first()[0])
    return plan_connect(batch, sidecars(oldest or _EVER), stored, _EVER)


def _load_id(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """Named by the stream, whose id its checkpoint keeps across restarts, and the batch."""
    about = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return f"stream-{json.loads(about)['id']}-{batch_id}"


def _start(
    stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str, every: str | None
) -> StreamingQuery:
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(load)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
