"""Live window metrics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from roadflux import workspace
from roadflux.operators.alerts import window_metrics

# Fixed values
WINDOW, DELAY, TRIGGER = "1 minute", "2 minutes", "30 seconds"


def live_metrics(events: DataFrame, duration: str = WINDOW, delay: str = DELAY) -> DataFrame:
    """Metrics per window, road and zone; rows later than ``delay`` are dropped.

    ``events`` comes from ``sources.raw.stream_events``: event time, not arrival
    time, decides the window.
    """
    return window_metrics(events.withWatermark("event_time", delay), duration)


# --- the end of a stream ---------------------------------------------------------
# A window closes when the watermark passes it, so the last ones stay open when no events follow. An end marker is a row
# that only has a moment: it moves the watermark there. Its own window never closes, so it shows up nowhere.

def with_ends(events: DataFrame, folder: str) -> DataFrame:
    """The stream together with the end markers written to ``folder``, before or after its start."""
    spark = events.sparkSession
    workspace.make_folder(spark, folder)
    marks = spark.readStream.schema("event_time timestamp").parquet(folder)
    # Nullable in every batch, as a batch without marks would else give keys another type than the state has; events without a time
    # are in no window.
    timed = F.col("event_time").isNotNull()
    loose = events.select(*[c if c == "event_time" else F.when(timed, F.col(c)).alias(c) for c in events.columns])
    return loose.unionByName(marks, allowMissingColumns=True)


def end_at(spark: SparkSession, folder: str, moment: dt.datetime) -> None:
    """Close the windows that end by ``moment`` less the watermark's delay. Only after the stream has read all its events: later
    ones with an earlier time count as late. A moment before the watermark changes nothing."""
    marked = spark.createDataFrame([(moment,)], "event_time timestamp")
    marked.coalesce(1).write.mode("append").parquet(folder)


def run(
    stream: DataFrame,
    each_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """Start a query; ``trigger=None`` handles what is there and stops.

    ``update`` mode shows a window again whenever it changes; use it for live
    displays only. Alerts need ``append``, where a window arrives once, complete.
    """
    writer = stream.writeStream.foreachBatch(each_batch).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def live_display(path: str) -> Callable[[DataFrame, int], None]:
    """Batch handler that keeps each update batch as its own folder; replays overwrite it."""
    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return keep
