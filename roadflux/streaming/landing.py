"""Raw messages into the raw zone, by date and zone of each message."""

from __future__ import annotations

import contextlib
import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from roadflux import workspace
from roadflux.functions.text import path_safe
from roadflux.functions.timeparts import parse_to_second
from roadflux.schema import RAW_EVENT

QUARANTINE = "quarantine"  # date of messages whose time cannot be read
UNKNOWN = "Unknown"


def landing_rows(messages: DataFrame) -> DataFrame:
    """(date, zone, value): where each message goes, and the message as it came."""
    typed = messages.select("value", F.from_json("value", RAW_EVENT).alias("_d"))
    second = parse_to_second(F.col("_d.event_time"))
    return typed.select(
        F.coalesce(F.date_format(second, "yyyy-MM-dd"), F.lit(QUARANTINE)).alias("date"),
        F.coalesce(path_safe(F.col("_d.zone")), F.lit(UNKNOWN)).alias("zone"),
        "value",
    )


WRITERS = 256
_OPEN = "spark.sql.maxConcurrentOutputFileWriters"


@contextlib.contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """Inside, a task keeps a file open per folder it writes to instead of sorting its rows by folder, which holds them in memory.

    Rows of a task that writes to more than ``WRITERS`` folders are sorted from there on.
    """
    before = spark.conf.get(_OPEN)
    spark.conf.set(_OPEN, str(WRITERS))
    try:
        yield
    finally:
        spark.conf.set(_OPEN, before)


def land_batch(messages: DataFrame, path: str) -> None:
    """Rebalancing keeps files few and splits a zone that holds most messages."""
    with _unsorted(messages.sparkSession):
        landing_rows(messages).hint("rebalance", "date", "zone").write.mode("append").partitionBy("date", "zone").text(path)


ROWS_PER_FILE = 1_000_000


def land_stream(
    messages: DataFrame, path: str, checkpoint: str, rows_per_file: int = ROWS_PER_FILE, trigger: str | None = "30 seconds"
) -> StreamingQuery:
    """Continuous landing. Each micro-batch writes its own folder below date and zone, so that a replay overwrites it.

    A zone's messages of a batch are spread over as many tasks as their number calls for, by hash.
    """
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:8]

    def land(batch: DataFrame, batch_id: int) -> None:
        rows = landing_rows(batch)
        sizes = rows.groupBy(F.col("date").alias("_d"), F.col("zone").alias("_z")).agg(F.ceil(F.count("*") / rows_per_file).alias("_tasks"))
        sized = rows.join(sizes, (rows["date"] == sizes["_d"]) & (rows["zone"] == sizes["_z"]))
        spread = sized.repartition("date", "zone", F.pmod(F.xxhash64("value"), F.col("_tasks")))
        writer = spread.select("date", "zone", F.lit(f"{run}-{batch_id}").alias("batch"), "value").write.mode("overwrite")
        with _unsorted(batch.sparkSession):
            writer.option("partitionOverwriteMode", "dynamic").partitionBy("date", "zone", "batch").text(path)

    writer = messages.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


# --- compaction ------------------------------------------------------------------
# A landed batch is a folder per date and zone. ``store/parts/fold=N`` holds the messages of many batches in few files per date and zone,
# ``store/folded/fold=N`` the names of these batches; that list, once finished, is what makes the fold count.

_LANDED = "value string, date string, zone string, batch string"


def _folds(spark: SparkSession, store: str) -> list[int]:
    return workspace.finished(spark, f"{store}/folded", "fold")


def _folded(spark: SparkSession, store: str, folds: list[int]) -> DataFrame:
    """Names of the batches that finished folds hold."""
    return spark.read.schema("batch string").parquet(*[f"{store}/folded/fold={n}" for n in folds])


def _loose(spark: SparkSession, path: str, store: str, folds: list[int]) -> DataFrame:
    """Messages of batches that no fold holds. A folded batch that is landed again stays out."""
    rows = spark.read.schema(_LANDED).option("basePath", path).text(path)
    return rows.join(_folded(spark, store, folds), "batch", "left_anti") if folds else rows


def landed(spark: SparkSession, path: str, store: str) -> DataFrame:
    """(date, zone, value) of all messages that ``land_stream`` put below ``path``, each once, compacted or not."""
    folds = _folds(spark, store)
    rows = _loose(spark, path, store, folds).select("date", "zone", "value")
    for n in folds:
        part = f"{store}/parts/fold={n}"
        rows = rows.unionByName(spark.read.schema("value string, date string, zone string").option("basePath", part).text(part))
    return rows


def compact_landed(spark: SparkSession, path: str, store: str, rows_per_file: int = ROWS_PER_FILE) -> int | None:
    """Fold the loose batches into few files; returns the fold that did, None without anything to fold.

    The newest batch of each run may still be written, so it stays loose. Folders of batches that an earlier fold holds are removed: what a
    reader listed stays until the second compaction after it began. One compaction at a time; ``store`` lies outside ``path``.
    """
    folds = _folds(spark, store)
    done = {r.batch for r in _folded(spark, store, folds).collect()} if folds else set()  # a name per batch
    for old in workspace.folders(spark, f"{path}/date=*/zone=*/batch=*", done):  # before the files are listed below
        workspace.remove(spark, old)
    loose = _loose(spark, path, store, folds)
    number = F.substring_index("batch", "-", -1).cast("long")
    names = loose.select("batch", F.substring_index("batch", "-", 1).alias("run"), number.alias("n")).distinct()
    newest = names.groupBy("run").agg(F.max("n").alias("newest"))
    # At most the batches since the last fold, a name each.
    ready = workspace.written(names.join(newest, "run").filter("n < newest").select("batch"), "ready").coalesce(1)
    if ready.isEmpty():
        return None
    fold = folds[-1] + 1 if folds else 0
    rows = loose.join(ready, "batch", "left_semi").select("date", "zone", "value")
    part = rows.hint("rebalance", "date", "zone").write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    with _unsorted(spark):
        part.partitionBy("date", "zone").text(f"{store}/parts/fold={fold}")
    ready.write.mode("overwrite").parquet(f"{store}/folded/fold={fold}")
    return fold
