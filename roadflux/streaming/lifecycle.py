"""Alert lifecycle as keyed state: the streaming form of ``operators.alerts.lifecycle``.

State is one entry per open alert type of a road and zone, so at most three
entries per key. Every change leaves as one row; the last row of an alert is its
current state.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.utils import AnalysisException

from roadflux import workspace
from roadflux.functions import rules
from roadflux.functions.timeparts import epoch_micros
from roadflux.operators import alerts as batch
from roadflux.operators.upsert import latest_rows
from roadflux.session import tune_streaming

# Moments are epoch microseconds inside the stateful step.
TIMES = ["timestamp", "last_update", "resolved_at", "changed_at"]
_CHANGE = (
    "alert_id string, alert_type string, severity string, road_id string, zone string, "
    "vehicle_count double, average_speed double, occupancy_rate double, timestamp bigint, status string, "
    "escalation_count int, last_update bigint, resolved_at bigint, duration_seconds bigint, "
    "change string, changed_at bigint"
)
_STATE = (
    "opened bigint, escalated bigint, updated bigint, n int, "
    "vehicle_count double, average_speed double, occupancy_rate double"
)


class AlertTracker(StatefulProcessor):
    """Opens, refreshes, escalates and resolves the alerts of one road and zone."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._open = handle.getMapState("open_alerts", "alert_type string", _STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timer_values) -> Iterator[Row]:
        # State is loaded and stored once per key and batch. One row per closed window; a batch holds only the windows
        # closed since the last one.
        before = {kind: tuple(state) for (kind,), state in self._open.iterator()}
        now = dict(before)
        for row in sorted(rows, key=lambda r: r.window_end):
            if row.alert_type is None:
                for kind, state in now.items():
                    yield self._row(key, kind, state, "RESOLVED", row.window_end, row.window_end)
                now.clear()
            else:
                metrics = (row.avg_vehicle_count, row.avg_speed, row.avg_occupancy_rate)
                now[row.alert_type], change = batch.next_state(now.get(row.alert_type), row.alert_type, row.window_end, metrics)
                yield self._row(key, row.alert_type, now[row.alert_type], change, row.window_end, None)
        for kind in before.keys() - now.keys():
            self._open.removeKey((kind,))
        for kind, state in now.items():
            if before.get(kind) != state:
                self._open.updateValue((kind,), state)

    @staticmethod
    def _row(key, kind: str, state: tuple, change: str, at: int, resolved: int | None) -> Row:
        opened, _, updated, n, vehicles, speed, occupancy = state
        road, zone = key
        named = [part for part in (kind, road, zone, str(opened // batch.SECOND)) if part is not None]
        return Row(
            alert_id="_".join(named), alert_type=kind, severity=rules.ALERTS[kind][3], road_id=road, zone=zone,
            vehicle_count=vehicles, average_speed=speed, occupancy_rate=occupancy, timestamp=opened,
            status="RESOLVED" if resolved else "ACTIVE", escalation_count=n, last_update=updated,
            resolved_at=resolved, duration_seconds=(resolved - opened) // batch.SECOND if resolved else None,
            change=change, changed_at=at,
        )

    def close(self) -> None:
        pass


def alert_changes(metrics: DataFrame) -> DataFrame:
    """Change rows for a stream of closed windows (append mode)."""
    tune_streaming(metrics.sparkSession)
    windows = batch.detect(metrics).select(
        "road_id", "zone", epoch_micros(F.col("window_end")).alias("window_end"),
        "avg_vehicle_count", "avg_speed", "avg_occupancy_rate", "alert_type",
    )
    tracked = windows.groupBy("road_id", "zone").transformWithState(
        AlertTracker(), outputStructType=_CHANGE, outputMode="Append", timeMode="None"
    )
    return tracked.withColumns({c: F.timestamp_micros(c) for c in TIMES})


def open_alerts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The open alerts that the state below a checkpoint holds after its last batch.

    Read from the state store itself, so it does not depend on the change log, nor on what became of it. The job may be running: the
    state is read as of the last finished batch.
    """
    operators = spark.read.format("state-metadata").load(checkpoint).filter(F.col("operatorName").startswith("transformWithState"))
    state = spark.read.format("statestore").options(
        path=checkpoint, operatorId=operators.first().operatorId, stateVarName="open_alerts").load()
    held = state.select("key.road_id", "key.zone", "user_map_key.alert_type", "user_map_value.*")
    moment = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return held.select(
        "road_id", "zone", "alert_type", "vehicle_count", "average_speed", "occupancy_rate", moment("opened").alias("timestamp"),
        F.col("n").alias("escalation_count"), moment("updated").alias("last_update"))


# --- alert store -------------------------------------------------------------
# changes/batch=N holds the change rows of one micro-batch, snapshots/upto=N the
# last row of every alert as of that batch, runs/ which stream run has which checkpoint.
# N counts on over runs: run number times BATCHES_PER_RUN plus the batch of the run.

BATCHES_PER_RUN = 1_000_000_000


def batch_number(run: int, batch_id: int) -> int:
    return run * BATCHES_PER_RUN + batch_id


def run_number(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The run that owns a checkpoint; a checkpoint not seen before starts a new run, whose batches come after all others."""
    try:
        known = {r.checkpoint: r.run for r in spark.read.parquet(f"{path}/runs").collect()}  # a row per start of the job
    except AnalysisException:
        known = {}
    if checkpoint not in known:
        known[checkpoint] = max(known.values(), default=-1) + 1
        spark.createDataFrame([(checkpoint, known[checkpoint])], "checkpoint string, run long").write.mode("append").parquet(f"{path}/runs")
    return known[checkpoint]


def keep_changes(path: str, run: int = 0):
    """Batch handler: the changes of a batch form one folder, which a replay overwrites."""
    def keep(changes: DataFrame, batch_id: int) -> None:
        changes.write.mode("overwrite").parquet(f"{path}/changes/batch={batch_number(run, batch_id)}")

    return keep


def changes(spark: SparkSession, path: str) -> DataFrame:
    """Change rows that are not folded into a snapshot and removed."""
    return spark.read.parquet(f"{path}/changes")


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def _latest_changes(spark: SparkSession, path: str) -> DataFrame:
    """Last change row of every alert: newest snapshot plus the batches after it."""
    log, snapshots = _read_or_none(spark, f"{path}/changes"), _read_or_none(spark, f"{path}/snapshots")
    if snapshots is None:
        rows = changes(spark, path).drop("batch")
    else:
        upto = snapshots.agg(F.max("upto")).first()[0]
        rows = snapshots.filter(F.col("upto") == upto).drop("upto")
        if log is not None:
            rows = rows.unionByName(log.filter(F.col("batch") > upto).drop("batch"))
    return latest_rows(rows, ["alert_id"], "changed_at")


def take_snapshot(spark: SparkSession, path: str) -> int:
    """Fold all batches so far into a snapshot, so that readers skip them; returns its batch.

    A snapshot is never written over: without new batches the last one stands.
    """
    log, snapshots = _read_or_none(spark, f"{path}/changes"), _read_or_none(spark, f"{path}/snapshots")
    done = snapshots.agg(F.max("upto")).first()[0] if snapshots is not None else None
    upto = log.agg(F.max("batch")).first()[0] if log is not None else None
    if upto is None or (done is not None and upto <= done):
        return done
    _latest_changes(spark, path).write.parquet(f"{path}/snapshots/upto={upto}")
    return upto


def compact(spark: SparkSession, path: str) -> int | None:
    """Take a snapshot, and remove what the one before it had replaced already. For the job that owns the store.

    So whatever a reader listed stays there until the second compaction after it began.
    """
    snapshots = _read_or_none(spark, f"{path}/snapshots")
    before = snapshots.agg(F.max("upto")).first()[0] if snapshots is not None else None
    upto = take_snapshot(spark, path)
    if before is None or before == upto:
        return upto
    for row in changes(spark, path).filter(F.col("batch") <= before).select("batch").distinct().collect():  # at most the batches since the last time
        workspace.remove(spark, f"{path}/changes/batch={row.batch}")
    for row in snapshots.filter(F.col("upto") < before).select("upto").distinct().collect():
        workspace.remove(spark, f"{path}/snapshots/upto={row.upto}")
    return upto


def current_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Current state of every alert; insert or update by alert_id."""
    times = ["timestamp", "last_update", "resolved_at"]
    last = _latest_changes(spark, path).drop("change", "changed_at")
    return last.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def told(rows: DataFrame) -> DataFrame:
    """Changes worth a notification, with ``is_escalation`` telling which kind."""
    kept = rows.filter(F.col("change").isin("OPENED", "ESCALATED"))
    return kept.withColumn("is_escalation", F.col("change") == "ESCALATED")


def announcements(spark: SparkSession, path: str) -> DataFrame:
    return told(changes(spark, path))
