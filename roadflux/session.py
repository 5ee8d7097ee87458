"""Session settings the engine relies on."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings a running session may still change; the streaming ones are needed
# by transformWithState.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows differ much in length, so what goes to Python at once is bounded by bytes.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}
STREAMING = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made by somebody else, and send it this package."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


def tune_streaming(spark: SparkSession) -> SparkSession:
    for key, value in STREAMING.items():
        spark.conf.set(key, value)
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, for clusters where it is not installed (Python functions there import it)."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    # A file of the driver's; Spark hands it to the workers.
    folder = tempfile.mkdtemp(prefix="ship-")
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
    _shipped.add(context.applicationId)


def build(app: str = "roadflux", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session; pass extra settings as ``spark_sql_x="..."`` style keys.

    Shuffle parallelism is left to the cluster: with adaptive execution the
    configured number is only an upper bound that gets coalesced.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**RUNTIME, **STREAMING, "spark.python.unix.domain.socket.enabled": "true"}
    settings.update({key.replace("_", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark
