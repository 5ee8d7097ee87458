"""Events as keyed messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadflux.schema import EVENT

# How a message is written.
JSON = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
PRODUCER = {"kafka.acks": "all", "kafka.compression.type": "gzip", "kafka.retries": "5"}


def keyed(events: DataFrame) -> DataFrame:
    """(key, value): the zone, or ``default``, and the event as JSON."""
    return events.select(
        F.coalesce("zone", F.lit("default")).alias("key"),
        F.to_json(F.struct(*EVENT.names), JSON).alias("value"),
    )


def publish(events: DataFrame, servers: str, topic: str) -> None:
    """Send to a topic; needs the Kafka connector on the classpath."""
    writer = keyed(events).write.format("kafka").options(**PRODUCER)
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()
