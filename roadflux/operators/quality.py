"""Profiles and gates: what came in, and is it enough to go on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

# Rows a step needs before it makes sense to run it.
MINIMUM_ROWS = {
    "not_empty": 1,
    "history": 100,
    "traffic_model": 50,
    "congestion_model": 20,
}


def null_counts(rows: DataFrame) -> DataFrame:
    """(column, nulls) for every column, in one pass."""
    counted = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in rows.columns])
    return counted.unpivot([], rows.columns, "column", "nulls")


def load_profile(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count("*").alias("total_rows"),
        F.count("vehicle_count").alias("vehicle_count_present"),
        F.count("average_speed").alias("average_speed_present"),
        F.count("occupancy_rate").alias("occupancy_rate_present"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
    )


def period_covered(events: DataFrame) -> DataFrame:
    day = F.date_format("event_time", "yyyy-MM-dd")
    return events.agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"))


def reject_counts(audited: DataFrame) -> DataFrame:
    reason = F.coalesce("reject_reason", F.lit("accepted"))
    return audited.groupBy(reason.alias("reason")).agg(F.count("*").alias("lines"))


def volume_gates(rows: DataFrame, minimums: Mapping[str, int] = MINIMUM_ROWS) -> DataFrame:
    gates = F.array(*[
        F.struct(F.lit(name).alias("check"), F.lit(need).cast("long").alias("minimum"))
        for name, need in minimums.items()
    ])
    return rows.agg(F.count("*").alias("actual")).select(F.inline(gates), "actual").withColumn(
        "passed", F.col("actual") >= F.col("minimum")
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows) for each named table."""
    counts = [
        frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, frame in tables.items()
    ]
    return _stack(counts)


def zone_validation(zones: Mapping[str, DataFrame]) -> DataFrame:
    """One pass/fail row per stored zone: present means it holds at least one row."""
    return row_counts(zones).select(
        F.col("table").alias("check"), F.col("rows").alias("actual"), (F.col("rows") > 0).alias("passed")
    )


def dataset_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset, rows, columns) of written tables."""
    widths = {name: len(frame.columns) for name, frame in tables.items()}
    width = F.create_map(*[F.lit(x) for pair in widths.items() for x in pair])
    return row_counts(tables).select(
        F.col("table").alias("dataset"), "rows", width[F.col("table")].alias("columns")
    )


def _stack(frames: list[DataFrame]) -> DataFrame:
    head, *rest = frames
    for frame in rest:
        head = head.unionByName(frame)
    return head
