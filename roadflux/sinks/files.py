"""Parquet zones and report files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# Table name and partition columns of each zone. These tables are
# aggregates, so they are not split by hour as well; pass another layout to do so.
PROCESSED_LAYOUT: dict[str, list[str]] = {
    "traffic_by_zone": ["zone"],
    "speed_by_road": ["zone"],
    "congestion_by_zone": [],
    "hourly_analysis": ["zone"],
}
ANALYTICS_LAYOUT: dict[str, list[str]] = {
    "kpi_zone_strategique": [],
    "performance_routes": ["road_type"],
    "analyse_congestion": ["niveau_congestion"],
    "analyse_temporelle": ["periode_journee"],
    "tableau_bord_executif": [],
}
PREDICTION_COLUMNS = {
    "traffic_predictions": [
        "event_time", "road_id", "zone", "vehicle_count_target", "predicted_vehicle_count",
        "average_speed", "occupancy_rate",
    ],
    "congestion_predictions": [
        "event_time", "road_id", "zone", "congestion_target", "congestion_prediction",
        "average_speed", "occupancy_rate",
    ],
    "anomalies_detected": [
        "vehicle_count", "average_speed", "occupancy_rate", "hour", "day_of_week", "is_anomaly", "anomaly_score",
    ],
}


def write_table(
    rows: DataFrame, path: str, partition_by: Sequence[str] = (), stamp: bool = True, mode: str = "overwrite"
) -> None:
    """Write snappy Parquet. Partitioned output is rebalanced first, which keeps
    one partition value in few files and splits a value that holds most rows."""
    out = rows.withColumn("processed_at", F.current_timestamp()) if stamp else rows
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    writer = out.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_zone(
    tables: Mapping[str, DataFrame], base: str, layout: Mapping[str, Sequence[str]], stamp: bool = True
) -> dict[str, str]:
    """Write each table under ``base`` by its layout; returns the paths."""
    paths = {}
    for name, frame in tables.items():
        paths[name] = f"{base}/{name}"
        write_table(frame, paths[name], layout.get(name, ()), stamp)
    return paths


def read_back(spark: SparkSession, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """One row: rows written and distinct partitions."""
    rows = spark.read.parquet(path)
    parts = F.count_distinct(F.struct(*partition_by)) if partition_by else F.lit(1).cast("long")
    return rows.agg(F.count("*").alias("rows"), parts.alias("partitions"))


def write_predictions(tables: Mapping[str, DataFrame], base: str) -> dict[str, str]:
    """Keep the published columns of each result; tables without a list are kept whole."""
    kept = {
        name: frame.select(*PREDICTION_COLUMNS[name]) if name in PREDICTION_COLUMNS else frame
        for name, frame in tables.items()
    }
    return write_zone(kept, base, {}, stamp=False)


def write_report_json(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_report_text(report: DataFrame, title: str, path: str) -> None:
    """Title line, then one line per row in the report's order.

    Reports are a handful of rows, so one output file is what a reader wants.
    """
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in report.columns]
    body = report.select(F.concat_ws(" | ", *cells).alias("value"))
    header = report.sparkSession.createDataFrame([(title,), (" | ".join(report.columns),)], "value string")
    header.coalesce(1).union(body.coalesce(1)).coalesce(1).write.mode("overwrite").text(path)
