"""Readers for stored zones, catalog tables and the zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadflux.operators.upsert import merge_rows
from roadflux.schema import ZONE_COORDINATES

PROCESSED = ["traffic_by_zone", "speed_by_road", "congestion_by_zone", "hourly_analysis"]

# Zone, latitude, longitude (decimal text, cast to the declared type), display name, kind.
COORDINATES = (
    ("Centre_Ville", "33.5731", "-7.5898", "Casablanca Centre", "Urban"),
    ("Centre_Commercial", "33.5789", "-7.6328", "Maarif District", "Commercial"),
    ("Périphérie_Nord", "33.6157", "-7.5285", "Hay Hassani", "Residential"),
    ("Périphérie_Sud", "33.5333", "-7.5833", "Ain Diab", "Coastal"),
    ("Quartier_Résidentiel", "33.6014", "-7.6317", "Racine", "Residential"),
    ("Quartier_Est", "33.5731", "-7.5898", "Lissasfa", "Mixed"),
    ("Zone_Industrielle", "33.5478", "-7.6578", "Ain Sebaa", "Industrial"),
    ("Zone_Commerciale", "33.5789", "-7.6328", "Gauthier", "Commercial"),
)


def processed_zone(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{base}/{name}") for name in PROCESSED}


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def zone_coordinates(spark: SparkSession) -> DataFrame:
    text = spark.createDataFrame(COORDINATES, ZONE_COORDINATES.names)
    return text.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in ZONE_COORDINATES])


def merge_coordinates(known: DataFrame, incoming: DataFrame) -> DataFrame:
    """New zones are added; a known zone only moves, its name and kind stay."""
    return merge_rows(known, incoming, keys=["zone"], update=["latitude", "longitude"])


def as_kpi_input(events: DataFrame) -> DataFrame:
    """Event model of the second KPI family: short names, occupancy as a fraction."""
    from roadflux.functions.rules import event_service_letter

    return events.select(
        F.col("event_time").alias("timestamp"),
        "zone",
        "vehicle_count",
        F.col("average_speed").alias("speed"),
        (F.col("occupancy_rate") / F.lit(100.0)).alias("occupancy"),
        event_service_letter(F.col("average_speed")).alias("service_level"),
        "sensor_id",
        "road_type",
    )
