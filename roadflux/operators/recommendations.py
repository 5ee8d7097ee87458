"""Suggestions for roads that are often congested or simply slow."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadflux.operators import kpis

# Fixed values
HIGH_CONGESTION_TEXT = "Augmenter la capacité ou ajouter des voies alternatives"
LOW_SPEED_TEXT = "Améliorer les conditions de circulation"


def recommend(totals: DataFrame, often: float = 0.3) -> DataFrame:
    """Two sets of different shape in one table; what a set lacks is NULL.

    ``totals`` is ``kpis.road_totals``, which both sets read; store it when it
    comes straight from events.
    """
    jammed = kpis.congested_routes(kpis.route_congestion(totals), above=often).select(
        "road_id",
        "zone",
        F.lit("HIGH_CONGESTION").alias("type"),
        F.lit(HIGH_CONGESTION_TEXT).alias("recommendation"),
        "congestion_rate",
        F.lit("HIGH").alias("priority"),
    )
    slow = kpis.slow_roads(totals).select(
        "road_id",
        F.lit("LOW_SPEED").alias("type"),
        F.lit(LOW_SPEED_TEXT).alias("recommendation"),
        "avg_speed",
        F.lit("MEDIUM").alias("priority"),
    )
    return jammed.unionByName(slow, allowMissingColumns=True)
