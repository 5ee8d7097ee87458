"""Model features: calendar, past values, rolling statistics, next-step targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from roadflux.functions.rules import congestion_target
from roadflux.functions.timeparts import with_calendar
from roadflux.operators import series

SERIES = ["road_id", "zone"]
# Time decides; the measures only make the order of simultaneous readings repeatable.
ORDER = ["event_time", "sensor_id", "vehicle_count", "average_speed", "occupancy_rate"]
# The columns whose missing history counts as zero.
FILLED = [
    "vehicle_count_lag1", "vehicle_count_lag2", "speed_lag1", "speed_lag2",
    "occupancy_lag1", "occupancy_lag2", "vehicle_count_ma3", "speed_ma3", "occupancy_ma3",
    "vehicle_count_std3", "speed_std3",
]
BACK, AHEAD = 3, 1


def history(events: DataFrame, seconds_per_chunk: float = series.SECONDS_PER_CHUNK) -> DataFrame:
    """Lags, four-row rolling statistics and next-step values per road and zone.

    All columns share one partitioning; ``series.framed`` says what it costs.
    """
    return series.framed(events, SERIES, ORDER, BACK, AHEAD, _columns, seconds_per_chunk)


def _columns(w: WindowSpec) -> dict[str, Column]:
    rolling = w.rowsBetween(-BACK, 0)
    measures = {"vehicle_count": "vehicle_count", "speed": "average_speed", "occupancy": "occupancy_rate"}
    columns = {}
    for short, name in measures.items():
        columns[f"{short}_lag1"] = F.lag(name, 1).over(w)
        columns[f"{short}_lag2"] = F.lag(name, 2).over(w)
        columns[f"{short}_ma3"] = F.avg(name).over(rolling)
        if short != "occupancy":
            columns[f"{short}_std3"] = F.stddev_samp(name).over(rolling)
            columns[f"{short}_target"] = F.lead(name, 1).over(w)
    columns["congestion_target"] = congestion_target(
        F.lead("average_speed", 1).over(w), F.lead("occupancy_rate", 1).over(w)
    )
    return columns


def hourly_series(events: DataFrame) -> DataFrame:
    """One reading per road, zone and hour: the means of the hour. A step of such a series is an hour with readings."""
    hour = F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("event_time")
    return events.groupBy("road_id", "zone", hour).agg(
        F.max("sensor_id").alias("sensor_id"), F.max("road_type").alias("road_type"),
        *[F.avg(c).alias(c) for c in ("vehicle_count", "average_speed", "occupancy_rate")],
    )


def feature_table(events: DataFrame, seconds_per_chunk: float = series.SECONDS_PER_CHUNK) -> DataFrame:
    """Rows with a known next step; missing history counts as zero."""
    rows = with_calendar(history(events, seconds_per_chunk))
    known = rows.filter(F.col("vehicle_count_target").isNotNull() & F.col("speed_target").isNotNull())
    return known.fillna(0, FILLED)
