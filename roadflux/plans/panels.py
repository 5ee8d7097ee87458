"""Dashboard panels. Moments like "the last four hours" count back from ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadflux.functions import rules
from roadflux.functions.numbers import settled, shown


def back(as_of: Column, interval: str) -> Column:
    return as_of - F.expr(f"INTERVAL {interval}")


def _one(frame: DataFrame, label: str, value: Column, name: str = "metric") -> DataFrame:
    return frame.agg(value.alias("value")).select(F.lit(label).alias(name), "value")


def _best(frame: DataFrame, column: str, keep: int) -> DataFrame:
    return frame.orderBy(F.desc(column), "zone").limit(keep)


# --- map --------------------------------------------------------------------

def _located(coordinates: DataFrame, traffic: DataFrame) -> DataFrame:
    """Every known place, with the traffic of its zone where there is any.

    The coordinates are the small side but the preserved one, so the zone
    aggregate is what gets broadcast: one row per zone, sized by AQE.
    """
    measured = traffic.select("zone", F.col("trafic_moyen_vehicules_heure").alias("_t"))
    return coordinates.join(measured, "zone", "left")


def heat_map(coordinates: DataFrame, traffic: DataFrame) -> DataFrame:
    level = rules.density(F.col("_t"))
    load = F.coalesce(F.col("_t"), F.lit(0.0))
    return _located(coordinates, traffic).select(
        "zone_name",
        "latitude",
        "longitude",
        load.alias("traffic_density"),
        "zone_type",
        level.alias("density_level"),
        F.concat(
            "zone_name", F.lit("\nTraffic: "), shown(load, 1), F.lit(" veh/h\nLevel: "), level
        ).alias("tooltip_info"),
    ).orderBy("latitude", "longitude", "zone_name")


def markers(coordinates: DataFrame, traffic: DataFrame) -> DataFrame:
    return _located(coordinates, traffic).select(
        F.col("zone_name").alias("name"),
        "latitude",
        "longitude",
        F.col("_t").alias("traffic_density"),
        "zone_type",
        rules.marker_density(F.col("_t")).alias("density_level"),
    )


# Titles, prefixes and units below are those of the published panels.
# --- single numbers -----------------------------------------------------------

def average_congestion(congestion: DataFrame) -> DataFrame:
    return _one(congestion, "Average Congestion", F.avg("taux_congestion_pourcentage"))


def critical_zone_count(critical: DataFrame) -> DataFrame:
    return _one(critical, "Alert: Zones Critiques", F.count_if(F.col("niveau_congestion") != "Faible"))


def zone_count(traffic: DataFrame) -> DataFrame:
    return _one(traffic, "Zones Surveillées", F.count("*"))


def global_performance(speed: DataFrame) -> DataFrame:
    return _one(speed, "Performance Globale", settled(F.avg("vitesse_moyenne_kmh") / 50 * 100, 1), "name")


def fluidity_rate(congestion: DataFrame) -> DataFrame:
    return _one(congestion, "Taux de Fluidité", settled(100 - F.avg("taux_congestion_pourcentage"), 1))


def active_alert_count(alerts: DataFrame, as_of: Column, interval: str = "1 HOUR") -> DataFrame:
    recent = (F.col("status") == "ACTIVE") & (F.col("timestamp") >= back(as_of, interval))
    return _one(alerts.filter(recent), "Active Alerts", F.count("*"))


# --- top zones ----------------------------------------------------------------

def _named(prefix: str, value: str, unit: str) -> list[Column]:
    text = F.concat(F.lit(prefix), "zone", F.lit(": "), shown(F.col(value), 1), F.lit(unit))
    return [text.alias("name"), F.col(value).alias("value")]


def busiest_zone(traffic: DataFrame) -> DataFrame:
    value = "trafic_moyen_vehicules_heure"
    return _best(traffic, value, 1).select(*_named("Zone: ", value, " véhicules/h"))


def fastest_zone(speed: DataFrame) -> DataFrame:
    value = "vitesse_moyenne_kmh"
    return _best(speed, value, 1).select(*_named("Fast: ", value, " km/h"))


def traffic_ranking(traffic: DataFrame, keep: int = 8) -> DataFrame:
    value = F.col("trafic_moyen_vehicules_heure")
    return _best(traffic, "trafic_moyen_vehicules_heure", keep).select(
        "zone", value, F.round(value * F.lit(1.2), 0).alias("estimation_totale")
    )


def congestion_ranking(congestion: DataFrame, keep: int = 8) -> DataFrame:
    value = F.col("taux_congestion_pourcentage")
    return _best(congestion, "taux_congestion_pourcentage", keep).select(
        "zone", value, rules.congestion_state(value).alias("etat")
    )


def interventions(critical: DataFrame, keep: int = 10) -> DataFrame:
    level = F.col("niveau_congestion")
    table = critical.select(
        "zone",
        level.alias("alert_level"),
        rules.intervention(level, 0).alias("required_action"),
        rules.intervention(level, 1).alias("priority"),
        rules.intervention(level, 2).alias("recommendation"),
    )
    return table.orderBy(F.desc("priority"), "zone").limit(keep)


# --- series -------------------------------------------------------------------

def speed_series(snapshots: DataFrame, as_of: Column, interval: str = "4 HOURS") -> DataFrame:
    recent = snapshots.filter(F.col("processed_at") >= back(as_of, interval))
    return recent.select(F.col("processed_at").alias("time"), "vitesse_moyenne_kmh", "zone").orderBy("time", "zone")


def traffic_series(snapshots: DataFrame) -> DataFrame:
    return snapshots.select(
        F.col("processed_at").alias("time"), "trafic_moyen_vehicules_heure", "zone"
    ).orderBy("time", "zone")


def forecast_series(forecasts: DataFrame, as_of: Column, interval: str = "4 HOURS") -> DataFrame:
    recent = forecasts.filter(F.col("prediction_timestamp") >= back(as_of, interval))
    return recent.select(
        F.col("prediction_timestamp").alias("time"),
        "predicted_traffic",
        "predicted_speed",
        "zone",
        (F.col("confidence_score") * 100).alias("confidence_percent"),
    ).orderBy("time", "zone")


def metric_series(metrics: DataFrame, as_of: Column, interval: str = "24 HOURS") -> DataFrame:
    recent = metrics.filter(F.col("timestamp") >= back(as_of, interval))
    return recent.select(
        F.col("timestamp").alias("time"),
        "metric_value",
        F.concat("metric_name", F.lit(" ("), "metric_unit", F.lit(")")).alias("metric"),
        "zone",
    ).orderBy("time", "zone", "metric")


def since(events: DataFrame, as_of: Column, interval: str) -> DataFrame:
    """Events that a panel over the last ``interval`` can show.

    For panels over time units: a unit that is kept starts at or after that moment, and so do all its events. On the
    bare column, the filter reaches the scan below the aggregate.
    """
    return events.filter(F.col("event_time") >= back(as_of, interval))


def largest_differences(comparisons: DataFrame, as_of: Column, interval: str = "1 HOUR", keep: int = 10) -> DataFrame:
    """Biggest relative differences either way among recent comparisons."""
    ranked = comparisons.filter(F.col("timestamp") >= back(as_of, interval)).orderBy(
        F.abs("percentage_diff").desc(), "zone1", "zone2", "metric_name", "time_period"
    ).limit(keep)
    return ranked.select(
        F.concat("zone1", F.lit(" vs "), "zone2").alias("comparison"),
        "metric_name",
        "value1",
        "value2",
        "percentage_diff",
        "time_period",
    )


def flow_panel(by_direction: DataFrame) -> DataFrame:
    return by_direction.orderBy(F.desc("flow_volume"), "direction")


def latest_alerts(alerts: DataFrame, as_of: Column, interval: str = "24 HOURS", keep: int = 20) -> DataFrame:
    recent = alerts.filter(F.col("timestamp") >= back(as_of, interval))
    return recent.orderBy(F.desc("timestamp"), "alert_id").limit(keep).select(
        "alert_type", "severity", "zone", "vehicle_count", "average_speed", "occupancy_rate",
        F.col("timestamp").alias("time"), "status",
    )
