"""Second-level tables over the KPI tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadflux.functions import rules
from roadflux.functions.numbers import guarded_ratio, percent, settled
from roadflux.operators.ranking import dense_rank_desc

REPORT_TITLE = "Rapport Trafic Urbain"  # fixed value


def _mean(column: str, name: str):
    return settled(F.avg(column), 2).alias(name)


def strategic_zones(zone_hour: DataFrame) -> DataFrame:
    """Per zone, unweighted means over its hours and road types."""
    zones = zone_hour.groupBy("zone").agg(
        _mean("avg_vehicle_count", "trafic_moyen_vehicules"),
        _mean("avg_speed", "vitesse_moyenne_kmh"),
        _mean("avg_occupancy_rate", "taux_occupation_moyen"),
        F.sum("total_vehicles").alias("total_vehicules_zone"),
        F.sum("event_count").alias("nombre_mesures"),
        F.max("max_vehicles").alias("pic_trafic"),
        F.min("min_speed").alias("vitesse_minimale"),
        settled(F.stddev_samp("avg_vehicle_count"), 2).alias("variabilite_trafic"),
    )
    speed, occupancy = F.col("vitesse_moyenne_kmh"), F.col("taux_occupation_moyen")
    return zones.withColumns({
        "efficacite_circulation": guarded_ratio(speed, occupancy, 2),
        "niveau_service": rules.service_level(speed),
    })


def road_performance(roads: DataFrame) -> DataFrame:
    speed = F.col("avg_speed")
    return dense_rank_desc(roads, "road_type", "avg_speed").withColumns({
        "performance_score": rules.performance_score(speed),
        "status": rules.road_status(speed),
    })


def congestion_analysis(zones: DataFrame) -> DataFrame:
    rate = F.col("congestion_rate_percent")
    return zones.withColumns({
        "niveau_congestion": rules.congestion_band(rate),
        "priorite_intervention": rules.band_priority(rate),
        "impact_estime_minutes": rules.impact_minutes(rate),
    })


def hourly_analysis(hours: DataFrame) -> DataFrame:
    totals = hours.groupBy("hour").agg(
        _mean("avg_vehicles", "trafic_horaire_moyen"),
        _mean("avg_speed", "vitesse_horaire_moyenne"),
        _mean("avg_occupancy", "occupation_horaire_moyenne"),
        F.sum("event_count").alias("total_mesures_heure"),
    )
    return totals.withColumns({
        "periode_journee": rules.day_period(F.col("hour")),
        "ratio_occupation_vitesse": guarded_ratio(
            F.col("occupation_horaire_moyenne"), F.col("vitesse_horaire_moyenne"), 3
        ),
    })


def _overview(row: DataFrame) -> DataFrame:
    return row.select(
        F.lit(REPORT_TITLE).alias("titre_rapport"),
        *[settled(F.coalesce(F.col(c), F.lit(0.0)), 2).alias(c) for c in ("taux_congestion_moyen", "vitesse_moyenne_globale")],
        F.coalesce("total_vehicules_jour", F.lit(0)).cast("long").alias("total_vehicules_jour"),
        "zones_surveillees",
    )


def executive_overview(zone_hour: DataFrame, roads: DataFrame, zones: DataFrame) -> DataFrame:
    """One row over the three stored KPI tables."""
    rates = zones.agg(
        F.avg("congestion_rate_percent").alias("taux_congestion_moyen"),
        F.count("*").alias("zones_surveillees"),
    )
    return _overview(rates.withColumns({
        "vitesse_moyenne_globale": roads.agg(F.avg("avg_speed")).scalar(),
        "total_vehicules_jour": zone_hour.agg(F.sum("total_vehicles")).scalar(),
    }))


def executive_overview_from_events(events: DataFrame) -> DataFrame:
    """The same row straight from events: one scan, then roads, zones, total."""
    congested = rules.is_congested(F.col("road_type"), F.col("average_speed"), F.col("occupancy_rate"))
    roads = events.groupBy("zone", "road_id", "road_type").agg(
        F.count("*").alias("n"),
        F.count_if(congested).alias("jammed"),
        F.sum("vehicle_count").alias("vehicles"),
        F.avg("average_speed").alias("speed"),
    )
    zones = roads.groupBy("zone").agg(
        percent(F.sum("jammed"), F.sum("n")).alias("rate"),
        F.sum("vehicles").alias("vehicles"),
        F.sum("speed").alias("speed_sum"),
        F.count("speed").alias("roads"),
    )
    return _overview(zones.agg(
        F.avg("rate").alias("taux_congestion_moyen"),
        F.try_divide(F.sum("speed_sum"), F.sum("roads")).alias("vitesse_moyenne_globale"),
        F.sum("vehicles").alias("total_vehicules_jour"),
        F.count("*").alias("zones_surveillees"),
    ))


def critical_zones(traffic: DataFrame, congestion: DataFrame) -> DataFrame:
    """Traffic and congestion of a zone side by side, with its status."""
    joined = traffic.join(congestion, "zone")
    return joined.select(
        "zone",
        "trafic_moyen_vehicules_heure",
        "niveau_trafic",
        "taux_congestion_pourcentage",
        "niveau_congestion",
        "priorite_intervention",
        rules.zone_status(F.col("niveau_trafic"), F.col("niveau_congestion")).alias("statut_zone"),
    )


def main_dashboard(strategic: DataFrame, analysis: DataFrame) -> DataFrame:
    congestion = analysis.select(
        "zone", "congestion_rate_percent", "niveau_congestion", "priorite_intervention", "impact_estime_minutes"
    )
    kept = strategic.select(
        "zone", "trafic_moyen_vehicules", "vitesse_moyenne_kmh", "taux_occupation_moyen", "niveau_service"
    )
    return kept.join(congestion, "zone", "left")
