"""Report tables, in the order they are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadflux.functions import rules
from roadflux.functions.numbers import settled
from roadflux.plans.marts import main_dashboard


def _listed(column: str, labels: list[str]) -> Column:
    """Position of a label in a list; unknown labels come last."""
    return rules.first_match([(F.col(column) == name, i) for i, name in enumerate(labels)], len(labels))


# Order of display.
SERVICE_ORDER = ["A - Excellent", "B - Bon", "C - Moyen", "D - Faible", "E - Critique"]
PERIOD_ORDER = ["Heures de pointe matin", "Pleine journée", "Heures de pointe soir", "Soirée", "Nuit"]


def most_congested(analysis: DataFrame, keep: int = 10) -> DataFrame:
    return analysis.orderBy(F.desc("congestion_rate_percent"), "zone").limit(keep).select(
        "zone", "niveau_congestion", "congestion_rate_percent", "priorite_intervention", "impact_estime_minutes"
    )


def total_impact(worst: DataFrame) -> DataFrame:
    return worst.agg(settled(F.sum("impact_estime_minutes"), 1).alias("impact_total_minutes"))


def network_performance(strategic: DataFrame) -> DataFrame:
    return strategic.groupBy("niveau_service").agg(
        F.count("*").alias("nombre_zones"),
        F.avg("vitesse_moyenne_kmh").alias("vitesse_moyenne"),
        F.avg("trafic_moyen_vehicules").alias("trafic_moyen"),
    ).orderBy(_listed("niveau_service", SERVICE_ORDER))


def period_report(hours: DataFrame) -> DataFrame:
    return hours.groupBy("periode_journee").agg(
        F.avg("trafic_horaire_moyen").alias("trafic_moyen"),
        F.avg("vitesse_horaire_moyenne").alias("vitesse_moyenne"),
        F.avg("occupation_horaire_moyenne").alias("occupation_moyenne"),
    ).orderBy(_listed("periode_journee", PERIOD_ORDER))


def hourly_trend(hours: DataFrame) -> DataFrame:
    return hours.select("hour", "trafic_horaire_moyen", "vitesse_horaire_moyenne").orderBy("hour")


def executive_report(strategic: DataFrame, analysis: DataFrame) -> DataFrame:
    """Four numbers in one row; each table is read once."""
    worst = rules.CONGESTION_BAND[0][1]
    speeds = strategic.agg(
        F.count_distinct("zone").alias("zones"), F.avg("vitesse_moyenne_kmh").alias("vitesse_moyenne")
    )
    rates = analysis.agg(
        F.avg("congestion_rate_percent").alias("congestion_moyenne"),
        F.count_if(F.col("niveau_congestion") == worst).alias("zones_critiques"),
    ).select(F.struct("*"))
    return speeds.withColumn("_r", rates.scalar()).select("zones", "vitesse_moyenne", "_r.*")


def hours_view(hours: DataFrame) -> DataFrame:
    return hours.select(
        "hour", "trafic_horaire_moyen", "vitesse_horaire_moyenne", "occupation_horaire_moyenne", "periode_journee"
    ).orderBy("hour")


def congestion_alerts_view(analysis: DataFrame) -> DataFrame:
    rate = F.col("congestion_rate_percent")
    return analysis.filter(rate > 30).select(
        "zone",
        "congestion_rate_percent",
        "niveau_congestion",
        "priorite_intervention",
        rules.rate_severity(rate).alias("severite"),
    ).orderBy(F.desc("priorite_intervention"), "zone")


def create_views(strategic: DataFrame, analysis: DataFrame, hours: DataFrame) -> list[str]:
    """Temporary views for SQL users, under the names dashboards know. Names are fixed values."""
    views = {
        "dashboard_principal": main_dashboard(strategic, analysis).orderBy("priorite_intervention", "zone"),
        "analyse_par_heure": hours_view(hours),
        "alertes_congestion": congestion_alerts_view(analysis),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)


def ranked_zones(traffic: DataFrame) -> DataFrame:
    """Position of each zone by traffic. One row per zone, hence one small sort."""
    by_traffic = Window.orderBy(F.desc("trafic_moyen_vehicules_heure"), "zone")
    return traffic.select(
        "zone", "niveau_trafic", "trafic_moyen_vehicules_heure", F.row_number().over(by_traffic).alias("rang")
    )


def serving_totals(traffic: DataFrame, critical: DataFrame, congestion: DataFrame, speed: DataFrame) -> DataFrame:
    """Four named totals, one row each."""
    total = lambda frame, name, value: frame.agg(value.cast("double").alias("value")).select(
        F.lit(name).alias("metric"), "value"
    )
    parts = [
        total(traffic, "Trafic Total", settled(F.sum("trafic_moyen_vehicules_heure"), 2)),
        total(critical, "Zones Critiques", F.count_if(F.col("niveau_congestion") != "Faible")),
        total(congestion, "Congestion Moyenne", settled(F.avg("taux_congestion_pourcentage"), 2)),
        total(speed, "Vitesse Moyenne", settled(F.avg("vitesse_moyenne_kmh"), 2)),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def serving_checks(traffic: DataFrame, critical: DataFrame) -> DataFrame:
    """Levels in use, global mean and number of zones above ``Faible``, as one row."""
    levels = critical.agg(
        F.array_join(F.sort_array(F.collect_set("niveau_congestion")), ", ").alias("niveaux"),
        F.count_if(F.col("niveau_congestion") != "Faible").alias("zones_critiques"),
    )
    mean = traffic.agg(F.avg("trafic_moyen_vehicules_heure")).scalar()
    return levels.withColumn("trafic_moyen_global", mean)


def distinct_values(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column).distinct().orderBy(column)
