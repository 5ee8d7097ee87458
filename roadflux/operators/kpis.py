"""Aggregates over sensor events.

Results are unordered; ``plans.reports`` sorts what people look at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadflux.functions import rules
from roadflux.functions.numbers import percent, settled
from roadflux.functions.timeparts import with_day_parts

VEHICLES, SPEED, OCCUPANCY = "vehicle_count", "average_speed", "occupancy_rate"


def _slow(column: str) -> Column:
    """Number of readings below the slow-speed limit."""
    return F.count(F.when(F.col(column) < rules.SLOW_SPEED, 1))


# --- first family -----------------------------------------------------------

def zone_hour_traffic(events: DataFrame) -> DataFrame:
    return with_day_parts(events).groupBy("zone", "hour", "road_type").agg(
        F.avg(VEHICLES).alias("avg_vehicle_count"),
        F.avg(SPEED).alias("avg_speed"),
        F.avg(OCCUPANCY).alias("avg_occupancy_rate"),
        F.sum(VEHICLES).alias("total_vehicles"),
        F.count("*").alias("event_count"),
        F.max(VEHICLES).alias("max_vehicles"),
        F.min(SPEED).alias("min_speed"),
    )


def road_speed(events: DataFrame) -> DataFrame:
    return events.groupBy("road_id", "road_type", "zone").agg(
        F.avg(SPEED).alias("avg_speed"),
        F.avg(VEHICLES).alias("avg_vehicles"),
        F.avg(OCCUPANCY).alias("avg_occupancy"),
        F.count("*").alias("measurement_count"),
        F.max(SPEED).alias("max_speed"),
        F.min(SPEED).alias("min_speed"),
    )


def zone_congestion(events: DataFrame) -> DataFrame:
    congested = rules.is_congested(F.col("road_type"), F.col(SPEED), F.col(OCCUPANCY))
    totals = events.groupBy("zone").agg(
        F.count("*").alias("total_events"),
        F.count_if(congested).alias("congested_events"),
        F.avg(OCCUPANCY).alias("avg_occupancy"),
        F.avg(SPEED).alias("avg_speed"),
    )
    rate = percent(F.col("congested_events"), F.col("total_events"))
    return totals.withColumn("congestion_rate_percent", rate)


def hourly_zone(events: DataFrame) -> DataFrame:
    return with_day_parts(events).groupBy("hour", "zone").agg(
        F.avg(VEHICLES).alias("avg_vehicles"),
        F.avg(SPEED).alias("avg_speed"),
        F.avg(OCCUPANCY).alias("avg_occupancy"),
        F.count("*").alias("event_count"),
    )


# The French column names below are those of the published tables.
# --- second family (input of sources.tables.as_kpi_input) --------------------

# All three tables have one row per zone, so their measures can also be taken in
# one pass: ``zone_tables(zone_profile(readings))``.

def _traffic_measures() -> list[Column]:
    return [
        F.count("*").alias("nombre_mesures"),
        F.avg(VEHICLES).alias("trafic_moyen_vehicules_heure"),
        F.sum(VEHICLES).alias("trafic_total"),
        F.max(VEHICLES).alias("pic_trafic"),
        F.stddev_samp(VEHICLES).alias("variabilite_trafic"),
    ]


def _speed_measures() -> list[Column]:
    return [
        F.avg("speed").alias("vitesse_moyenne_kmh"),
        F.min("speed").alias("vitesse_minimale"),
        F.max("speed").alias("vitesse_maximale"),
        F.stddev_samp("speed").alias("ecart_type_vitesse"),
    ]


def _congestion_measures() -> list[Column]:
    return [
        F.count("*").alias("total_mesures"),
        _slow("speed").alias("mesures_congestionnees"),
        F.avg("occupancy").alias("taux_occupation_moyen"),
        F.avg("speed").alias("vitesse_moyenne"),
    ]


def _with_traffic_level(zones: DataFrame) -> DataFrame:
    return zones.withColumn("niveau_trafic", rules.traffic_level(F.col("trafic_moyen_vehicules_heure")))


def _with_fluidity(zones: DataFrame) -> DataFrame:
    return zones.withColumn("niveau_fluidite", rules.fluidity(F.col("vitesse_moyenne_kmh")))


def _with_congestion_level(zones: DataFrame) -> DataFrame:
    rate = F.col("taux_congestion_pourcentage")
    return zones.withColumn(
        "taux_congestion_pourcentage",
        percent(F.col("mesures_congestionnees"), F.col("total_mesures")),
    ).withColumns({
        "niveau_congestion": rules.congestion_level(rate),
        "priorite_intervention": rules.level_priority(rate),
    })


def zone_traffic(readings: DataFrame) -> DataFrame:
    return _with_traffic_level(readings.groupBy("zone").agg(*_traffic_measures()))


def zone_speed(readings: DataFrame) -> DataFrame:
    return _with_fluidity(readings.groupBy("zone").agg(*_speed_measures()))


def zone_congestion_levels(readings: DataFrame) -> DataFrame:
    return _with_congestion_level(readings.groupBy("zone").agg(*_congestion_measures()))


def zone_profile(readings: DataFrame) -> DataFrame:
    return readings.groupBy("zone").agg(*_traffic_measures(), *_speed_measures(), *_congestion_measures())


def zone_tables(profile: DataFrame) -> dict[str, DataFrame]:
    return {
        "trafic_par_zone": _with_traffic_level(profile.select(
            "zone", "nombre_mesures", "trafic_moyen_vehicules_heure", "trafic_total", "pic_trafic",
            "variabilite_trafic",
        )),
        "vitesse_moyenne": _with_fluidity(profile.select(
            "zone", "vitesse_moyenne_kmh", "vitesse_minimale", "vitesse_maximale", "ecart_type_vitesse"
        )),
        "taux_congestion": _with_congestion_level(profile.select(
            "zone", "total_mesures", "mesures_congestionnees", "taux_occupation_moyen", "vitesse_moyenne"
        )),
    }


def zone_and_hour_profile(readings: DataFrame) -> DataFrame:
    """All measures per zone and per hour and weekday in one pass; ``by_zone`` tells the two kinds of row apart."""
    timed = readings.withColumns({"heure": F.hour("timestamp"), "jour_semaine": F.date_format("timestamp", "EEEE")})
    both = timed.groupingSets([[F.col("zone")], [F.col("heure"), F.col("jour_semaine")]], "zone", "heure", "jour_semaine")
    return both.agg(
        (F.grouping("zone") == 0).alias("by_zone"), *_traffic_measures(), *_speed_measures(), *_congestion_measures())


def evolution_of(profile: DataFrame) -> DataFrame:
    """``temporal_evolution`` from the hour rows of ``zone_and_hour_profile``."""
    totals = profile.filter(~F.col("by_zone")).select(
        "heure", "jour_semaine",
        F.col("trafic_moyen_vehicules_heure").alias("trafic_horaire_moyen"),
        F.col("vitesse_moyenne_kmh").alias("vitesse_horaire_moyenne"),
        F.col("taux_occupation_moyen").alias("occupation_horaire_moyenne"),
        "nombre_mesures",
    )
    return totals.withColumn("periode_journee", rules.rush_period(F.col("heure")))


def temporal_evolution(readings: DataFrame) -> DataFrame:
    totals = readings.groupBy(
        F.hour("timestamp").alias("heure"), F.date_format("timestamp", "EEEE").alias("jour_semaine")
    ).agg(
        F.avg(VEHICLES).alias("trafic_horaire_moyen"),
        F.avg("speed").alias("vitesse_horaire_moyenne"),
        F.avg("occupancy").alias("occupation_horaire_moyenne"),
        F.count("*").alias("nombre_mesures"),
    )
    return totals.withColumn("periode_journee", rules.rush_period(F.col("heure")))


# --- trends and roads -------------------------------------------------------

def weekly_profile(events: DataFrame) -> DataFrame:
    """Hour by weekday; Sunday is day 1."""
    return events.groupBy(
        F.hour("event_time").alias("hour"), F.dayofweek("event_time").alias("day_of_week")
    ).agg(
        F.avg(VEHICLES).alias("avg_traffic"),
        F.avg(SPEED).alias("avg_speed"),
        F.avg(OCCUPANCY).alias("avg_occupancy"),
        F.count("*").alias("sample_count"),
    )


def road_type_profile(events: DataFrame) -> DataFrame:
    return events.groupBy("road_type", F.hour("event_time").alias("hour")).agg(
        F.avg(VEHICLES).alias("avg_traffic"),
        F.avg(SPEED).alias("avg_speed"),
        F.stddev_samp(VEHICLES).alias("traffic_variability"),
    )


def peak_periods(profile: DataFrame, factor: float = 1.5) -> DataFrame:
    """Weekly-profile rows well above the mean of the profile.

    A profile has at most 24 x 7 rows, so one window over all of it is cheaper
    than computing the profile a second time for its mean.
    """
    usual = F.avg("avg_traffic").over(Window.partitionBy(F.lit(0)))
    marked = profile.withColumn("_usual", usual)
    return marked.filter(F.col("avg_traffic") > F.col("_usual") * factor).drop("_usual")


def road_totals(events: DataFrame) -> DataFrame:
    """Counts and sums per road, type and zone; the base of everything about roads."""
    return events.groupBy("road_id", "road_type", "zone").agg(
        F.count("*").alias("total_measurements"),
        _slow(SPEED).alias("congestion_events"),
        F.sum(SPEED).alias("speed_sum"),
        F.count(SPEED).alias("speed_n"),
        F.sum(OCCUPANCY).alias("occupancy_sum"),
        F.count(OCCUPANCY).alias("occupancy_n"),
    )


def route_congestion(totals: DataFrame) -> DataFrame:
    """Means and rate of slow readings, over ``road_totals``."""
    return totals.select(
        "road_id",
        "road_type",
        "zone",
        F.try_divide("speed_sum", "speed_n").alias("avg_speed"),
        F.try_divide("occupancy_sum", "occupancy_n").alias("avg_occupancy"),
        "total_measurements",
        "congestion_events",
        F.try_divide("congestion_events", "total_measurements").alias("congestion_rate"),
    )


def congested_routes(routes: DataFrame, above: float = 0.2) -> DataFrame:
    return routes.filter(F.col("congestion_rate") > above)


def slow_roads(totals: DataFrame, below: float = 40, keep: int = 5) -> DataFrame:
    """The slowest roads, over ``road_totals``; road_id settles equal speeds."""
    mean = F.try_divide(F.sum("speed_sum"), F.sum("speed_n"))
    means = totals.groupBy("road_id").agg(mean.alias("avg_speed"))
    return means.filter(F.col("avg_speed") < below).orderBy("avg_speed", "road_id").limit(keep)


# --- summaries in which a missing measure counts as zero ---------------------

def lenient_zone_summary(events: DataFrame) -> DataFrame:
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    return events.groupBy(F.coalesce("zone", F.lit("Unknown")).alias("zone")).agg(
        F.count("*").alias("event_count"),
        F.round(F.avg(zero(SPEED)), 2).alias("avg_speed"),
        F.round(F.avg(zero(VEHICLES)), 2).alias("avg_vehicles"),
    )


def global_summary(zones: DataFrame) -> DataFrame:
    """One row over ``lenient_zone_summary``; the list holds one entry per zone."""
    return zones.agg(
        F.count("*").alias("total_zones"),
        settled(F.avg("avg_speed"), 2).alias("vitesse_globale_moyenne"),
        settled(F.avg("avg_vehicles"), 2).alias("trafic_total_moyen"),
        F.sort_array(F.collect_list("zone")).alias("zones_analysees"),
    )


# --- serving snapshots and long-form metrics ---------------------------------

# Period name, truncation unit.
PERIODS = {"hourly": "hour", "daily": "day", "weekly": "week"}


def zone_snapshots(events: DataFrame, unit: str = "hour") -> DataFrame:
    """Per-zone means per calendar unit, stamped with the start of the unit."""
    return events.groupBy("zone", F.date_trunc(unit, "event_time").cast("timestamp_ntz").alias("processed_at")).agg(
        F.avg(VEHICLES).alias("trafic_moyen_vehicules_heure"),
        F.avg(SPEED).alias("vitesse_moyenne_kmh"),
    )


def metric_rows(events: DataFrame) -> DataFrame:
    """Metrics of every zone in long form for hours, days and weeks.

    Hours are aggregated from events once; days and weeks are rolled up from
    the hourly sums, which are small.
    """
    congested = rules.is_congested(F.col("road_type"), F.col(SPEED), F.col(OCCUPANCY))
    hours = events.groupBy("zone", F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("timestamp")).agg(
        F.sum(VEHICLES).alias("vehicles"),
        F.count(VEHICLES).alias("counted"),
        F.sum(SPEED).alias("speed_sum"),
        F.count(SPEED).alias("speed_n"),
        F.count("*").alias("events"),
        F.count_if(congested).alias("congested"),
    )
    parts = ["vehicles", "counted", "speed_sum", "speed_n", "events", "congested"]
    stamps = F.array(*[
        F.struct(F.lit(name).alias("period"), F.date_trunc(unit, "timestamp").cast("timestamp_ntz").alias("at"))
        for name, unit in PERIODS.items()
    ])
    rolled = (
        hours.select("zone", F.explode(stamps).alias("_s"), *parts)
        .groupBy("zone", F.col("_s.period").alias("period"), F.col("_s.at").alias("timestamp"))
        .agg(*[F.sum(p).alias(p) for p in parts])
    )
    metric = lambda name, unit, value: F.struct(
        F.lit(name).alias("metric_name"), value.cast("double").alias("metric_value"), F.lit(unit).alias("metric_unit")
    )
    metrics = F.array(
        metric("traffic_volume", "vehicles/hour", F.try_divide(F.col("vehicles"), F.col("counted"))),
        metric("average_speed", "km/h", F.try_divide(F.col("speed_sum"), F.col("speed_n"))),
        metric("congestion_rate", "%", percent(F.col("congested"), F.col("events"))),
    )
    return rolled.select("zone", "timestamp", "period", F.inline(metrics))


def flow_by_direction(flow: DataFrame, since: Column) -> DataFrame:
    """Volume and mean speed per direction from a moment on."""
    return flow.filter(F.col("timestamp") >= since).groupBy("direction").agg(
        F.sum("flow_volume").alias("flow_volume"), F.avg("average_speed").alias("avg_speed")
    )
