"""Whole jobs: raw lines to processed zone, processed zone to analytics zone, models.

The first family of KPI tables shares one rollup. Events are read once and
aggregated to road, zone and hour; the four tables are sums over that rollup.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from roadflux import workspace
from roadflux.functions import rules
from roadflux.functions.numbers import percent
from roadflux.functions.timeparts import with_day_parts
from roadflux.operators import anomalies, comparisons, features, kpis, recommendations
from roadflux.plans import marts, models, notifications
from roadflux.schema import RAW_EVENT
from roadflux.sinks import catalog, files, serving
from roadflux.sources import raw, tables
from roadflux.streaming import lifecycle, metrics as live

ROLLUP_KEYS = ["road_id", "road_type", "zone", "hour"]


def road_hours(events: DataFrame) -> DataFrame:
    """Sums, counts and extremes per road, type, zone and hour of day."""
    v, s, o = kpis.VEHICLES, kpis.SPEED, kpis.OCCUPANCY
    congested = rules.is_congested(F.col("road_type"), F.col(s), F.col(o))
    return with_day_parts(events).groupBy(*ROLLUP_KEYS).agg(
        F.count("*").alias("n"),
        F.count_if(congested).alias("congested"),
        F.sum(v).alias("v_sum"), F.count(v).alias("v_n"), F.max(v).alias("v_max"),
        F.sum(s).alias("s_sum"), F.count(s).alias("s_n"), F.max(s).alias("s_max"), F.min(s).alias("s_min"),
        F.sum(o).alias("o_sum"), F.count(o).alias("o_n"),
    )


def _mean(measure: str) -> Column:
    return F.try_divide(F.sum(f"{measure}_sum"), F.sum(f"{measure}_n"))


def processed_tables(rollup: DataFrame) -> dict[str, DataFrame]:
    """The four KPI tables, equal to ``operators.kpis`` over the events themselves."""
    zones = rollup.groupBy("zone").agg(
        F.sum("n").alias("total_events"), F.sum("congested").alias("congested_events"),
        _mean("o").alias("avg_occupancy"), _mean("s").alias("avg_speed"),
    )
    return {
        "traffic_by_zone": rollup.groupBy("zone", "hour", "road_type").agg(
            _mean("v").alias("avg_vehicle_count"), _mean("s").alias("avg_speed"),
            _mean("o").alias("avg_occupancy_rate"), F.sum("v_sum").alias("total_vehicles"),
            F.sum("n").alias("event_count"), F.max("v_max").alias("max_vehicles"), F.min("s_min").alias("min_speed"),
        ),
        "speed_by_road": rollup.groupBy("road_id", "road_type", "zone").agg(
            _mean("s").alias("avg_speed"), _mean("v").alias("avg_vehicles"), _mean("o").alias("avg_occupancy"),
            F.sum("n").alias("measurement_count"), F.max("s_max").alias("max_speed"), F.min("s_min").alias("min_speed"),
        ),
        "congestion_by_zone": zones.withColumn(
            "congestion_rate_percent", percent(F.col("congested_events"), F.col("total_events"))
        ),
        "hourly_analysis": rollup.groupBy("hour", "zone").agg(
            _mean("v").alias("avg_vehicles"), _mean("s").alias("avg_speed"), _mean("o").alias("avg_occupancy"),
            F.sum("n").alias("event_count"),
        ),
    }


def build_processed(events: DataFrame, base: str) -> dict[str, str]:
    with workspace.scratch(events.sparkSession):
        rollup = workspace.written(road_hours(events), "road-hours")
        return files.write_zone(processed_tables(rollup), base, files.PROCESSED_LAYOUT)


def ingest(spark: SparkSession, raw_path: str, base: str) -> dict[str, str]:
    """Raw text to the processed zone, with what did not get there.

    ``rejects`` has the lines that are no events, by reason; ``ingest_counts`` one row with the lines left after each stage. The counts
    are observed in the pass that builds the zone (a stage that runs again after a lost executor may count twice there);
    lines are read a second time for the rejects only if there are any.
    """
    lines, seen = raw.text_lines(spark, raw_path), Observation()
    watched = raw.audited_events(lines).observe(seen, *raw.stage_aggregates())
    paths = build_processed(watched.filter(F.col("reject_reason").isNull()).select(*RAW_EVENT.names), base)
    # Without any line the plan collapses, and nothing is observed.
    counts = raw.stage_counts(lines).first().asDict() if lines.isEmpty() else seen.get
    rejected = raw.rejected_lines(lines)
    if counts["accepted"] == counts["raw_lines"]:
        rejected = spark.createDataFrame([], rejected.schema)
    stages = spark.createDataFrame([counts], ", ".join(f"{name} long" for name in counts))
    return {**paths, **files.write_zone({"rejects": rejected, "ingest_counts": stages.coalesce(1)}, base, {"rejects": ["reject_reason"]})}


def build_analytics(spark: SparkSession, processed: str, base: str) -> dict[str, str]:
    """Processed zone to the five analytics tables."""
    stored = {name: frame.drop("processed_at") for name, frame in tables.processed_zone(spark, processed).items()}
    zone_hour, roads = stored["traffic_by_zone"], stored["speed_by_road"]
    zones, hours = stored["congestion_by_zone"], stored["hourly_analysis"]
    views = {
        "kpi_zone_strategique": marts.strategic_zones(zone_hour),
        "performance_routes": marts.road_performance(roads),
        "analyse_congestion": marts.congestion_analysis(zones),
        "analyse_temporelle": marts.hourly_analysis(hours),
        "tableau_bord_executif": marts.executive_overview(zone_hour, roads, zones),
    }
    return files.write_zone(views, base, files.ANALYTICS_LAYOUT)


def publish_catalog(spark: SparkSession, paths: dict[str, str]) -> list[str]:
    return catalog.register_all(spark, paths)


def second_family(events: DataFrame) -> dict[str, DataFrame]:
    """The five tables of the second KPI family, from one pass over the events."""
    profile = workspace.written(kpis.zone_and_hour_profile(tables.as_kpi_input(events)), "second-family")
    out = kpis.zone_tables(profile.filter("by_zone"))
    out["evolution_trafic"] = kpis.evolution_of(profile)
    out["zones_critiques"] = marts.critical_zones(out["trafic_par_zone"], out["taux_congestion"])
    return out


def write_second_family(events: DataFrame, base: str) -> dict[str, str]:
    """The second KPI family as stored tables."""
    with workspace.scratch(events.sparkSession):
        return files.write_zone(second_family(events), base, {})


def write_trends(events: DataFrame, base: str) -> dict[str, str]:
    """The trend tables as stored ones; the peaks come from the stored profile, not from the events again."""
    paths = files.write_zone({"weekly_profile": kpis.weekly_profile(events), "road_type_profile": kpis.road_type_profile(events)}, base, {})
    profile = events.sparkSession.read.parquet(paths["weekly_profile"]).drop("processed_at")
    return {**paths, **files.write_zone({"peak_periods": kpis.peak_periods(profile)}, base, {})}


def export_serving(tables_: Mapping[str, DataFrame], base: str) -> dict[str, str]:
    """Tables in the columns and types of the serving tables of the same name, as Parquet that a database can load."""
    return files.write_zone({name: serving.for_serving(rows, name) for name, rows in tables_.items()}, base, {}, stamp=False)


def predict(events: DataFrame, base: str) -> dict[str, str]:
    """Train both models, score anomalies, recommend, and write the four results.

    The readings are stored once, without columns nobody needs, and so is the feature table; training reads it several
    times. What is stored on the way goes when the job ends.
    """
    with workspace.scratch(events.sparkSession):
        readings = workspace.written(events.select(*READING), "readings")
        table = workspace.written(features.feature_table(readings), "features")
        traffic, congestion = models.train_traffic(table), models.train_congestion(table)
        scored = workspace.written(anomalies.score(table, anomalies.fit(table)), "anomaly-scores")
        return files.write_predictions({
            "traffic_predictions": traffic.predictions,
            "congestion_predictions": congestion.predictions,
            "anomalies_detected": anomalies.flag(scored),
            "route_recommendations": recommendations.recommend(workspace.written(kpis.road_totals(readings), "road-totals")),
        }, base)


READING = ["sensor_id", "road_id", "road_type", "zone", "vehicle_count", "average_speed", "occupancy_rate", "event_time"]


def live_alerts(
    messages: DataFrame, store: str, checkpoint: str, window: str = live.WINDOW, trigger: str | None = live.TRIGGER,
    channels: Mapping[str, bool] = notifications.CHANNELS, compact_every: int = 240,
) -> StreamingQuery:
    """Messages to alerts: events, window metrics, alert changes, the alert store and the outbox.

    ``store/changes`` and ``store/snapshots`` hold the alerts (``lifecycle.current_alerts``), ``store/outbox`` what is to be
    sent. Every ``compact_every`` batches the changes so far are folded into a snapshot and removed. Restarted with its
    checkpoint the job goes on where it stopped; with a new one it adds to the store. ``end_alerts`` closes the last windows of a
    stream that has ended.
    """
    spark = messages.sparkSession
    run = lifecycle.run_number(spark, store, checkpoint)
    keep = lifecycle.keep_changes(store, run)

    def each(changes: DataFrame, batch_id: int) -> None:
        session = changes.sparkSession
        keep(changes, batch_id)
        number = lifecycle.batch_number(run, batch_id)
        told = lifecycle.told(session.read.parquet(f"{store}/changes/batch={number}"))
        sent = notifications.outbox(told, channels, F.col("is_escalation"))
        sent.write.mode("overwrite").parquet(f"{store}/outbox/batch={number}")
        if batch_id % compact_every == compact_every - 1:
            lifecycle.compact(session, store)

    events = live.with_ends(raw.stream_events(messages), f"{store}/ends")
    changes = lifecycle.alert_changes(live.live_metrics(events, window))
    return live.run(changes, each, checkpoint, trigger=trigger)


def end_alerts(spark: SparkSession, store: str, moment: dt.datetime) -> None:
    """Let the alert job of a store close the windows before ``moment``: the running one, or the next run with its checkpoint."""
    live.end_at(spark, f"{store}/ends", moment)


def live_rejects(messages: DataFrame, path: str, checkpoint: str, trigger: str | None = live.TRIGGER) -> StreamingQuery:
    """Messages that are no events, with the reason; a query of its own beside ``live_alerts``."""
    return live.run(raw.stream_rejects(messages), live.live_display(path), checkpoint, trigger=trigger)


def compare(events: DataFrame, baseline: str, as_of: Column | None = None) -> DataFrame:
    """All comparisons, zones against one baseline zone; events are read once.

    ``as_of`` is the moment the rows are stamped with, by default now.
    """
    base = workspace.written(comparisons.comparison_base(events), "comparison-base")
    return comparisons.all_comparisons(base, comparisons.baseline_pairs(base, baseline), as_of)
