"""Registry: one callable per operator, over the supplied tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadflux import workspace
from roadflux.functions import rules, text, timeparts
from roadflux.operators import (
    alerts as alert_ops, anomalies, comparisons, features, kpis, quality, recommendations, upsert,
)
from roadflux.plans import increments, jobs, marts, models, notifications, panels, reports
from roadflux.sinks import catalog, files, messages, serving, versions
from roadflux.sources import raw, tables
from roadflux.streaming import landing, lifecycle, metrics as live
from verification import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def add(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return add


def simple(name: str, source, *steps, digits: dict[str, int] | int | None = None) -> None:
    """Register ``steps`` applied in turn to ``source(spark, sf_dir)``.

    ``digits`` rounds double columns whose last bits depend on summation order.
    """
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = source(spark, sf_dir)
        for step in steps:
            frame = step(frame)
        return rounded(frame, digits)

    QUERIES[name] = run


def rounded(frame: DataFrame, digits) -> DataFrame:
    if digits is None:
        return frame
    if isinstance(digits, int):
        digits = {c: digits for c, t in frame.dtypes if t == "double"}
    return frame.withColumns({c: F.round(c, n) for c, n in digits.items()})


# --- building blocks ------------------------------------------------------------

def zone_hour(s, d):
    return kpis.zone_hour_traffic(fx.traffic(s, d))


def roads(s, d):
    return kpis.road_speed(fx.traffic(s, d))


def zones(s, d):
    return kpis.zone_congestion(fx.traffic(s, d))


def hours(s, d):
    return kpis.hourly_zone(fx.traffic(s, d))


def strategic(s, d):
    return marts.strategic_zones(zone_hour(s, d))


def analysis(s, d):
    return marts.congestion_analysis(zones(s, d))


def hourly(s, d):
    return marts.hourly_analysis(hours(s, d))


def traffic2(s, d):
    return kpis.zone_traffic(fx.kpi_input(s, d))


def speed2(s, d):
    return kpis.zone_speed(fx.kpi_input(s, d))


def congestion2(s, d):
    return kpis.zone_congestion_levels(fx.kpi_input(s, d))


def family(s, d):
    """Second KPI family with one pass over events for all its zone tables."""
    return jobs.second_family(fx.traffic(s, d))


def critical(s, d):
    return family(s, d)["zones_critiques"]


def canonical_traffic(s, d):
    readings = fx.kpi_input(s, d).withColumn("zone", text.canonical_zone(F.col("zone")))
    return kpis.zone_traffic(readings)


def metrics(s, d):
    return kpis.metric_rows(fx.traffic(s, d))


BASELINE = "Centre-Ville"


def comparison_base(s, d):
    return workspace.written(comparisons.comparison_base(fx.traffic(s, d)), "comparison-base")


# --- ingest -----------------------------------------------------------------------

@query("i1_raw_text_read")
def _(s, d):
    path = workspace.fresh_path(s, "raw-text")
    fx.raw_lines(s, d).select("value").write.text(path)
    return raw.text_lines(s, path).agg(
        F.count("*").alias("lines"), F.sum(F.length("value")).alias("characters")
    )


simple("i2_non_blank_lines", fx.raw_lines, raw.non_blank)


@query("i3_repaired_json")
def _(s, d):
    return raw.non_blank(fx.raw_lines(s, d)).select("event_id", raw.repaired_json(F.col("value")).alias("json_str"))


@query("i4_regex_repaired_json")
def _(s, d):
    # The patterns take any word before a colon for a key, so a line with a clock time is beyond them.
    return fx.raw_lines(s, d).select("event_id", raw.regex_repaired_json(F.col("value")).alias("json_str"))


simple("i5_parsed_events", fx.raw_lines, raw.audited_events,
       lambda f: f.filter(F.col("reject_reason").isNull()).drop("value", "reject_reason", "event_type"))


@query("i6_strict_json_read")
def _(s, d):
    path = workspace.fresh_path(s, "strict-json")
    fx.raw_lines(s, d).select("value", "event_type").write.partitionBy("event_type").text(path)
    return raw.strict_json(s, path)


simple("i7_decodable_lines", fx.raw_lines, raw.decodable, lambda f: f.select("event_id", "value"))


@query("i8_event_time_formats")
def _(s, d):
    lines = fx.raw_lines(s, d)
    stamp = F.regexp_extract("value", r'"?event_time"?: ?"?([^"}]*)', 1)
    return lines.select("event_id", timeparts.parse_event_time(stamp).alias("event_time"))


@query("i9_second_precision")
def _(s, d):
    lines = fx.raw_lines(s, d)
    stamp = F.regexp_extract("value", r'"?event_time"?: ?"?([^"}]*)', 1)
    seconds = raw.to_second(lines.select("event_id", stamp.alias("event_time")))
    return seconds.withColumn("quarantined", F.col("event_second").isNull()).drop("event_time")


simple("i10_rejected_lines", fx.raw_lines, raw.rejected_lines)
simple("i11_day_parts", fx.traffic, timeparts.with_day_parts, lambda f: f.select("event_id", "hour", "date_str"))
simple("i12_calendar", fx.traffic, timeparts.with_calendar,
       lambda f: f.select("event_id", "hour", "day_of_week", "month", "year", "date"))
simple("i13_null_counts", fx.traffic, quality.null_counts)
simple("i14_load_profile", fx.traffic, quality.load_profile)
simple("i15_reject_counts", fx.raw_lines, raw.audited_events, quality.reject_counts)
simple("i15_stage_counts", fx.raw_lines, raw.stage_counts)
simple("i16_period_covered", fx.traffic, quality.period_covered)
simple("i17_volume_gates", fx.traffic, quality.volume_gates)


def _ingested(s, d) -> dict[str, str]:
    lines = workspace.fresh_path(s, "lines")
    fx.raw_lines(s, d).select("value").write.text(lines)
    return jobs.ingest(s, lines, workspace.fresh_path(s, "processed"))


@query("i10_ingest_rejects")
def _(s, d):
    return s.read.parquet(_ingested(s, d)["rejects"]).drop("processed_at")


@query("i15_ingest_counts")
def _(s, d):
    return s.read.parquet(_ingested(s, d)["ingest_counts"]).drop("processed_at")


def _write_processed(s, d) -> str:
    base = workspace.fresh_path(s, "processed")
    jobs.build_processed(fx.traffic(s, d), base)
    return base


def _write_analytics(s, d) -> dict[str, str]:
    return jobs.build_analytics(s, _write_processed(s, d), workspace.fresh_path(s, "analytics"))


@query("i18_processed_zone_read")
def _(s, d):
    return quality.dataset_summary(tables.processed_zone(s, _write_processed(s, d)))


@query("i20_catalog_read")
def _(s, d):
    name = "read_speed_by_road"
    catalog.register(s, name, f"{_write_processed(s, d)}/speed_by_road")
    return tables.catalog_table(s, name).drop("processed_at")


@query("i21_coordinate_merge")
def _(s, d):
    # Each zone of the data reports a position derived from its readings.
    seen = fx.traffic(s, d).groupBy(text.canonical_zone(F.col("zone")).alias("zone")).agg(F.count("*").alias("n"))
    moved = seen.select(
        "zone",
        (F.lit(30) + F.col("n") / 1000000).cast("decimal(10,8)").alias("latitude"),
        (F.lit(-7) - F.col("n") / 1000000).cast("decimal(11,8)").alias("longitude"),
        F.concat(F.lit("Capteurs "), "zone").alias("zone_name"),
        F.lit("Observed").alias("zone_type"),
    )
    return tables.merge_coordinates(tables.zone_coordinates(s), moved)


simple("i22_kpi_input", fx.kpi_input, digits={"occupancy": 12})

# --- sinks ------------------------------------------------------------------------


@query("k1_partitioned_write")
def _(s, d):
    path = workspace.fresh_path(s, "zone-hour")
    files.write_table(zone_hour(s, d), path, ["zone", "hour"])
    return s.read.parquet(path).drop("processed_at")


@query("k1_write_check")
def _(s, d):
    path = workspace.fresh_path(s, "zone-hour")
    files.write_table(zone_hour(s, d), path, ["zone", "hour"])
    return files.read_back(s, path, ["zone", "hour"])


@query("k2_analytics_zone")
def _(s, d):
    paths = _write_analytics(s, d)
    return quality.dataset_summary({name: s.read.parquet(path) for name, path in paths.items()})


# What the five analytics tables hold, read back.
for _name in files.ANALYTICS_LAYOUT:
    query(f"k2_stored_{_name}")(lambda s, d, n=_name: s.read.parquet(_write_analytics(s, d)[n]).drop("processed_at"))


def _daily(s, d, unit="day"):
    """Zone traffic per day: several versions of each zone's row, told apart by ``observed``."""
    day = F.date_trunc(unit, "event_time").cast("timestamp_ntz").alias("observed")
    return fx.traffic(s, d).groupBy("zone", day).agg(
        F.avg("vehicle_count").alias("trafic"), F.count("*").alias("mesures")
    )


def _first_version(daily):
    return upsert.latest_rows(daily.withColumn("_o", -timeparts.epoch_seconds(F.col("observed"))), ["zone"], "_o").drop("_o")


@query("k3_replace_rows")
def _(s, d):
    daily = _daily(s, d)
    return upsert.merge_rows(_first_version(daily), daily, ["zone"], order="observed")


@query("k3_update_columns")
def _(s, d):
    daily = _daily(s, d)
    return upsert.merge_rows(_first_version(daily), daily, ["zone"], update=["trafic"], order="observed")


@query("k3_versions")
def _(s, d):
    """A versioned table after two merges, each version as it can still be read."""
    daily, path = _daily(s, d), workspace.fresh_path(s, "versioned")
    versions.create(_first_version(daily), path, ["zone"], buckets=8)
    versions.merge(path, daily, update=["trafic"], order="observed")
    versions.merge(path, daily, order="observed")
    whole = None
    for v in versions.versions(s, path):
        rows = versions.read(s, path, v).withColumn("version", F.lit(v))
        whole = rows if whole is None else whole.unionByName(rows)
    return whole


@query("k3_touched_files")
def _(s, d):
    """The newest hour merged into a table of all hours: the outcome, and that all buckets it has no key in kept their folders."""
    hours, path = workspace.written(_daily(s, d, "hour"), "hours"), workspace.fresh_path(s, "versioned")
    newest = hours.filter(F.col("observed") == hours.agg(F.max("observed")).scalar()).withColumn("mesures", F.lit(0).cast("long"))
    versions.create(hours, path, ["zone", "observed"])
    before = versions.manifest(s, path)["folders"]
    versions.merge(path, newest)
    after = versions.manifest(s, path)["folders"]
    rewritten = sum(folder != before.get(bucket) for bucket, folder in after.items())
    return versions.read(s, path).agg(
        F.count("*").alias("rows"), F.count_if(F.col("mesures") == 0).alias("merged"), F.sum("mesures").alias("mesures"),
    ).select("*", (F.lit(0 < rewritten) & (F.lit(rewritten) <= F.col("merged"))).alias("rewrote_only_touched"))


SERVED = {
    "trafic_par_zone": traffic2, "vitesse_moyenne": speed2, "taux_congestion": congestion2,
    "zones_critiques": critical,
}
def _narrowed(table: str):
    # Means of hundredths are not exact; twelve digits put both engines on the same side of a half.
    return lambda f: serving.for_serving(rounded(f, 12), table)


for _table, _source in SERVED.items():
    simple(f"k5_serving_{_table}", _source, _narrowed(_table))
simple("k5_serving_evolution_trafic", fx.kpi_input, kpis.temporal_evolution, _narrowed("evolution_trafic"))
simple("k5_serving_traffic_alerts", fx.alerts, _narrowed("traffic_alerts"))
simple("k5_serving_kpi_metrics", metrics, _narrowed("kpi_metrics"))
simple("k5_serving_traffic_flow", fx.flow, _narrowed("traffic_flow"))
simple("k5_serving_traffic_predictions", fx.predictions, _narrowed("traffic_predictions"))


def _exported(s, d) -> dict[str, str]:
    made = {name: rounded(rows, 12) for name, rows in family(s, d).items()}
    return jobs.export_serving(made, workspace.fresh_path(s, "serving"))


for _table in [*SERVED, "evolution_trafic"]:
    query(f"k5_export_{_table}")(lambda s, d, n=_table: s.read.parquet(_exported(s, d)[n]))


@query("k5_serving_zone_coordinates")
def _(s, d):
    return serving.for_serving(tables.zone_coordinates(s).join(
        canonical_traffic(s, d).select("zone"), "zone", "left_semi"), "zone_coordinates")


@query("k5_serving_comparative_analytics")
def _(s, d):
    return _narrowed("comparative_analytics")(jobs.compare(fx.traffic(s, d), BASELINE, fx.as_of(fx.traffic(s, d))))


@query("k6_catalog_tables")
def _(s, d):
    paths = {f"zone_{name}": path for name, path in _write_analytics(s, d).items()}
    names = catalog.register_all(s, paths)
    return quality.row_counts({name: s.table(name) for name in names})


simple("k7_keyed_messages", fx.traffic, messages.keyed)

# --- text repair ------------------------------------------------------------------


def _repaired(name: str, column: str, repair) -> None:
    simple(name, fx.dirty, lambda f: f.groupBy(F.col(column).alias("before"), repair(F.col(column)).alias("after"))
           .agg(F.count("*").alias("n")))


_repaired("n1_path_safe_zone", "zone", text.path_safe)
_repaired("n2_restored_accents", "zone", text.restore_accents)
_repaired("n3_zone_by_pattern", "zone", text.repair_zone_by_pattern)
_repaired("n4_zone_by_map", "zone", text.repair_zone_exactly)
_repaired("n5_canonical_zone", "zone", text.canonical_zone)
_repaired("n6_congestion_label", "label", text.repair_congestion_label)
_repaired("n7_traffic_label", "label", text.repair_traffic_label)

# --- rules per reading --------------------------------------------------------------


@query("r_event_rules")
def _(s, d):
    v, sp, oc = F.col("vehicle_count"), F.col("average_speed"), F.col("occupancy_rate")
    kind = rules.alert_type(v, sp, oc)
    return fx.traffic(s, d).select(
        "event_id",
        rules.is_congested(F.col("road_type"), sp, oc).alias("is_congested"),
        rules.event_service_letter(sp).alias("service_letter"),
        kind.alias("alert_type"),
        rules.alert_severity(kind).alias("severity"),
        rules.escalation_seconds(kind).alias("escalation_seconds"),
        rules.service_level(sp).alias("service_level"),
        rules.performance_score(sp).alias("performance_score"),
        rules.road_status(sp).alias("road_status"),
        rules.fluidity(sp).alias("fluidity"),
        rules.traffic_level(v).alias("traffic_level"),
        rules.density(v).alias("density"),
        rules.marker_density(v).alias("marker_density"),
    )


@query("r_rate_rules")
def _(s, d):
    # Occupancy serves as a rate here: it spans the whole range of percentages.
    rate, hour = F.col("occupancy_rate"), F.hour("event_time")
    return fx.traffic(s, d).select(
        "event_id",
        rules.congestion_band(rate).alias("band"),
        rules.band_priority(rate).alias("band_priority"),
        rules.impact_minutes(rate).alias("impact_minutes"),
        rules.congestion_level(rate).alias("level"),
        rules.level_priority(rate).alias("level_priority"),
        rules.rate_severity(rate).alias("severity"),
        rules.congestion_state(rate).alias("state"),
        rules.day_period(hour).alias("day_period"),
        rules.rush_period(hour).alias("rush_period"),
        rules.zone_status(rules.traffic_level(F.col("vehicle_count")), rules.congestion_level(rate)).alias("zone_status"),
    )


# --- aggregates -----------------------------------------------------------------------

simple("a1_zone_hour_traffic", zone_hour)
simple("a2_road_speed", roads)
simple("a3_zone_congestion", zones)
simple("a4_hourly_zone", hours)
simple("a5_strategic_zones", strategic)
simple("a6_congestion_analysis", analysis)
simple("a7_hourly_analysis", hourly)
simple("a8_executive_overview", fx.traffic, marts.executive_overview_from_events)


@query("a8_executive_overview_from_tables")
def _(s, d):
    stored = jobs.processed_tables(workspace.written(jobs.road_hours(fx.traffic(s, d)), "road-hours"))
    return marts.executive_overview(stored["traffic_by_zone"], stored["speed_by_road"], stored["congestion_by_zone"])


simple("a9_zone_traffic", traffic2, digits=6)
simple("a10_zone_speed", speed2, digits=6)
simple("a11_zone_congestion_levels", congestion2, digits=12)
simple("a12_temporal_evolution", fx.kpi_input, kpis.temporal_evolution, digits=12)
simple("a13_weekly_profile", fx.traffic, kpis.weekly_profile)
simple("a14_road_type_profile", fx.traffic, kpis.road_type_profile, digits=6)
for _name, _digits in (("weekly_profile", None), ("road_type_profile", 6)):
    query(f"a13_stored_{_name}")(lambda s, d, n=_name, k=_digits: rounded(
        s.read.parquet(jobs.write_trends(fx.traffic(s, d), workspace.fresh_path(s, "trends"))[n]).drop("processed_at"), k))
simple("a15_peak_periods", fx.traffic, kpis.weekly_profile, kpis.peak_periods)
simple("a16_route_congestion", fx.traffic, kpis.road_totals, kpis.route_congestion)
simple("a16_congested_routes", fx.traffic, kpis.road_totals, kpis.route_congestion, kpis.congested_routes)
simple("a17_slow_roads", fx.traffic, kpis.road_totals, kpis.slow_roads)
simple("a18_network_performance", strategic, reports.network_performance, digits=6)
simple("a19_period_report", hourly, reports.period_report, digits=6)


@query("a20_executive_report")
def _(s, d):
    stored = jobs.processed_tables(workspace.written(jobs.road_hours(fx.traffic(s, d)), "road-hours"))
    return rounded(reports.executive_report(
        marts.strategic_zones(stored["traffic_by_zone"]), marts.congestion_analysis(stored["congestion_by_zone"])), 6)


simple("a21_total_impact", analysis, reports.most_congested, reports.total_impact)


def _recent(interval):
    def run(s, d):
        return alert_ops.recent_summary(fx.alerts(s, d), panels.back(fx.as_of(fx.traffic(s, d)), interval))
    return run


simple("a22_recent_alerts", _recent("240 HOURS"), digits=6)
simple("a23_alert_dashboard", _recent("240 HOURS"), alert_ops.dashboard_sections, digits=6)
simple("a24_active_alerts", fx.alerts, alert_ops.active_summary)
simple("a25_lenient_summary", fx.traffic, kpis.lenient_zone_summary)
simple("a26_global_summary", fx.traffic, kpis.lenient_zone_summary, kpis.global_summary)


@query("a28_row_counts")
def _(s, d):
    return quality.row_counts(tables.processed_zone(s, _write_processed(s, d)))


@query("a29_serving_checks")
def _(s, d):
    made = family(s, d)
    return rounded(reports.serving_checks(made["trafic_par_zone"], made["zones_critiques"]), 6)


@query("a30_zone_validation")
def _(s, d):
    stored = tables.processed_zone(s, _write_processed(s, d))["traffic_by_zone"]
    return quality.zone_validation({
        "raw": fx.raw_lines(s, d), "processed": stored, "analytics": marts.strategic_zones(stored),
    })


simple("a31_metric_rows", metrics, digits=6)

# --- windows and joins ------------------------------------------------------------------

# The ranking reads its input twice, so the aggregate is stored first.
simple("w1_road_performance", roads, lambda f: workspace.written(f, "roads"), marts.road_performance)
FEATURES = [
    "event_id", "hour", "day_of_week", "month", "year", "vehicle_count_target", "speed_target",
    "congestion_target", *features.FILLED,
]
simple("w2_lags", fx.traffic, features.history, lambda f: f.select(
    "event_id", *[c for c in features.FILLED if "_lag" in c]))
simple("w3_rolling_means", fx.traffic, features.history, lambda f: f.select(
    "event_id", *[c for c in features.FILLED if c.endswith("_ma3")]), digits=6)
simple("w4_rolling_spread", fx.traffic, features.history, lambda f: f.select(
    "event_id", *[c for c in features.FILLED if c.endswith("_std3")]), digits=6)
simple("w5_next_step", fx.traffic, features.history, lambda f: f.select(
    "event_id", "vehicle_count_target", "speed_target", "congestion_target"))
simple("w6_ranked_zones", traffic2, reports.ranked_zones)
simple("m2_feature_table", fx.traffic, features.feature_table, lambda f: f.select(*FEATURES), digits=6)
# Same table with series cut into chunks of an hour.
simple("m2_feature_table_chunked", fx.traffic, lambda f: features.feature_table(f, seconds_per_chunk=3600),
       lambda f: f.select(*FEATURES), digits=6)



@query("j1_critical_zones")
def _(s, d):
    return rounded(marts.critical_zones(traffic2(s, d), congestion2(s, d)), 6)


@query("j2_main_dashboard")
def _(s, d):
    stored = jobs.processed_tables(workspace.written(jobs.road_hours(fx.traffic(s, d)), "road-hours"))
    return marts.main_dashboard(
        marts.strategic_zones(stored["traffic_by_zone"]), marts.congestion_analysis(stored["congestion_by_zone"])
    )


@query("j4_zone_comparisons")
def _(s, d):
    base = comparison_base(s, d)
    return rounded(comparisons.compare_zones(
        comparisons.zone_metrics(base), comparisons.baseline_pairs(base, BASELINE)), 6)


simple("j4_peak_comparisons", fx.traffic, comparisons.comparison_base, comparisons.peak_against_rest, digits=6)
simple("j4_weekday_comparisons", fx.traffic, comparisons.comparison_base, comparisons.weekday_against_weekend, digits=6)

# --- limits and set operations --------------------------------------------------------------

simple("o2_top_three_congested", zones, lambda f: f.orderBy(F.desc("congestion_rate_percent"), "zone").limit(3))
simple("o3_top_ten_congested", analysis, reports.most_congested)
simple("o3_chart_top_five", analysis, lambda f: reports.most_congested(reports.most_congested(f), 5))


@query("u1_serving_totals")
def _(s, d):
    made = family(s, d)
    return reports.serving_totals(
        made["trafic_par_zone"], made["zones_critiques"], made["taux_congestion"], made["vitesse_moyenne"])


simple("u3_distinct_zones", fx.traffic, lambda f: reports.distinct_values(f, "zone"))
simple("m7_recommendations", fx.traffic, kpis.road_totals, lambda f: workspace.written(f, "road-totals"),
       recommendations.recommend)

# --- reports and panels -------------------------------------------------------------------

def _positions(report):
    """The order of a report as a column."""
    return report.coalesce(1).withColumn("position", F.monotonically_increasing_id() + 1)


simple("o4_service_level_order", strategic, reports.network_performance, lambda f: f.select("niveau_service"), _positions)
simple("o4_day_period_order", hourly, reports.period_report, lambda f: f.select("periode_journee"), _positions)
simple("o1_congestion_order", analysis, reports.most_congested, lambda f: f.select("zone"), _positions)
simple("q2_hours_view", hourly, reports.hours_view)
simple("q3_congestion_alerts_view", analysis, reports.congestion_alerts_view)
simple("q7_hourly_trend", hourly, reports.hourly_trend)


@query("g1_heat_map")
def _(s, d):
    return panels.heat_map(tables.zone_coordinates(s), canonical_traffic(s, d))


simple("g2_average_congestion", congestion2, panels.average_congestion, digits=6)
simple("g3_critical_zone_count", critical, panels.critical_zone_count)
simple("g4_busiest_zone", traffic2, panels.busiest_zone)
simple("g5_fastest_zone", speed2, panels.fastest_zone)
simple("g6_traffic_ranking", traffic2, panels.traffic_ranking)
simple("g7_congestion_ranking", congestion2, panels.congestion_ranking)


@query("g8_speed_series")
def _(s, d):
    now = fx.as_of(fx.traffic(s, d))
    return panels.speed_series(kpis.zone_snapshots(panels.since(fx.traffic(s, d), now, "4 HOURS")), now)


simple("g9_traffic_series", fx.snapshots, panels.traffic_series)
simple("g10_interventions", critical, panels.interventions)
simple("g11_global_performance", speed2, panels.global_performance)
simple("g12_zone_count", traffic2, panels.zone_count)
simple("g13_fluidity_rate", congestion2, panels.fluidity_rate)


@query("g14_markers")
def _(s, d):
    return panels.markers(tables.zone_coordinates(s), canonical_traffic(s, d))


@query("g16_active_alert_count")
def _(s, d):
    return panels.active_alert_count(fx.alerts(s, d), fx.as_of(fx.traffic(s, d)), "48 HOURS")


@query("g17_flow_by_direction")
def _(s, d):
    flow = fx.flow(s, d)
    latest = fx.table(s, d, "lineitem").agg(F.max("l_shipdate")).scalar()
    return panels.flow_panel(kpis.flow_by_direction(flow, panels.back(latest, "365 DAYS")))


@query("g18_metric_series")
def _(s, d):
    now = fx.as_of(fx.traffic(s, d))
    return rounded(panels.metric_series(kpis.metric_rows(panels.since(fx.traffic(s, d), now, "24 HOURS")), now), 6)


@query("g19_largest_differences")
def _(s, d):
    # Rounded before ranking, so that both engines break ties the same way.
    now = fx.as_of(fx.traffic(s, d))
    # Two copies of each comparison, one of them an hour and a minute old: only the newer ones are recent.
    made = rounded(jobs.compare(fx.traffic(s, d), BASELINE, now), 6)
    old = made.withColumn("timestamp", panels.back(F.col("timestamp"), "61 MINUTES"))
    return panels.largest_differences(made.unionByName(old), now)


@query("g20_latest_alerts")
def _(s, d):
    return panels.latest_alerts(fx.alerts(s, d), fx.as_of(fx.traffic(s, d)))


@query("g21_repaired_zone_ranking")
def _(s, d):
    repaired = fx.dirty(s, d).withColumn("zone", text.canonical_zone(F.col("zone")))
    return reports.ranked_zones(kpis.zone_traffic(repaired))


# --- alerts -----------------------------------------------------------------------------

simple("t4_window_metrics", fx.windows)
simple("t6_detected_alerts", fx.windows, alert_ops.detect,
       lambda f: f.select("window_end", "road_id", "zone", "alert_type"))
simple("t11_alert_lifecycle", fx.alerts)
# Windows shorter than the escalation limits: not every refresh escalates.
simple("t11_alert_lifecycle_minutes", fx.traffic, alert_ops.window_metrics, alert_ops.lifecycle)
simple("t13_outbox", fx.alerts,
       lambda f: notifications.outbox(f, {"email": True, "slack": True, "webhook": True}))


# --- streams ------------------------------------------------------------------------------

FILES_A_BATCH = 2  # more on a cluster; each part of the stream is as many files


def _event_stream(s, d):
    """The events table as a stream of readings."""
    schema = fx.table(s, d, "events").schema
    rows = s.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return fx.as_traffic(rows).withColumn("event_time", F.col("event_time").cast("timestamp"))


def _finish(running) -> None:
    running.awaitTermination()
    if running.exception():
        raise running.exception()


simple("t2_parsed_messages", fx.raw_lines, raw.stream_events,
       lambda f: f.drop("ingested_at").withColumn("event_time", F.col("event_time").cast("timestamp_ntz")))
simple("t2_rejected_messages", fx.raw_lines, raw.stream_rejects, lambda f: f.drop("ingested_at"))


@query("t4_stream_window_metrics")
def _(s, d):
    path = workspace.fresh_path(s, "live")
    metrics_ = live.live_metrics(_event_stream(s, d))
    _finish(live.run(metrics_, live.live_display(path), workspace.fresh_path(s, "live-state"), trigger=None))
    rows = s.read.option("basePath", path).parquet(path).drop("batch")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def _alert_stream(s, d, state: str | None = None) -> str:
    path = workspace.fresh_path(s, "alert-changes")
    changes = lifecycle.alert_changes(live.live_metrics(_event_stream(s, d), fx.WINDOW))
    _finish(live.run(changes, lifecycle.keep_changes(path), state or workspace.fresh_path(s, "alert-state"), trigger=None))
    return path


@query("t7_stream_alerts")
def _(s, d):
    return lifecycle.current_alerts(s, _alert_stream(s, d))


@query("t7_open_state")
def _(s, d):
    """The open alerts as the stream's state holds them, without its change log."""
    state = workspace.fresh_path(s, "alert-state")
    _alert_stream(s, d, state)
    return lifecycle.open_alerts(s, state)


@query("t7_ended_stream_alerts")
def _(s, d):
    """The same stream with its end marked once all events are read: the last windows close as well."""
    path, state, ends = (workspace.fresh_path(s, name) for name in ("alert-changes", "alert-state", "ends"))

    def go() -> None:
        events = live.with_ends(_event_stream(s, d), ends)
        changes = lifecycle.alert_changes(live.live_metrics(events, fx.WINDOW))
        _finish(live.run(changes, lifecycle.keep_changes(path), state, trigger=None))

    go()
    last = fx.table(s, d, "events").agg(F.max("ts")).first()[0]
    live.end_at(s, ends, last.replace(tzinfo=dt.timezone.utc) + dt.timedelta(days=2))
    go()
    return lifecycle.current_alerts(s, path)


@query("t7_stream_alerts_many_batches")
def _(s, d):
    """The same stream in four parts by time, a batch each, so that open alerts live from one batch to the next."""
    events, staged, files_, path = fx.table(s, d, "events"), *(workspace.fresh_path(s, n) for n in ("quarters", "event-files", "alert-changes"))
    second = timeparts.epoch_seconds(F.col("ts"))
    low, high = events.agg(F.min(second), F.max(second)).first()
    quarter = F.floor((second - low) * 4 / (high - low + 1))
    events.withColumn("quarter", quarter).write.partitionBy("quarter").parquet(staged)
    for k in range(4):
        s.read.schema(events.schema).parquet(f"{staged}/quarter={k}").repartition(FILES_A_BATCH).write.mode("append").parquet(files_)
    rows = s.readStream.schema(events.schema).option("maxFilesPerTrigger", FILES_A_BATCH).parquet(files_)
    stream = fx.as_traffic(rows).withColumn("event_time", F.col("event_time").cast("timestamp"))
    changes = lifecycle.alert_changes(live.live_metrics(stream, fx.WINDOW))
    _finish(live.run(changes, lifecycle.keep_changes(path), workspace.fresh_path(s, "alert-state"), trigger=None))
    return lifecycle.current_alerts(s, path)


@query("t13_stream_announcements")
def _(s, d):
    told = lifecycle.announcements(s, _alert_stream(s, d))
    return notifications.outbox(told, escalated=F.col("is_escalation")).groupBy("channel", "is_escalation").agg(
        F.count("*").alias("messages"), F.count_distinct("alert_id").alias("alerts")
    )


def _landed(s, path):
    rows = s.read.text(path)
    return rows.groupBy("date", "zone").agg(F.count("*").alias("messages"), F.sum(F.length("value")).alias("characters"))


@query("k8_landed_messages")
def _(s, d):
    path = workspace.fresh_path(s, "landed")
    landing.land_batch(fx.raw_lines(s, d), path)
    return _landed(s, path)


@query("k8_landed_stream")
def _(s, d):
    lines, path = workspace.fresh_path(s, "lines"), workspace.fresh_path(s, "landed")
    fx.raw_lines(s, d).select("value").write.text(lines)
    _finish(landing.land_stream(raw.text_stream(s, lines), path, workspace.fresh_path(s, "land-state"), trigger=None))
    return _landed(s, path)


@query("k8_compacted")
def _(s, d):
    """The zone of a stream of several batches after two compactions, the last batch still loose."""
    lines, path, store = (workspace.fresh_path(s, name) for name in ("lines", "landed", "compacted"))
    fx.raw_lines(s, d).select("value").repartition(6).write.text(lines)
    stream = s.readStream.option("maxFilesPerTrigger", 2).text(lines)
    _finish(landing.land_stream(stream, path, workspace.fresh_path(s, "land-state"), trigger=None))
    landing.compact_landed(s, path, store)
    landing.compact_landed(s, path, store)
    return landing.landed(s, path, store).groupBy("date", "zone").agg(
        F.count("*").alias("messages"), F.sum(F.length("value")).alias("characters"))


# --- shared rollup ----------------------------------------------------------------------------

for _name in files.PROCESSED_LAYOUT:
    simple(f"k1_rollup_{_name}", fx.traffic, jobs.road_hours, lambda f, n=_name: jobs.processed_tables(f)[n])


def _two_batches(s, d) -> dict[str, DataFrame]:
    """All KPI tables from the states of two batches; the first is folded, the second arrives twice."""
    store, rows = workspace.fresh_path(s, "kpi-states"), fx.traffic(s, d)
    late = F.col("event_time") >= rows.agg(F.timestamp_seconds(F.avg(timeparts.epoch_seconds(F.col("event_time")))).cast("timestamp_ntz")).scalar()
    increments.add(rows.filter(~late), store, 0)
    increments.fold(s, store)
    for _ in range(2):
        increments.add(rows.filter(late), store, 1)
    return increments.kpi_tables(increments.states(s, store))


# Last bits depend on the order of sums.
KPI_DIGITS = {"trafic_par_zone": 6, "vitesse_moyenne": 6, "taux_congestion": 12, "evolution_trafic": 12, "zones_critiques": 6}
for _name in increments.LAYOUT:
    query(f"k1_two_batches_{_name}")(lambda s, d, n=_name: rounded(_two_batches(s, d)[n], KPI_DIGITS.get(n)))


@query("j1_second_family_one_pass")
def _(s, d):
    return rounded(jobs.second_family(fx.traffic(s, d))["zones_critiques"], 6)


# --- models -----------------------------------------------------------------------------------

def _features(s, d):
    return workspace.written(features.feature_table(fx.traffic(s, d)), "features")


@query("m1_category_index")
def _(s, d):
    encoded = models.encode_categories(fx.traffic(s, d))
    return encoded.groupBy("road_type", "road_type_index", "zone", "zone_index").agg(F.count("*").alias("n"))


def _scores(s, trained: models.Trained):
    rows = [(name, float(value)) for name, value in trained.scores.items()]
    return s.createDataFrame(rows, "metric string, value double")


@query("m3_traffic_model")
def _(s, d):
    return _scores(s, models.train_traffic(_features(s, d)))


@query("m4_congestion_model")
def _(s, d):
    return _scores(s, models.train_congestion(_features(s, d)))


@query("a27_confusion_matrix")
def _(s, d):
    return models.confusion_matrix(models.train_congestion(_features(s, d)).predictions)


def _flagged(s, d):
    table = _features(s, d)
    return anomalies.flag(workspace.written(anomalies.score(table, anomalies.fit(table)), "anomaly-scores"))


simple("m5_anomaly_scores", _flagged, lambda f: f.select(*files.PREDICTION_COLUMNS["anomalies_detected"]))
simple("m6_anomaly_share", _flagged, anomalies.anomaly_share)
simple("m6_most_severe", _flagged, anomalies.most_severe)


def _forecast(s, d):
    table = workspace.written(features.feature_table(features.hourly_series(fx.traffic(s, d))), "hourly-features")
    return models.forecast(models.forecast_start(fx.traffic(s, d)), models.train_traffic(table), models.train_speed(table))


# The same operators over given predictions and scores, which SQL can check.

@query("m3_split_rows")
def _(s, d):
    table = _features(s, d)
    parts = [side.select(F.lit(percent).alias("percent"), F.lit(train).alias("train"))
             for percent in (70, 80) for train, side in zip((True, False), models.split(table, percent))]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3]).groupBy("percent", "train").agg(F.count("*").alias("rows"))


@query("m3_given_scores")
def _(s, d):
    given = _features(s, d).withColumn("p", F.col("vehicle_count") + F.col("average_speed") / 4)
    return rounded(models.regression_scores(given, "vehicle_count_target", "p"), 6)


def _given_classes(s, d):
    return _features(s, d).withColumn("congestion_prediction", (F.col("average_speed") < 35).cast("int").cast("double"))


simple("m4_given_accuracy", _given_classes, models.accuracy, digits=6)
simple("a27_given_predictions", _given_classes, models.confusion_matrix)


@query("m1_one_hot_vectors")
def _(s, d):
    encoded = models.encode_categories(fx.traffic(s, d))
    digits = F.transform(vector_to_array("road_type_vec"), lambda x: x.cast("int").cast("string"))
    return encoded.select("road_type", F.array_join(digits, ",").alias("vector")).distinct()


def _given_flags(s, d):
    whole = F.col("average_speed").isNotNull() & F.col("occupancy_rate").isNotNull()
    score = F.when(whole, -((F.col("event_id") * 7919) % 1000 + 1).cast("double") / 1024)
    rows = timeparts.with_calendar(fx.traffic(s, d)).withColumn("anomaly_score", score)
    return anomalies.flag(workspace.written(rows, "given-scores"))


simple("m6_given_share", _given_flags, anomalies.anomaly_share)
simple("m6_given_most_severe", _given_flags, anomalies.most_severe)


@query("k10_given_tables")
def _(s, d):
    table = _given_classes(s, d)
    given = table.withColumns({"predicted_vehicle_count": F.col("vehicle_count"), "is_anomaly": F.lit(0), "anomaly_score": F.lit(0.0)})
    paths = files.write_predictions({
        "traffic_predictions": models.split(given, 80)[1], "congestion_predictions": models.split(given, 70)[1],
        "anomalies_detected": given}, workspace.fresh_path(s, "given"))
    counts = [s.read.parquet(path).select(*files.PREDICTION_COLUMNS[name]).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
              for name, path in paths.items()]
    return counts[0].union(counts[1]).union(counts[2])


@query("m8_forecast_inputs")
def _(s, d):
    """What a forecast starts from, and where two steps with given predictions lead."""
    given = lambda f: f.withColumns({
        "predicted_vehicle_count": F.col("vehicle_count") + 1, "predicted_speed": F.col("average_speed") + 0.5})
    shown = ["road_id", "zone", "event_time", "hour", *models.CURRENT, *features.FILLED]
    step, tables_ = models.forecast_start(fx.traffic(s, d)), []
    for n in range(3):
        tables_.append(step.select(F.lit(n).alias("step"), *shown))
        step = models.next_hour(given(step))
    return rounded(tables_[0].unionByName(tables_[1]).unionByName(tables_[2]), 6)


simple("m8_zone_forecast", _forecast, lambda f: serving.for_serving(f, "traffic_predictions"))


@query("g15_forecast_series")
def _(s, d):
    return panels.forecast_series(fx.predictions(s, d), fx.as_of(fx.traffic(s, d)))


@query("k10_prediction_tables")
def _(s, d):
    paths = jobs.predict(fx.traffic(s, d), workspace.fresh_path(s, "predictions"))
    return quality.dataset_summary({name: s.read.parquet(path) for name, path in paths.items()})
