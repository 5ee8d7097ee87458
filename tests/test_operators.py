"""Skew-proof operators against plain ones, merges, comparisons, panels."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from conftest import rows
from roadflux.operators import comparisons, features, quality, series, upsert
from roadflux.operators import ranking
from roadflux.operators.ranking import dense_rank_desc
from verification import fixtures as fx
from roadflux.plans import panels, reports

EVENTS = ("sensor_id string, road_id string, road_type string, zone string, vehicle_count bigint, "
          "average_speed double, occupancy_rate double, event_time timestamp_ntz")


def skewed_events(spark, n=900, seed=1):
    """A third of the rows in one series; gaps, bursts, equal times and missing keys elsewhere."""
    rng = random.Random(seed)
    start, out = dt.datetime(2024, 1, 1), []
    for i in range(n):
        road = "HOT" if i % 3 == 0 else rng.choice(["A", "B", None])
        zone = "Z" if road == "HOT" else rng.choice(["Z", "Y"])
        # Times pile up at the start of the hot series, so its chunks are uneven.
        at = start + dt.timedelta(seconds=int(rng.random() ** 3 * 5000) if road == "HOT" else rng.randrange(400))
        speed = None if rng.random() < 0.1 else rng.randrange(400) / 4
        out.append((f"S{i}", road, "rue", zone, rng.randrange(300), speed, rng.randrange(400) / 4, at))
    return spark.createDataFrame(out, EVENTS)


def plain_history(events):
    """Frames over whole series."""
    w = Window.partitionBy(*features.SERIES).orderBy(*features.ORDER)
    return events.select(*events.columns, F.lag("vehicle_count", 2).over(w).alias("vehicle_count_lag2"),
                         F.lead("average_speed", 1).over(w).alias("speed_target"),
                         F.avg("average_speed").over(w.rowsBetween(-3, 0)).alias("speed_ma3"))


@pytest.mark.parametrize("seconds", [0.5, 1, 7, 60, 86_400])
def test_chunked_frames_equal_whole_series(spark, seconds):
    events = skewed_events(spark).cache()
    want = plain_history(events)
    got = features.history(events, seconds).select(*want.columns)
    assert rows(got) == rows(want)


def test_hot_and_single_instant_series(spark):
    start = dt.datetime(2024, 1, 1)
    hot = [(f"S{i}", "R", "rue", "Z", i, i / 4, 1.0, start + dt.timedelta(seconds=i)) for i in range(500)]
    burst = [(f"S{i}", "Q", "rue", "Z", i, i / 4, 1.0, start) for i in range(200)]
    for data in (hot, burst, [*hot, *burst, ("N", None, "rue", None, 1, 1.0, 1.0, start)]):
        events = spark.createDataFrame(data, EVENTS).cache()
        want = plain_history(events)
        assert rows(features.history(events, 60).select(*want.columns)) == rows(want)


def test_long_series_are_split(spark):
    pieces = series.chunked(skewed_events(spark), "event_time", 60)
    assert pieces.filter("road_id = 'HOT'").select(series.CHUNK).distinct().count() > 3


def test_repeated_rows_at_the_edges_stay(spark):
    start = dt.datetime(2024, 1, 1)
    data = [("S", "R", "rue", "Z", 1, 2.0, 3.0, start + dt.timedelta(seconds=n // 5)) for n in range(100)]
    data += [("S", "R", "rue", "Z", 1, 2.0, None, None)] * 3
    events = spark.createDataFrame(data, EVENTS).repartition(4)
    for seconds in (1, 3, 7):
        got = features.history(events, seconds)
        assert got.count() == len(data)
        assert rows(got.select(*plain_history(events).columns)) == rows(plain_history(events))


def test_events_are_read_and_shuffled_once(spark, sf_dir):
    table = features.feature_table(fx.traffic(spark, sf_dir))
    table.write.format("noop").mode("overwrite").save()
    table.collect()
    plan = table._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 1 and plan.count("ReusedExchange") == 1


def test_dense_rank(spark):
    rng = random.Random(3)
    data = [(i, "g1" if i % 3 else "g2", None if i % 17 == 0 else rng.randrange(60) / 8) for i in range(400)]
    frame = spark.createDataFrame(data + [(900, None, 1.0), (901, None, 2.0)], "id int, g string, v double")
    want = frame.withColumn("rank", F.dense_rank().over(Window.partitionBy("g").orderBy(F.desc("v"))))
    assert rows(dense_rank_desc(frame, "g", "v")) == rows(want)
    assert rows(dense_rank_desc(frame, "g", "v", bands=3)) == rows(want)
    narrow = frame.withColumn("v", F.col("v") / 1e6 + 50)
    want = narrow.withColumn("rank", F.dense_rank().over(Window.partitionBy("g").orderBy(F.desc("v"))))
    assert rows(dense_rank_desc(narrow, "g", "v")) == rows(want)


def test_close_values_are_split_into_bands(spark):
    values = spark.range(20_000).select(F.lit("g").alias("_g"), (50 + F.col("id") / 1e9).alias("_v"))
    sizes = [r["count"] for r in ranking.banded(values, 64).groupBy("_b").count().collect()]
    assert len(sizes) >= 60 and max(sizes) < 1000


def test_merge_replaces_or_updates(spark):
    base = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], "k string, x int, y int")
    new = spark.createDataFrame([("b", 9, 9, 1), ("c", 3, 3, 1), ("c", 4, 4, 2), ("b", 8, None, 2)], "k string, x int, y int, o int")
    assert rows(upsert.merge_rows(base, new, ["k"], order="o")) == [("a", 1, 1), ("b", 8, None), ("c", 4, 4)]
    part = upsert.merge_rows(base, new, ["k"], update=["x"], order="o")
    assert rows(part) == [("a", 1, 1), ("b", 8, 2), ("c", 4, 3)]
    assert rows(upsert.merge_rows(part, new, ["k"], update=["x"], order="o")) == rows(part)
    empty = new.filter("false")
    assert rows(upsert.merge_rows(base, empty, ["k"])) == rows(base)


def test_percentage_differences(spark):
    frame = spark.createDataFrame(
        [(1250.5, 890.3, 40.5), (35.2, 45.8, -23.1), (1250.5, 980.2, 27.5)], "a double, b double, want double")
    got = frame.withColumn("got", comparisons.percentage_difference(F.col("a"), F.col("b")))
    assert got.filter(F.abs(F.col("got") - F.col("want")) > 0.1).count() == 0
    zero = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert zero.select(comparisons.percentage_difference(F.col("a"), F.col("b"))).first()[0] is None


def test_comparisons_grow_with_zones_only(spark):
    metrics = spark.createDataFrame([(f"z{i}", "m", float(i)) for i in range(1, 41)], "zone string, metric_name string, value double")
    got = comparisons.compare_zones(metrics, comparisons.baseline_pairs(metrics, "z1"))
    assert got.count() == 39
    chosen = spark.createDataFrame([("z2", "z4")], "zone1 string, zone2 string")
    assert comparisons.compare_zones(metrics, chosen).first().percentage_diff == -50.0


# Reset rows of the serving tables, and what the panels show for them.
SEED = """Centre_Ville|286.91|Élevé|Modéré|45.2|24.6
Centre_Commercial|170.86|Moyen|Élevé|38.5|32.1
Périphérie_Nord|90.34|Faible|Faible|12.3|58.4
Périphérie_Sud|91.00|Faible|Faible|10.8|56.8
Quartier_Résidentiel|104.27|Faible|Faible|8.5|48.2
Quartier_Est|99.35|Faible|Faible|9.2|52.1
Zone_Industrielle|107.95|Faible|Faible|7.8|62.3
Zone_Commerciale|94.96|Faible|Faible|8.9|44.9"""


@pytest.fixture(scope="module")
def seed(spark):
    values = [line.split("|") for line in SEED.splitlines()]
    frame = spark.createDataFrame(
        [(z, float(t), n, c, float(r), float(v)) for z, t, n, c, r, v in values],
        "zone string, trafic_moyen_vehicules_heure double, niveau_trafic string, niveau_congestion string, "
        "taux_congestion_pourcentage double, vitesse_moyenne_kmh double")
    return frame


def test_single_number_panels(seed):
    assert panels.average_congestion(seed).first().value == pytest.approx(17.65)
    assert panels.critical_zone_count(seed).first().value == 2
    assert panels.zone_count(seed).first().value == 8
    assert panels.global_performance(seed).first().value == 94.9
    assert panels.fluidity_rate(seed).first().value == pytest.approx(82.4, abs=0.051)
    assert tuple(panels.busiest_zone(seed).first()) == ("Zone: Centre_Ville: 286.9 véhicules/h", 286.91)
    assert tuple(panels.fastest_zone(seed).first()) == ("Fast: Zone_Industrielle: 62.3 km/h", 62.3)


def test_ranking_panels(seed):
    top = panels.traffic_ranking(seed, 2).collect()
    assert [(r.zone, r.estimation_totale) for r in top] == [("Centre_Ville", 344.0), ("Centre_Commercial", 205.0)]
    states = {r.zone: r.etat for r in panels.congestion_ranking(seed).collect()}
    assert states["Centre_Ville"] == "Orange: Dense" and states["Centre_Commercial"] == "Yellow: Modéré"
    assert states["Zone_Industrielle"] == "Green: Fluide"
    actions = panels.interventions(seed).collect()
    assert [(a.zone, a.priority) for a in actions[:2]] == [("Centre_Commercial", 3), ("Centre_Ville", 2)]
    ranked = reports.ranked_zones(seed).orderBy("rang").collect()
    assert [r.zone for r in ranked[:3]] == ["Centre_Ville", "Centre_Commercial", "Zone_Industrielle"]


def test_totals(seed):
    got = {r.metric: r.value for r in reports.serving_totals(seed, seed, seed, seed).collect()}
    assert got == {"Trafic Total": 1045.64, "Zones Critiques": 2.0, "Congestion Moyenne": 17.65, "Vitesse Moyenne": 47.43}
    checks = reports.serving_checks(seed, seed).first()
    assert checks.niveaux == "Faible, Modéré, Élevé" and checks.zones_critiques == 2


def test_map_keeps_places_without_traffic(spark, seed):
    from roadflux.sources.tables import zone_coordinates

    few = seed.filter("zone in ('Centre_Ville', 'Zone_Commerciale')")
    heat = {r.zone_name: r for r in panels.heat_map(zone_coordinates(spark), few).collect()}
    assert len(heat) == 8
    assert heat["Casablanca Centre"].density_level == "Critical"
    assert heat["Casablanca Centre"].tooltip_info == "Casablanca Centre\nTraffic: 286.9 veh/h\nLevel: Critical"
    assert heat["Ain Diab"].traffic_density == 0.0 and heat["Ain Diab"].density_level == "Very Low"
    marks = {r.name: r for r in panels.markers(zone_coordinates(spark), few).collect()}
    assert marks["Ain Diab"].traffic_density is None and marks["Casablanca Centre"].density_level == "High"


def test_forecast_panel(spark):
    t = dt.datetime(2024, 1, 1, 12)
    frame = spark.createDataFrame(
        [("Centre_Ville", t + dt.timedelta(hours=h), v, s, c) for h, v, s, c in (
            (1, 1450.5, 32.1, 0.85), (2, 1650.8, 28.5, 0.78), (-4, 1100.2, 42.3, 0.5), (-5, 1350.7, 38.9, 0.82))],
        "zone string, prediction_timestamp timestamp_ntz, predicted_traffic double, predicted_speed double, confidence_score double")
    got = panels.forecast_series(frame, F.lit(t)).collect()
    assert [r.predicted_traffic for r in got] == [1100.2, 1450.5, 1650.8]
    assert [r.confidence_percent for r in got] == [50.0, 85.0, 78.0]


def test_gates_and_counts(spark):
    small = spark.range(60)
    assert {r.check: r.passed for r in quality.volume_gates(small).collect()} == {
        "not_empty": True, "history": False, "traffic_model": True, "congestion_model": True}
    assert {r.check: r.passed for r in quality.zone_validation({"raw": small, "analytics": small.limit(0)}).collect()} == {
        "raw": True, "analytics": False}
    nulls = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert rows(quality.null_counts(nulls)) == [("a", 1), ("b", 2)]
