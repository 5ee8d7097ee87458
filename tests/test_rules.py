"""Every rule at, just below and just above each cut, and for NULL."""

import pytest
from pyspark.sql import functions as F

from roadflux.functions import numbers, rules

EPS = 0.001
UNDER = {  # rule: (limit, label above it) from high to low, the label under all; strict or not
    "service_level": ([(70, "A - Excellent"), (50, "B - Bon"), (30, "C - Moyen"), (20, "D - Faible")], "E - Critique", True),
    "performance_score": ([(80, 100), (60, 80), (40, 60), (30, 40)], 20, True),
    "congestion_band": ([(50, "Élevée ( > 50%)"), (30, "Modérée (30-50%)"), (15, "Légère (15-30%)")], "Fluide ( < 15%)", True),
    "band_priority": ([(50, 1), (30, 2), (15, 3)], 4, True),
    "traffic_level": ([(200, "Élevé"), (120, "Moyen")], "Faible", True),
    "fluidity": ([(60, "Excellente"), (50, "Bonne"), (40, "Moyenne"), (30, "Faible")], "Mauvaise", False),
    "congestion_level": ([(70, "Critique"), (50, "Élevé"), (30, "Modéré")], "Faible", False),
    "level_priority": ([(70, 1), (50, 2), (30, 3)], 4, False),
    "event_service_letter": ([(60, "A"), (50, "B"), (40, "C"), (30, "D"), (20, "E")], "F", False),
    "rate_severity": ([(70, "CRITIQUE"), (50, "ÉLEVÉ"), (30, "MOYEN")], "FAIBLE", True),
    "density": ([(200, "Critical"), (150, "High"), (100, "Medium"), (50, "Low")], "Very Low", True),
    "marker_density": ([(200, "High"), (100, "Medium")], "Low", True),
}


@pytest.mark.parametrize("name", UNDER)
def test_cuts(spark, name):
    steps, default, strict = UNDER[name]
    labels = [label for _, label in steps] + [default]
    cases = [(None, default)]
    for i, (limit, label) in enumerate(steps):
        cases += [(limit + EPS, label), (float(limit), labels[i + 1] if strict else label), (limit - EPS, labels[i + 1])]
    frame = spark.createDataFrame(cases, f"x double, want {'int' if isinstance(default, int) else 'string'}")
    wrong = frame.withColumn("got", getattr(rules, name)(F.col("x"))).filter(~F.col("got").eqNullSafe(F.col("want")))
    assert wrong.collect() == []


def test_rising_cuts(spark):
    frame = spark.createDataFrame(
        [(19.9, "Green: Fluide"), (20.0, "Yellow: Modéré"), (40.0, "Orange: Dense"), (60.0, "Red: Congestionné"),
         (None, "Red: Congestionné")], "x double, want string")
    assert frame.filter(rules.congestion_state(F.col("x")) != F.col("want")).count() == 0
    road = spark.createDataFrame(
        [(29.9, "CRITIQUE - Intervention requise"), (30.0, "ALERTE - Surveillance renforcée"),
         (50.0, "NORMAL - Bonnes conditions"), (None, "NORMAL - Bonnes conditions")], "x double, want string")
    assert road.filter(rules.road_status(F.col("x")) != F.col("want")).count() == 0


def test_congestion_depends_on_road_type(spark):
    cases = [
        ("autoroute", 49.9, 0.0, True), ("autoroute", 50.0, 30.0, False), ("autoroute", 90.0, 30.1, True),
        ("avenue", 29.9, 0.0, True), ("avenue", 30.0, 30.0, False), ("avenue", 60.0, 30.1, True),
        ("rue", 24.9, 0.0, True), ("rue", 25.0, 30.0, False), ("rue", 60.0, 31.0, True),
        ("boulevard", 1.0, 99.0, False), (None, 1.0, 99.0, False),
        ("rue", None, 31.0, True), ("rue", None, 30.0, False), ("rue", 24.0, None, True), ("rue", None, None, False),
    ]
    frame = spark.createDataFrame(cases, "t string, s double, o double, want boolean")
    got = frame.withColumn("got", rules.is_congested(F.col("t"), F.col("s"), F.col("o")))
    assert got.filter("got is null or got != want").collect() == []


def test_alert_types(spark):
    high, moderate, low = "HIGH_CONGESTION", "MODERATE_CONGESTION", "LOW_CONGESTION"
    cases = [
        (160.0, 25.0, 85.0, high), (130.0, 35.0, 75.0, moderate), (80.0, 55.0, 45.0, None),
        (0.0, 29.9, 0.0, high), (0.0, 30.0, 0.0, moderate), (0.0, 39.9, 0.0, moderate), (0.0, 40.0, 0.0, low),
        (0.0, 49.9, 0.0, low), (0.0, 50.0, 0.0, None),
        (0.0, 90.0, 80.1, high), (0.0, 90.0, 80.0, moderate), (0.0, 90.0, 70.0, low), (0.0, 90.0, 60.0, None),
        (150.1, 90.0, 0.0, high), (150.0, 90.0, 0.0, moderate), (120.0, 90.0, 0.0, low), (100.0, 90.0, 0.0, None),
        (None, None, None, None), (None, None, 81.0, high), (101.0, None, None, low),
    ]
    frame = spark.createDataFrame(cases, "v double, s double, o double, want string")
    kind = rules.alert_type(F.col("v"), F.col("s"), F.col("o"))
    got = frame.withColumn("got", kind)
    assert got.filter(~F.col("got").eqNullSafe(F.col("want"))).collect() == []
    known = got.filter("got is not null").select(
        "got", rules.alert_severity(F.col("got")), rules.escalation_seconds(F.col("got"))).distinct()
    assert {tuple(r) for r in known.collect()} == {(high, "HIGH", 300), (moderate, "MEDIUM", 600), (low, "LOW", 900)}


def test_periods(spark):
    hours = spark.range(24).select(F.col("id").cast("int").alias("h"))
    got = {r.h: (r.d, r.r) for r in hours.select(
        "h", rules.day_period(F.col("h")).alias("d"), rules.rush_period(F.col("h")).alias("r")).collect()}
    assert [h for h in got if got[h][0] == "Heures de pointe matin"] == [6, 7, 8, 9]
    assert [h for h in got if got[h][0] == "Pleine journée"] == list(range(10, 16))
    assert [h for h in got if got[h][0] == "Heures de pointe soir"] == [16, 17, 18, 19]
    assert [h for h in got if got[h][0] == "Soirée"] == [20, 21, 22, 23]
    assert [h for h in got if got[h][0] == "Nuit"] == [0, 1, 2, 3, 4, 5]
    assert [h for h in got if got[h][1] == "Heure de pointe matin"] == [7, 8, 9]
    assert [h for h in got if got[h][1] == "Pause déjeuner"] == [12, 13, 14]
    assert [h for h in got if got[h][1] == "Heure de pointe soir"] == [16, 17, 18, 19]


def test_zone_status_target_and_intervention(spark):
    cases = [
        ("Élevé", "Critique", "Zone Critique - Action Immédiate"), ("Élevé", "Élevé", "Zone Critique - Action Immédiate"),
        ("Élevé", "Faible", "Zone à Surveiller"), ("Faible", "Élevé", "Zone à Surveiller"),
        ("Moyen", "Modéré", "Zone Normale"), (None, None, "Zone Normale"), (None, "Critique", "Zone à Surveiller"),
    ]
    frame = spark.createDataFrame(cases, "t string, c string, want string")
    assert frame.filter(rules.zone_status(F.col("t"), F.col("c")) != F.col("want")).count() == 0

    targets = spark.createDataFrame(
        [(29.9, 0.0, 1.0), (30.0, 70.0, 0.0), (30.0, 70.1, 1.0), (None, 71.0, 1.0), (None, None, 0.0)],
        "s double, o double, want double")
    assert targets.filter(rules.congestion_target(F.col("s"), F.col("o")) != F.col("want")).count() == 0

    levels = spark.createDataFrame([("Élevé",), ("Modéré",), ("Critique",), (None,)], "c string")
    got = [tuple(r) for r in levels.select(*[rules.intervention(F.col("c"), i) for i in range(3)]).collect()]
    assert got == [("RED: URGENT", 3, "Immediate"), ("ORANGE: ATTENTION", 2, "Under 30min"),
                   ("GREEN: NORMAL", 1, "Monitoring"), ("GREEN: NORMAL", 1, "Monitoring")]


def test_guarded_ratio(spark):
    frame = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (10.0, -1.0), (10.0, None), (None, 4.0)], "a double, b double")
    got = [r[0] for r in frame.select(numbers.guarded_ratio(F.col("a"), F.col("b"), 2)).collect()]
    assert got == [2.5, 0.0, 0.0, 0.0, None]
