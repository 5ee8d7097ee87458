"""Malformed lines, time spellings, reject reasons."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from roadflux.functions import text, timeparts
from roadflux.sources import raw, tables
from roadflux.streaming import landing

GOOD = ('{"sensor_id":"S1","road_id":"R1","road_type":"rue","zone":"Z1","vehicle_count":12,'
        '"average_speed":31.25,"occupancy_rate":null,"event_time":"2024-01-01T00:00:07.179575"}')


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize("line,want", [
    ("{a: b}", {"a": "b"}),
    ("{a: 1, b: -2.5, c: .5}", None),  # .5 counts as a number but is not JSON
    ("{a: 1, b: -2.5}", {"a": 1, "b": -2.5}),
    ("{a: 1e5}", {"a": "1e5"}),
    ("{a: true, b: false, c: null}", {"a": True, "b": False, "c": None}),
    ('{a: "12"}', {"a": "12"}),
    ('{"a": x y}', {"a": "x y"}),
    ("{t: 2024-01-01T00:00:07}", {"t": "2024-01-01T00:00:07"}),
    ("  {a: b}  ", {"a": "b"}),
    ("{a: b, junk, c: d}", {"a": "b", "c": "d"}),
    ('{a: x"y}', None),
    ("{a: 007}", None),
    ("corrupt 12", None),
    ("[1]", None),
    ("", None),
    ("{}", None),
    (None, None),
])
def test_repair(spark, line, want):
    got = lines(spark, line).select(raw.repaired_json(F.col("value"))).first()[0]
    assert (json.loads(got) if got is not None else None) == want


def test_sound_lines_are_not_repaired(spark):
    line = GOOD.replace('"Z1"', '"Z1, north"')
    got = raw.parse_lines(lines(spark, line)).first()
    assert got.zone == "Z1, north" and got.vehicle_count == 12 and got.occupancy_rate is None
    assert got.event_time == dt.datetime(2024, 1, 1, 0, 0, 7, 179575)


def test_fields_of_the_wrong_type_are_null(spark):
    got = raw.parse_lines(lines(
        spark, GOOD.replace(":12,", ':"12",'), GOOD.replace(":12,", ":1.5,"), GOOD.replace("31.25", '"fast"')
    )).collect()
    assert [r.vehicle_count for r in got] == [None, None, 12]
    assert [r.average_speed for r in got] == [31.25, 31.25, None]
    assert all(r.sensor_id == "S1" for r in got)


def test_every_line_is_accounted_for(spark):
    frame = lines(spark, GOOD, "   ", "", None, "corrupt 1", GOOD.replace("2024-01-01T00:00:07.179575", "n/a"),
                  "{zone: Z2, event_time: 2024-01-01 10:00:00}", '{"zone": "Z3"}', "[1]")
    got = {r.value: r.reject_reason for r in raw.audited_events(frame).collect()}
    assert got[GOOD] is None and got["{zone: Z2, event_time: 2024-01-01 10:00:00}"] is None
    assert got["   "] == got[""] == got[None] == "blank"
    assert got["corrupt 1"] == got["[1]"] == "bad_json"
    assert got['{"zone": "Z3"}'] == "bad_time"
    counts = raw.stage_counts(frame).first().asDict()
    assert counts == {"raw_lines": 9, "non_blank": 6, "converted": 4, "accepted": 2, "bad_time": 2}
    assert raw.parse_lines(frame).count() + raw.rejected_lines(frame).count() == 9


def test_regex_repair(spark):
    got = lines(spark, "{zone: Z-1, count: 12}", "nothing").select(raw.regex_repaired_json(F.col("value"))).collect()
    assert json.loads(got[0][0]) == {"zone": "Z-1", "count": "12"} and got[1][0] is None


@pytest.mark.parametrize("spelling,event_time,second", [
    ("2024-03-05T06:07:08.123456", dt.datetime(2024, 3, 5, 6, 7, 8, 123456), dt.datetime(2024, 3, 5, 6, 7, 8)),
    ("2024-03-05T06:07:08.12", dt.datetime(2024, 3, 5, 6, 7, 8, 120000), dt.datetime(2024, 3, 5, 6, 7, 8)),
    ("2024-03-05T06:07:08", dt.datetime(2024, 3, 5, 6, 7, 8), dt.datetime(2024, 3, 5, 6, 7, 8)),
    ("2024-03-05 06:07:08", dt.datetime(2024, 3, 5, 6, 7, 8), dt.datetime(2024, 3, 5, 6, 7, 8)),
    ("2024-03-05 06:07:08.5", None, None),
    ("2024-13-05 06:07:08", None, None),
    ("n/a", None, None), ("", None, None), (None, None, None),
])
def test_times(spark, spelling, event_time, second):
    frame = spark.createDataFrame([(spelling,)], "t string")
    assert tuple(frame.select(
        timeparts.parse_event_time(F.col("t")), timeparts.parse_to_second(F.col("t"))).first()) == (event_time, second)


def test_parquet_or_fallback(spark, tmp_path):
    other = spark.range(3)
    assert raw.parquet_or(spark, str(tmp_path / "none"), lambda: other).count() == 3
    spark.range(5).write.parquet(str(tmp_path / "some"))
    assert raw.parquet_or(spark, str(tmp_path / "some"), lambda: other).count() == 5


def test_strict_read_drops_bad_lines_and_recurses(spark, tmp_path):
    lines(spark, GOOD, "{zone: Z}").coalesce(1).write.text(str(tmp_path / "raw" / "date=2024-01-01" / "zone=Z1"))
    got = raw.strict_json(spark, str(tmp_path / "raw")).collect()
    assert len(got) == 1 and got[0].vehicle_count == 12.0


def test_text_repairs(spark):
    frame = spark.createDataFrame(
        [("Centre Ville-Nord",), ("P�riph�rie_Nord",), ("Peripherie-Sud",), ("Quartier_R�sidentiel",), ("Caf�",), (None,)],
        "z string")
    got = [tuple(r) for r in frame.select(
        text.path_safe(F.col("z")), text.restore_accents(F.col("z")), text.repair_zone_by_pattern(F.col("z")),
        text.repair_zone_exactly(F.col("z")), text.canonical_zone(F.col("z"))).collect()]
    assert got == [
        ("Centre_Ville_Nord", "Centre Ville-Nord", "Centre Ville-Nord", "Centre Ville-Nord", "Centre_Ville_Nord"),
        ("P�riph�rie_Nord", "Périphérie_Nord", "Périphérie_Nord", "Périphérie_Nord", "Périphérie_Nord"),
        ("Peripherie_Sud", "Peripherie-Sud", "Périphérie_Sud", "Peripherie-Sud", "Périphérie_Sud"),
        ("Quartier_R�sidentiel", "Quartier_Résidentiel", "Quartier_Résidentiel", "Quartier_Résidentiel", "Quartier_Résidentiel"),
        ("Caf�", "Café", "Café", "Caf�", "Café"),
        (None, None, None, None, None),
    ]
    labels = spark.createDataFrame([("�lev�",), ("Mod�r�",), ("Critique",), ("Faible",), ("Élevé",), ("�",), (None,)], "l string")
    got = [tuple(r) for r in labels.select(text.repair_congestion_label(F.col("l")), text.repair_traffic_label(F.col("l"))).collect()]
    assert got == [("Élevé", "Élevé"), ("Modéré", "Mod�r�"), ("Critique", "Critique"), ("Faible", "Faible"),
                   ("Élevé", "Élevé"), ("Faible", "�"), (None, None)]


def test_landing_rows(spark):
    got = [tuple(r) for r in landing.landing_rows(lines(
        spark, GOOD.replace("Z1", "Zone A-1"), GOOD.replace("2024-01-01T00:00:07.179575", "n/a"), "junk")).collect()]
    assert [r[:2] for r in got] == [("2024-01-01", "Zone_A_1"), ("quarantine", "Z1"), ("quarantine", "Unknown")]
    assert got[2][2] == "junk"


def test_coordinates_join_after_canonical_names(spark):
    known = tables.zone_coordinates(spark)
    assert known.count() == 8
    spelled = spark.createDataFrame([("Peripherie-Nord",), ("Quartier-Residentiel",), ("Zone-Industrielle",)], "zone string")
    assert known.join(spelled.select(text.canonical_zone(F.col("zone")).alias("zone")), "zone").count() == 3
