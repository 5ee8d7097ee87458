import pytest
from pyspark.sql import functions as F

from conftest import rows
from roadflux import workspace
from roadflux.operators import kpis
from roadflux.plans import jobs, marts, reports
from roadflux.schema import SERVING
from roadflux.sinks import catalog, files, messages, serving
from roadflux.sources import tables
from verification import fixtures as fx


@pytest.fixture(scope="module")
def processed(spark, sf_dir):
    base = workspace.fresh_path(spark, "processed")
    jobs.build_processed(fx.traffic(spark, sf_dir), base)
    return base


def test_rollup_equals_direct_aggregates(spark, sf_dir, processed):
    events = fx.traffic(spark, sf_dir)
    direct = {"traffic_by_zone": kpis.zone_hour_traffic(events), "speed_by_road": kpis.road_speed(events),
              "congestion_by_zone": kpis.zone_congestion(events), "hourly_analysis": kpis.hourly_zone(events)}
    for name, frame in tables.processed_zone(spark, processed).items():
        assert rows(frame.select(*direct[name].columns)) == rows(direct[name]), name


def test_counts_agree_between_tables(spark, sf_dir):
    events = fx.traffic(spark, sf_dir)
    total = events.count()
    assert kpis.zone_hour_traffic(events).agg(F.sum("event_count")).first()[0] == total
    assert kpis.road_speed(events).agg(F.sum("measurement_count")).first()[0] == total
    assert kpis.hourly_zone(events).agg(F.sum("event_count")).first()[0] == total
    assert kpis.zone_congestion(events).agg(F.sum("total_events")).first()[0] == total


def test_read_back(spark, tmp_path):
    frame = spark.range(20).select("id", (F.col("id") % 4).alias("p"))
    files.write_table(frame, str(tmp_path / "t"), ["p"])
    assert tuple(files.read_back(spark, str(tmp_path / "t"), ["p"]).first()) == (20, 4)
    assert "processed_at" in spark.read.parquet(str(tmp_path / "t")).columns
    files.write_table(frame.limit(3), str(tmp_path / "t"), stamp=False)
    assert tuple(files.read_back(spark, str(tmp_path / "t")).first()) == (3, 1)


def test_one_partition_value_stays_in_few_files(spark, tmp_path):
    frame = spark.range(0, 4000, 1, 16).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("p"))
    files.write_table(frame, str(tmp_path / "t"), ["p"])
    names = [p for p in (tmp_path / "t").glob("p=*/*.parquet")]
    assert len(names) <= 7 * 2


def test_catalog(spark, processed):
    paths = {name: f"{processed}/{name}" for name in files.PROCESSED_LAYOUT}
    assert catalog.register_all(spark, paths) == list(paths)
    assert {r.tableName for r in catalog.listed(spark).collect()} >= set(paths)
    assert "zone" in [r.col_name for r in catalog.described(spark, "speed_by_road").collect()]
    assert catalog.sample_row(spark, "speed_by_road").count() == 1
    assert spark.table("traffic_by_zone").count() == spark.read.parquet(paths["traffic_by_zone"]).count()


def test_analytics_tables(spark, processed):
    paths = jobs.build_analytics(spark, processed, workspace.fresh_path(spark, "analytics"))
    views = {name: spark.read.parquet(path) for name, path in paths.items()}
    assert set(views) == set(files.ANALYTICS_LAYOUT)
    row = views["tableau_bord_executif"].first()
    assert row.titre_rapport == "Rapport Trafic Urbain" and row.total_vehicules_jour > 0
    assert jobs.publish_catalog(spark, paths) == list(paths)
    assert spark.table("analyse_temporelle").count() == 24


def test_empty_overview_is_zero(spark, sf_dir):
    row = marts.executive_overview_from_events(fx.traffic(spark, sf_dir).filter("false")).first()
    assert (row.taux_congestion_moyen, row.vitesse_moyenne_globale, row.total_vehicules_jour, row.zones_surveillees) == (0.0, 0.0, 0, 0)


def test_ingest_job(spark, sf_dir):
    lines, base = workspace.fresh_path(spark, "raw"), workspace.fresh_path(spark, "processed")
    fx.raw_lines(spark, sf_dir).select("value").write.text(lines)
    jobs.ingest(spark, lines, base)
    accepted = fx.traffic(spark, sf_dir).filter("event_type in ('view', 'click', 'purchase')").count()
    assert spark.read.parquet(f"{base}/speed_by_road").agg(F.sum("measurement_count")).first()[0] == accepted
    counts = spark.read.parquet(f"{base}/ingest_counts").first()
    assert counts.accepted == accepted
    assert spark.read.parquet(f"{base}/rejects").count() == counts.raw_lines - accepted > 0


def test_ingest_without_rejects_or_lines(spark, tmp_path):
    sound = '{"sensor_id":"S","road_id":"R","road_type":"rue","zone":"Z","vehicle_count":5,"average_speed":50.0,"occupancy_rate":1.0,"event_time":"2024-01-01T00:00:00"}'
    for lines in ([sound] * 3, []):
        source = workspace.fresh_path(spark, "raw")
        spark.createDataFrame([(x,) for x in lines], "value string").write.text(source)
        paths = jobs.ingest(spark, source, workspace.fresh_path(spark, "processed"))
        assert spark.read.schema("value string, reject_reason string").parquet(paths["rejects"]).count() == 0
        counts = spark.read.parquet(paths["ingest_counts"]).first()
        assert (counts.raw_lines, counts.accepted) == (len(lines), len(lines))


def test_serving_types(spark, sf_dir):
    for name, frame in jobs.second_family(fx.traffic(spark, sf_dir)).items():
        narrow = serving.for_serving(frame, name)
        assert dict(narrow.dtypes) == SERVING[name]
    with pytest.raises(Exception):
        serving.for_serving(spark.range(1), "trafic_par_zone").collect()


def test_jdbc_options():
    assert serving.jdbc_options("jdbc:x", "t", {"user": "u"}) == {"url": "jdbc:x", "dbtable": "t", "user": "u"}


def test_merge_into_stored_table(spark, tmp_path):
    old, new = str(tmp_path / "v1"), str(tmp_path / "v2")
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int").write.parquet(old)
    incoming = spark.createDataFrame([("b", 5), ("c", 6)], "k string, x int")
    merged = serving.merge_table(spark, old, new, incoming, ["k"])
    assert rows(merged) == [("a", 1), ("b", 5), ("c", 6)]
    assert rows(spark.read.parquet(old)) == [("a", 1), ("b", 2)]


def test_reports(spark, sf_dir, tmp_path):
    analysis = marts.congestion_analysis(kpis.zone_congestion(fx.traffic(spark, sf_dir)))
    worst = reports.most_congested(analysis)
    files.write_report_text(worst, "ZONES CRITIQUES", str(tmp_path / "text"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "text")).collect()]
    assert lines[0] == "ZONES CRITIQUES" and lines[1].startswith("zone | ") and len(lines) == 2 + worst.count()
    assert [line.split(" | ")[0] for line in lines[2:]] == [r.zone for r in worst.collect()]
    files.write_report_json(worst, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == worst.count()


def test_messages(spark, sf_dir):
    event = fx.traffic(spark, sf_dir).withColumn("zone", F.lit(None).cast("string"))
    got = messages.keyed(event).filter(F.col("value").contains('"average_speed":null')).first()
    assert got.key == "default" and '"zone":null' in got.value


def test_views(spark, processed):
    stored = {n: f.drop("processed_at") for n, f in tables.processed_zone(spark, processed).items()}
    strategic = marts.strategic_zones(stored["traffic_by_zone"])
    analysis = marts.congestion_analysis(stored["congestion_by_zone"])
    names = reports.create_views(strategic, analysis, marts.hourly_analysis(stored["hourly_analysis"]))
    assert names == ["dashboard_principal", "analyse_par_heure", "alertes_congestion"]
    assert spark.sql("SELECT count(*) FROM dashboard_principal").first()[0] == strategic.count()
    assert [r.hour for r in spark.sql("SELECT hour FROM analyse_par_heure").collect()] == list(range(24))
    assert spark.sql("SELECT min(congestion_rate_percent) > 30 FROM alertes_congestion").first()[0]
