"""KPI states by batch against the tables of all events."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from roadflux.operators import kpis
from roadflux.plans import increments, jobs
from roadflux.sources.tables import as_kpi_input
from verification import fixtures as fx


def close(got, want):
    """Equal but for the last bits of doubles; the sort puts measures last, keys first."""
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(want.columns, key=lambda c: (dict(want.dtypes)[c] == "double", c))
    for g, w in zip(rows(got.select(*columns)), rows(want.select(*columns)), strict=True):
        assert [x for x in g if not isinstance(x, float)] == [x for x in w if not isinstance(x, float)]
        assert [x for x in g if isinstance(x, float)] == pytest.approx([x for x in w if isinstance(x, float)], rel=1e-9)


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    """With a zone and a road that are missing, and a zone of a single reading."""
    made = fx.traffic(spark, sf_dir).withColumns({
        "zone": F.when(F.col("event_id") % 50 == 0, None).when(F.col("event_id") == 3, "Seule").otherwise(F.col("zone")),
        "road_id": F.when(F.col("event_id") % 70 == 0, None).otherwise(F.col("road_id")),
        # large means, small deviations: sums of squares would lose them
        "average_speed": F.col("average_speed") + 1e7})
    return made.cache()


def test_parts_add_up_in_any_order(spark, events, tmp_path):
    store = str(tmp_path / "states")
    for n in (2, 0, 1):
        increments.add(events.filter(F.col("event_id") % 3 == n), store, n)
    want = {"trafic_par_zone": kpis.zone_traffic(as_kpi_input(events)), "vitesse_moyenne": kpis.zone_speed(as_kpi_input(events)),
            "taux_congestion": kpis.zone_congestion_levels(as_kpi_input(events)), "evolution_trafic": kpis.temporal_evolution(as_kpi_input(events)),
            **jobs.processed_tables(jobs.road_hours(events))}
    for step in range(3):
        got = increments.kpi_tables(increments.states(spark, store))
        for name, table in want.items():
            close(got[name], table)
        assert set(got) == set(increments.LAYOUT)
        assert increments.fold(spark, store) == 2
        if step == 1:
            with pytest.raises(ValueError, match="folded"):
                increments.add(events, store, 2)


def test_replays_and_folds(spark, events, tmp_path):
    store = str(tmp_path / "states")
    halves = [events.filter(F.col("event_id") % 2 == n) for n in (0, 1)]
    increments.add(halves[0], store, 0)
    held = increments.states(spark, store)
    increments.fold(spark, store)
    for _ in range(2):
        increments.add(halves[1], store, 5)
    assert increments.states(spark, store).agg(F.sum("n")).first()[0] == events.count()
    assert held.agg(F.sum("n")).first()[0] == halves[0].count()  # listed before the fold, read after it
    # A batch that was not finished does not count.
    (tmp_path / "states" / "batches" / "batch=6").mkdir()
    assert increments.fold(spark, store) == 5
    increments.add(events.filter("false"), store, 6)
    assert increments.fold(spark, store) == 6
    assert increments.states(spark, store).agg(F.sum("n")).first()[0] == events.count()
    paths = increments.write_tables(spark, store, str(tmp_path / "tables"))
    assert set(paths) == set(increments.LAYOUT)
    assert spark.read.parquet(paths["hourly_analysis"]).agg(F.sum("event_count")).first()[0] == events.count()


def test_no_batches(spark, tmp_path):
    assert increments.fold(spark, str(tmp_path)) == -1
    with pytest.raises(ValueError, match="no batches"):
        increments.states(spark, str(tmp_path))
