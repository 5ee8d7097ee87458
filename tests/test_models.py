import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import Observation, functions as F

from conftest import rows
from roadflux import workspace
from roadflux.operators import anomalies, features
from roadflux.plans import jobs, models
from verification import fixtures as fx


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return workspace.written(features.feature_table(fx.traffic(spark, sf_dir)), "test-features")


def test_split_does_not_depend_on_partitions(table):
    train, test = models.split(table, 80)
    again, _ = models.split(table.repartition(7), 80)
    assert rows(train.select("event_id")) == rows(again.select("event_id"))
    assert train.count() + test.count() == table.count()
    assert 0.7 < train.count() / table.count() < 0.9


def test_regression_learns_a_line(spark):
    rng = random.Random(2)
    start, data = dt.datetime(2024, 1, 1), []
    for i in range(1500):
        data.append((f"S{i}", f"R{i % 5}", "rue", f"Z{i % 3}", 50 + i // 15 + rng.randrange(3),
                     30.0 + rng.randrange(8) / 4, 10.0 + rng.randrange(8) / 4, start + dt.timedelta(minutes=i)))
    events = spark.createDataFrame(data, "sensor_id string, road_id string, road_type string, zone string, "
                                   "vehicle_count bigint, average_speed double, occupancy_rate double, event_time timestamp_ntz")
    table = workspace.written(features.feature_table(events), "line")
    trained = models.train_traffic(table)
    assert trained.scores["r2"] > 0.9 and trained.scores["mae"] <= trained.scores["rmse"]
    hourly = workspace.written(features.feature_table(features.hourly_series(events)), "hourly-line")
    start = models.forecast_start(events)
    newest = events.groupBy("road_id", "zone").agg(F.date_trunc("hour", F.max("event_time")).cast("timestamp_ntz").alias("t"))
    assert rows(start.select("road_id", "zone", "event_time")) == rows(newest)
    ahead = models.forecast(start, models.train_traffic(hourly), models.train_speed(hourly)).collect()
    assert {(r.zone, r.prediction_horizon_hours) for r in ahead} == {(f"Z{z}", h) for z in range(3) for h in (1, 2)}
    first = {r.zone: r.prediction_timestamp for r in ahead if r.prediction_horizon_hours == 1}
    assert all(r.prediction_timestamp - first[r.zone] == dt.timedelta(hours=1) for r in ahead if r.prediction_horizon_hours == 2)


def test_congestion_model_beats_the_majority(table):
    trained = models.train_congestion(table)
    matrix = {(r[0], r[1]): r[2] for r in models.confusion_matrix(trained.predictions).collect()}
    assert sum(matrix.values()) == trained.scores["rows"]
    right = sum(n for (a, b), n in matrix.items() if a == b)
    assert trained.scores["accuracy"] == pytest.approx(right / trained.scores["rows"])


def test_congestion_model_scores_in_a_session_that_observed_something(spark, table):
    counted = Observation("seen")
    spark.range(5).observe(counted, F.count("*").alias("n")).collect()
    assert counted.get["n"] == 5
    trained = models.train_congestion(table)
    assert not trained.model.stages[-1].hasSummary
    assert trained.predict(table, "congestion_prediction").filter("congestion_prediction IS NOT NULL").count() > 0


def test_congestion_training_reads_the_table_twice_and_the_forest_is_that_of_the_plain_pipeline(spark, table):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    kept = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    trained = models.train_congestion(table.mapInPandas(counted, table.schema))
    assert read.value == 2 * table.count()  # for the category index and for the encoded rows
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == kept
    assert trained.scores["rows"] > 0 and read.value == 3 * table.count()
    assert trained.scores["accuracy"] > 0 and read.value == 3 * table.count()

    estimator = RandomForestClassifier(featuresCol="features", labelCol="congestion_target", predictionCol="congestion_prediction",
                                       numTrees=50, maxDepth=10, seed=models.SEED)
    known = models.split(table, 70)[0].dropna(subset=[*models.CONGESTION_FEATURES, "congestion_target"])
    plain = models._pipeline(models.CONGESTION_FEATURES, estimator).fit(known)
    trees = lambda model: [t.toDebugString.split("\n", 1)[1] for t in model.stages[-1].trees]
    assert trees(models.train_congestion(table).model) == trees(plain)


def test_forest_trains_in_even_tasks_of_bounded_size(spark, table, monkeypatch):
    sizes, fit = [], RandomForestClassifier.fit

    def watched(self, rows, *rest):
        sizes.append([r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()])
        return fit(self, rows, *rest)

    monkeypatch.setattr(RandomForestClassifier, "fit", watched)
    known = models.split(table, 70)[0].dropna(subset=[*models.CONGESTION_FEATURES, "congestion_target"]).count()
    monkeypatch.setattr(models, "ROWS_PER_TASK", known // 5, raising=False)  # two rounds of four cores
    # A large part and a small one.
    lopsided = table.filter("zone <> 'Peripherie-Sud'").coalesce(1).unionByName(table.filter("zone = 'Peripherie-Sud'").coalesce(1))
    kept = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    trained = models.train_congestion(lopsided)
    assert len(sizes[0]) == 8 and sum(sizes[0]) == known
    assert max(sizes[0]) <= known // 5 and max(sizes[0]) - min(sizes[0]) <= 2
    assert trained.scores["rows"] > 0 and spark.sparkContext._jsc.sc().getPersistentRDDs().size() == kept
    trees = lambda model: [t.toDebugString.split("\n", 1)[1] for t in model.stages[-1].trees]
    assert trees(models.train_congestion(lopsided).model) == trees(trained.model)

    given = spark.range(1001).coalesce(1)
    monkeypatch.setattr(models, "ROWS_PER_TASK", 1001)
    assert models.spread(given, 1001, ["id"]) is given
    assert rows(models.spread(given.union(given), 2002, ["id"])) == rows(given.union(given))  # repeated rows stay


def test_usual_path_lengths():
    assert anomalies.usual_path(1) == 0.0 and anomalies.usual_path(2) == 1.0
    assert anomalies.usual_path(256) == pytest.approx(10.244770, abs=1e-5)


@pytest.fixture(scope="module")
def crowd(spark):
    rng = np.random.default_rng(0)
    data = [(i, *map(float, rng.normal([100, 50, 20], [10, 5, 3])), int(rng.integers(24)), int(rng.integers(1, 8)))
            for i in range(3000)]
    data += [(3000 + i, 900.0 + i, 1.0, 99.0, 3, 1) for i in range(5)]
    data += [(4000, None, 1.0, 1.0, 1, 1)]
    return spark.createDataFrame(data, "id int, vehicle_count double, average_speed double, occupancy_rate double, hour int, day_of_week int")


def test_outliers_score_lowest(crowd):
    forest = anomalies.fit(crowd)
    assert forest.feature.shape[0] == 100 and forest.sample == 256
    flagged = anomalies.flag(anomalies.score(crowd, forest)).cache()
    assert flagged.count() == 3006 and flagged.filter("anomaly_score is null and is_anomaly is null").count() == 1
    worst = [r.id for r in flagged.orderBy(F.asc_nulls_last("anomaly_score")).limit(5).collect()]
    assert set(worst) == set(range(3000, 3005))
    share = anomalies.anomaly_share(flagged).first()
    assert 8.0 <= share.percent <= 10.5 and share.rows == 3005
    assert anomalies.most_severe(flagged).count() == 10
    bounds = flagged.agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
    assert -1.0 <= bounds[0] < bounds[1] < 0.0


def test_forest_does_not_depend_on_partitions(crowd):
    a, b = anomalies.fit(crowd), anomalies.fit(crowd.repartition(9))
    assert np.array_equal(a.feature, b.feature) and np.allclose(a.threshold, b.threshold)


def test_samples_are_full_and_distinct(crowd):
    data = anomalies.complete(crowd)
    sizes = anomalies.tree_samples(data, data.count()).groupBy("tree").count().collect()
    assert len(sizes) == 100 and {r["count"] for r in sizes} == {256}


def test_prediction_job_writes_four_tables(spark, sf_dir):
    paths = jobs.predict(fx.traffic(spark, sf_dir), workspace.fresh_path(spark, "predictions"))
    assert set(paths) == {"traffic_predictions", "congestion_predictions", "anomalies_detected", "route_recommendations"}
    assert all(spark.read.parquet(p).count() > 0 for p in paths.values())


def test_ranked_value_is_exact(spark, monkeypatch):
    monkeypatch.setattr(anomalies, "FEW", 3)
    rng = random.Random(4)
    for data in ([rng.gauss(0, 1) for _ in range(700)], [1.0] * 50, [0.0] * 300 + [rng.random() for _ in range(90)], [2.5], [1e-300, 1e300] * 9):
        frame = spark.createDataFrame([(v,) for v in data] + [(None,)], "v double").cache()
        for share in (0.1, 0.5, 1.0):
            assert anomalies.ranked_value(frame, "v", share) == sorted(data)[max(1, -(-len(data) * int(share * 10) // 10)) - 1]
    assert anomalies.ranked_value(frame.limit(0), "v", 0.1) is None


def test_rows_without_an_input_keep_a_null_prediction(spark, sf_dir, table):
    trained = models.train_traffic(table)
    lost = trained.predictions.filter("average_speed is null or occupancy_rate is null")
    assert lost.count() > 0 and lost.filter("predicted_vehicle_count is not null").count() == 0
    assert trained.predictions.count() == models.split(table, 80)[1].count()
