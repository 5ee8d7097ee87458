"""Forecast and classification models over the feature table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Observation, functions as F

from roadflux.functions.timeparts import with_calendar
from roadflux.operators import features

CATEGORIES = ["road_type", "zone"]
CALENDAR = ["hour", "day_of_week", "month"]
CURRENT = ["vehicle_count", "average_speed", "occupancy_rate"]
# The feature columns of both models.
TRAFFIC_FEATURES = [
    *CALENDAR, *CURRENT,
    "vehicle_count_lag1", "vehicle_count_lag2", "speed_lag1", "speed_lag2", "occupancy_lag1", "occupancy_lag2",
    "vehicle_count_ma3", "speed_ma3", "occupancy_ma3", "vehicle_count_std3", "speed_std3",
]
CONGESTION_FEATURES = [
    *CALENDAR, *CURRENT,
    "vehicle_count_lag1", "speed_lag1", "occupancy_lag1", "vehicle_count_ma3", "speed_ma3", "occupancy_ma3",
]
SEED = 42
# Training rows a task of the forest holds; each has its own statistics of all open nodes, so that more tasks cost more.
ROWS_PER_TASK = 1_000_000
MODEL_VERSION = "v1.0"


@dataclass
class Trained:
    model: PipelineModel
    inputs: list[str]
    predictions: DataFrame  # of the rows held back; NULL for rows that lack an input
    measured: DataFrame  # one row, over these predictions

    @cached_property
    def scores(self) -> dict[str, float]:
        """Predicts the rows held back; who does not ask is spared that."""
        return self.measured.first().asDict()

    def predict(self, rows: DataFrame, prediction: str) -> DataFrame:
        return predicted(self.model, rows, self.inputs, prediction)


def predicted(model: PipelineModel, rows: DataFrame, inputs: list[str], prediction: str) -> DataFrame:
    """All rows with ``prediction``; a row that lacks an input stays, with NULL."""
    whole = F.lit(True)
    for c in inputs:
        whole = whole & F.col(c).isNotNull()
    # The model sees every row once: missing inputs count as zero there, and their outcome is dropped.
    shadow = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in inputs}
    kept = F.struct(*[F.col(c) for c in inputs]).alias("_inputs")
    made = [*[f"{c}_index" for c in CATEGORIES], *[f"{c}_vec" for c in CATEGORIES], "features", "rawPrediction", "probability"]
    scored = model.transform(rows.select("*", kept, whole.alias("_whole")).withColumns(shadow))
    out = scored.withColumn(prediction, F.when(F.col("_whole"), F.col(prediction)))
    return out.withColumns({c: F.col(f"_inputs.{c}") for c in inputs}).drop("_inputs", "_whole", *made)


def category_stages() -> list:
    """Index by falling frequency, then one-hot; unseen values get a slot of their own."""
    indexed = [f"{c}_index" for c in CATEGORIES]
    return [
        StringIndexer(inputCols=CATEGORIES, outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_vec" for c in CATEGORIES]),
    ]


def encode_categories(rows: DataFrame) -> DataFrame:
    return Pipeline(stages=category_stages()).fit(rows).transform(rows)


def split(rows: DataFrame, train_percent: int, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Training and held-back rows, told apart by a hash of what identifies a reading.

    Unlike a random draw, recomputing a lost partition cannot move a row to the
    other side.
    """
    moment = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    identity = F.md5(F.concat_ws("|", F.lit(str(seed)), "sensor_id", "road_id", "zone", moment).cast("binary"))
    bucket = F.conv(F.substring(identity, 1, 8), 16, 10).cast("long") % 100
    return rows.filter(bucket < train_percent), rows.filter(bucket >= train_percent)


def _pipeline(columns: list[str], estimator) -> Pipeline:
    inputs = [*columns, *[f"{c}_vec" for c in CATEGORIES]]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")
    return Pipeline(stages=[*category_stages(), assembler, estimator])


def regression_scores(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """rmse, mae and r2 in one pass, over the rows that have a prediction."""
    error = F.col(label) - F.col(prediction)
    return predictions.agg(
        F.count(error).alias("rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(F.when(error.isNotNull(), F.col(label))))).alias("r2"),
    )


def train_regression(features: DataFrame, label: str, prediction: str) -> Trained:
    train, test = split(features, 80)
    # The estimator's settings.
    estimator = LinearRegression(
        featuresCol="features", labelCol=label, predictionCol=prediction,
        maxIter=100, regParam=0.1, elasticNetParam=0.1,
    )
    model = _pipeline(TRAFFIC_FEATURES, estimator).fit(train.dropna(subset=[*TRAFFIC_FEATURES, label]))
    predictions = predicted(model, test, TRAFFIC_FEATURES, prediction)
    return Trained(model, TRAFFIC_FEATURES, predictions, regression_scores(predictions, label, prediction))


def train_traffic(features: DataFrame) -> Trained:
    return train_regression(features, "vehicle_count_target", "predicted_vehicle_count")


def train_speed(features: DataFrame) -> Trained:
    return train_regression(features, "speed_target", "predicted_speed")


def spread(rows: DataFrame, count: int, first: list[str]) -> DataFrame:
    """Even tasks for jobs that go over the same rows many times: as many for each core, none above ``ROWS_PER_TASK``.

    The files of a table make a few more tasks than cores, or tasks too large to be held. What one task holds stays where it
    lies. Rows are dealt in turn and ordered by all columns, those of ``first`` before the rest: reruns on as many cores see the
    same rows in the same places, and rows that fall into the same nodes of a tree lie together.
    """
    if count <= ROWS_PER_TASK:
        return rows
    cores = rows.sparkSession.sparkContext.defaultParallelism
    rounds = -(-count // (cores * ROWS_PER_TASK))
    rest = [c for c in rows.columns if c not in first]
    return rows.repartition(cores * rounds).sortWithinPartitions(*first, *rest)


def train_congestion(features: DataFrame) -> Trained:
    train, test = split(features, 70)
    # The estimator's settings.
    estimator = RandomForestClassifier(
        featuresCol="features", labelCol="congestion_target", predictionCol="congestion_prediction",
        numTrees=50, maxDepth=10, seed=SEED,
    )
    *encoding, forest = _pipeline(CONGESTION_FEATURES, estimator).getStages()
    known = train.dropna(subset=[*CONGESTION_FEATURES, "congestion_target"])
    counted = Observation()
    encoder = Pipeline(stages=encoding).fit(known.observe(counted, F.count("*").alias("rows")))
    needed = known.select(*CONGESTION_FEATURES, *CATEGORIES, "congestion_target")
    taught = spread(needed, counted.get["rows"], ["average_speed", "occupancy_rate", "vehicle_count"])
    # The forest reads its rows four times before it holds them in bins. On disk, as memory is for the bins: node ids kept beside
    # them (cacheNodeIds) drove them out.
    encoded = encoder.transform(taught).select("features", "congestion_target").persist(StorageLevel.DISK_ONLY)
    try:
        fitted = forest.fit(encoded)
    finally:
        encoded.unpersist()
    # The training summary holds the session, which goes to tasks with the model and can't once the session has observed
    # anything; copies of a stage come without it.
    model = PipelineModel([stage.copy() for stage in [*encoder.stages, fitted]])
    predictions = predicted(model, test, CONGESTION_FEATURES, "congestion_prediction")
    return Trained(model, CONGESTION_FEATURES, predictions, accuracy(predictions))


def accuracy(predictions: DataFrame) -> DataFrame:
    """Over the rows that have a prediction."""
    right = (F.col("congestion_target") == F.col("congestion_prediction")).cast("double")
    return predictions.agg(F.count("congestion_prediction").alias("rows"), F.avg(right).alias("accuracy"))


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    return predictions.filter(F.col("congestion_prediction").isNotNull()).groupBy("congestion_target", "congestion_prediction").agg(F.count("*").alias("count"))


def latest_per_road(rows: DataFrame) -> DataFrame:
    """Newest row of each road and zone; partial results combine before the shuffle."""
    rest = [c for c in rows.columns if c not in ("road_id", "zone")]
    newest = rows.groupBy("road_id", "zone").agg(F.max_by(F.struct(*rest), F.col("event_time")).alias("_row"))
    return newest.select("road_id", "zone", "_row.*")


def forecast_start(events: DataFrame) -> DataFrame:
    """Newest hour of each road and zone with its past; hours that have no successor yet count too.

    Missing history stays NULL here, so that rolled statistics know how many readings they stand for.
    """
    return latest_per_road(with_calendar(features.history(features.hourly_series(events))))


MEASURES = {"vehicle_count": "vehicle_count", "speed": "average_speed", "occupancy": "occupancy_rate"}


def next_hour(rows: DataFrame) -> DataFrame:
    """The same rows one hour on, with the predictions in the place of readings.

    Occupancy is not predicted and stays. Rolling statistics move on: over the new value and the three before it.
    """
    later = F.col("event_time") + F.expr("INTERVAL 1 HOUR")
    new = {"vehicle_count": F.col("predicted_vehicle_count"), "speed": F.col("predicted_speed"), "occupancy": F.col("occupancy_rate")}
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, b: a + b)
    known = {f"_{short}": F.filter(F.array(new[short].cast("double"), F.col(name), F.col(f"{short}_lag1"), F.col(f"{short}_lag2")),
                                   lambda x: x.isNotNull()) for short, name in MEASURES.items()}
    means = {f"{short}_ma3": F.try_divide(total(F.col(f"_{short}")), F.size(f"_{short}")) for short in MEASURES}
    changes = {"event_time": later, "hour": F.hour(later), "day_of_week": F.dayofweek(later), "month": F.month(later)}
    for short, name in MEASURES.items():
        changes |= {name: new[short], f"{short}_lag1": F.col(name), f"{short}_lag2": F.col(f"{short}_lag1")}
        if short != "occupancy":
            center = F.array_repeat(f"{short}_ma3", F.size(f"_{short}"))
            apart = total(F.zip_with(f"_{short}", center, lambda x, m: (x - m) * (x - m)))
            changes[f"{short}_std3"] = F.when(F.size(f"_{short}") > 1, F.sqrt(apart / (F.size(f"_{short}") - 1)))
    return rows.withColumns(known).withColumns(means).withColumns(changes).drop(*known)


def _predict(rows: DataFrame, traffic: Trained, speed: Trained) -> DataFrame:
    """``rows`` with both predictions; NULL where a reading lacks a measure."""
    named = rows.drop("predicted_vehicle_count", "predicted_speed").withColumn("_past", F.struct(*features.FILLED))
    filled = named.fillna(0, features.FILLED)
    first = traffic.predict(filled, "predicted_vehicle_count")
    both = speed.predict(first, "predicted_speed")
    return both.withColumns({c: F.col(f"_past.{c}") for c in features.FILLED}).drop("_past")


def forecast(start: DataFrame, traffic: Trained, speed: Trained, horizons: int = 2) -> DataFrame:
    """Per zone and hour ahead: mean predictions of its roads, starting from ``forecast_start``.

    A step of the models is a step of the series they were trained on: train them on ``features.hourly_series`` for hours.
    The confidence is the traffic model's held-back r2, cut to 0..1. The prediction is stamped with the zone's newest
    hour plus the horizon.
    """
    confidence = min(max(traffic.scores["r2"] or 0.0, 0.0), 1.0)
    tables = []
    for hours in range(1, horizons + 1):
        predicted = _predict(start if hours == 1 else next_hour(predicted), traffic, speed)  # noqa: F821
        tables.append(predicted.groupBy("zone").agg(
            F.max(F.col("event_time") + F.expr("INTERVAL 1 HOUR")).alias("prediction_timestamp"),
            F.avg("predicted_vehicle_count").alias("predicted_traffic"),
            F.avg("predicted_speed").alias("predicted_speed"),
        ).withColumns({
            "confidence_score": F.lit(confidence),
            "prediction_horizon_hours": F.lit(hours),
            "model_version": F.lit(MODEL_VERSION),
        }))
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out
