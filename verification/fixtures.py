"""The supplied tables seen as road-sensor data.

Every row of ``events`` becomes one reading, every row of ``lineitem`` one flow
record. Measures are multiples of a quarter, so sums do not depend on order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadflux.operators import alerts as alert_ops, kpis
from roadflux.sources.tables import as_kpi_input

# Fixed values; a position is the index used below and in the SQL.
ZONES = [
    "Centre-Ville", "Zone-Commerciale", "Zone-Industrielle",
    "Quartier-Residentiel", "Peripherie-Nord", "Peripherie-Sud",
]
ROAD_TYPES = ["autoroute", "avenue", "rue", "boulevard"]
DIRECTIONS = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]
WINDOW = "1 hour"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(names: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), index.cast("int") + 1)


def _code(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 4, "0"))


def as_traffic(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    z = F.floor((F.col("user_id") % 100) / 4) % 6
    hour = F.hour("ts")
    rush = F.when(hour.between(7, 9) | hour.between(17, 19), 2.0).otherwise(1.0)
    crowd = F.when(z == 0, 5.0).when(z == 1, 3.0).otherwise(1.0)
    speed = 5.0 + k * ((1 + z).cast("double") / 4.0)
    occupancy = ((F.col("event_id") * 37) % 101).cast("double") * ((1 + z % 4).cast("double") / 4.0)
    return events.select(
        "event_id",
        _code("SENSOR_", 1 + F.col("event_id") % 50).alias("sensor_id"),
        _code("ROAD_", 1 + F.col("user_id") % 100).alias("road_id"),
        _pick(ROAD_TYPES, F.col("user_id") % 4).alias("road_type"),
        _pick(ZONES, z).alias("zone"),
        F.floor(F.col("value") * crowd * rush).cast("long").alias("vehicle_count"),
        F.when(F.col("event_id") % 97 != 0, speed).alias("average_speed"),
        F.when(F.col("event_id") % 89 != 0, occupancy).alias("occupancy_rate"),
        F.col("ts").alias("event_time"),
        "event_type",
    )


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_traffic(table(spark, sf_dir, "events"))


def kpi_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_kpi_input(traffic(spark, sf_dir))


def as_of(events: DataFrame) -> Column:
    """Latest moment in the data; stands in for "now"."""
    return events.agg(F.max("event_time")).scalar()


# --- raw lines ----------------------------------------------------------------
# view: JSON, micros; click: JSON, blank instead of T; purchase: bare keys and
# strings; signup: JSON with an unreadable time; error: not JSON, and a blank line.

def _line(quote: str, gap: str, stamp: Column) -> Column:
    text = lambda c: F.concat(F.lit(quote), c, F.lit(quote))
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    fields = [
        *[(c, text(F.col(c))) for c in ("sensor_id", "road_id", "road_type", "zone")],
        *[(c, number(c)) for c in ("vehicle_count", "average_speed", "occupancy_rate")],
        ("event_time", text(stamp)),
    ]
    parts = [F.concat(F.lit(f"{quote}{name}{quote}:{gap}"), value) for name, value in fields]
    return F.concat(F.lit("{"), F.concat_ws("," + gap, *parts), F.lit("}"))


def lines_of(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    stamp = lambda fmt: F.date_format("event_time", fmt)
    line = (
        F.when(kind == "view", _line('"', "", stamp("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))
        .when(kind == "click", _line('"', "", stamp("yyyy-MM-dd HH:mm:ss")))
        .when(kind == "purchase", _line("", " ", stamp("yyyy-MM-dd'T'HH:mm:ss")))
        .when(kind == "signup", _line('"', "", F.lit("n/a")))
        .otherwise(F.concat(F.lit("corrupt "), F.col("event_id").cast("string")))
    )
    lines = F.when(kind == "error", F.array(line, F.lit("   "))).otherwise(F.array(line))
    return events.select("event_id", "event_type", F.explode(lines).alias("value"))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(traffic(spark, sf_dir))


# --- flow, windows, alerts ------------------------------------------------------

def flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, order = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    joined = (
        line.join(order, line.l_orderkey == order.o_orderkey)
        .join(customer, F.col("o_custkey") == customer.c_custkey)
        .join(supplier, F.col("l_suppkey") == supplier.s_suppkey)
    )
    return joined.select(
        _code("ROAD_", 1 + F.col("l_suppkey") % 100).alias("road_id"),
        _pick(ZONES, F.col("s_nationkey") % 6).alias("from_zone"),
        _pick(ZONES, F.col("c_nationkey") % 6).alias("to_zone"),
        F.col("l_quantity").cast("long").alias("flow_volume"),
        (20.0 + ((F.col("l_partkey") * 7) % 320).cast("double") / 4.0).alias("average_speed"),
        _pick(DIRECTIONS, (F.col("s_nationkey") + 3 * F.col("c_nationkey")) % 8).alias("direction"),
        F.col("l_shipdate").alias("timestamp"),
    )


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_ops.window_metrics(traffic(spark, sf_dir), WINDOW)


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_ops.lifecycle(windows(spark, sf_dir))


# --- damaged names ----------------------------------------------------------------

def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings whose zone and label text lost accents, depending on the kind of event."""
    rows = traffic(spark, sf_dir)
    kind = F.col("event_type")
    accented = F.translate("zone", "-", "_")
    for plain, name in (("Peripherie", "Périphérie"), ("Residentiel", "Résidentiel")):
        accented = F.replace(accented, F.lit(plain), F.lit(name))
    damaged = F.replace(accented, F.lit("é"), F.lit("�"))
    zone = F.when(kind == "view", damaged).when(kind == "click", accented).otherwise(F.col("zone"))
    level = _pick(["Critique", "Élevé", "Modéré", "Faible", "�lev�", "Mod�r�"], F.col("vehicle_count") % 6)
    return rows.select("event_id", zone.alias("zone"), level.alias("label"), "vehicle_count")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.zone_snapshots(traffic(spark, sf_dir))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast rows without a model: each hour's means, foretold for the next hour."""
    hours = snapshots(spark, sf_dir)
    return hours.select(
        "zone",
        (F.col("processed_at") + F.expr("INTERVAL 1 HOUR")).alias("prediction_timestamp"),
        F.col("trafic_moyen_vehicules_heure").alias("predicted_traffic"),
        F.col("vitesse_moyenne_kmh").alias("predicted_speed"),
        F.lit(0.75).alias("confidence_score"),
        F.lit(1).alias("prediction_horizon_hours"),
        F.lit("v1.0").alias("model_version"),
    )
