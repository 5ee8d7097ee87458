"""Relative differences between zones, hours of the day and kinds of day.

Zones are compared as the caller's pairs say, each zone with one baseline by
default, so the output grows with the number of zones and not with its square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

METRICS = {"traffic_volume": "vehicle_count", "average_speed": "average_speed"}  # fixed values
PEAK_HOURS = ((7, 9), (16, 19))  # fixed values: both rush periods
MONDAY, FRIDAY = 2, 6  # as F.dayofweek numbers them


def comparison_base(events: DataFrame) -> DataFrame:
    """Sums and counts per zone, peak or not, weekday or not: four rows per zone.

    Every comparison below reads this; store it when it comes straight from events.
    """
    hour = F.hour("event_time")
    peak = F.lit(False)
    for low, high in PEAK_HOURS:
        peak = peak | hour.between(low, high)
    weekday = F.dayofweek("event_time").between(MONDAY, FRIDAY)
    totals = [f(c).alias(f"{m}_{n}") for m, c in METRICS.items() for n, f in (("sum", F.sum), ("n", F.count))]
    return events.groupBy("zone", peak.alias("peak"), weekday.alias("weekday")).agg(*totals)


def _mean(metric: str, where: Column | None = None) -> Column:
    top, bottom = F.col(f"{metric}_sum"), F.col(f"{metric}_n")
    if where is not None:
        top, bottom = F.when(where, top), F.when(where, bottom)
    return F.try_divide(F.sum(top), F.sum(bottom))


def percentage_difference(first: Column, second: Column) -> Column:
    return F.try_divide(first - second, second) * 100


def baseline_pairs(zones: DataFrame, baseline: str) -> DataFrame:
    """(baseline, other) for every other zone."""
    others = zones.select("zone").distinct().filter(F.col("zone") != baseline)
    return others.select(F.lit(baseline).alias("zone1"), F.col("zone").alias("zone2"))


def zone_metrics(base: DataFrame) -> DataFrame:
    """(zone, metric_name, value) means in long form."""
    means = base.groupBy("zone").agg(*[_mean(m).alias(m) for m in METRICS])
    return means.unpivot(["zone"], list(METRICS), "metric_name", "value")


def compare_zones(metrics: DataFrame, pairs: DataFrame, time_period: str = "whole_period") -> DataFrame:
    first = metrics.select(F.col("zone").alias("zone1"), "metric_name", F.col("value").alias("value1"))
    second = metrics.select(F.col("zone").alias("zone2"), "metric_name", F.col("value").alias("value2"))
    joined = pairs.join(first, "zone1").join(second, ["zone2", "metric_name"])
    return _shaped(joined, "zone_vs_zone", time_period)


def compare_halves(base: DataFrame, flag: str, kind: str, time_period: str) -> DataFrame:
    """Each zone against itself: where ``flag`` holds against where it does not."""
    sides = [
        side
        for m in METRICS
        for side in (_mean(m, F.col(flag)).alias(f"{m}_1"), _mean(m, ~F.col(flag)).alias(f"{m}_2"))
    ]
    halves = base.groupBy("zone").agg(*sides)
    long = F.array(*[
        F.struct(F.lit(m).alias("metric_name"), F.col(f"{m}_1").alias("value1"), F.col(f"{m}_2").alias("value2"))
        for m in METRICS
    ])
    rows = halves.select(F.col("zone").alias("zone1"), F.col("zone").alias("zone2"), F.inline(long))
    return _shaped(rows, kind, time_period)


def peak_against_rest(base: DataFrame) -> DataFrame:
    return compare_halves(base, "peak", "time_period", "peak_vs_offpeak")


def weekday_against_weekend(base: DataFrame) -> DataFrame:
    return compare_halves(base, "weekday", "weekday_vs_weekend", "weekday_vs_weekend")


def all_comparisons(base: DataFrame, pairs: DataFrame, as_of: Column | None = None) -> DataFrame:
    """All kinds of comparison, stamped with the moment they hold for (by default now)."""
    rows = (
        compare_zones(zone_metrics(base), pairs)
        .unionByName(peak_against_rest(base))
        .unionByName(weekday_against_weekend(base))
    )
    moment = F.current_timestamp() if as_of is None else as_of
    return rows.withColumn("timestamp", moment.cast("timestamp_ntz"))


def _shaped(rows: DataFrame, kind: str, time_period: str) -> DataFrame:
    return rows.select(
        F.lit(kind).alias("comparison_type"),
        "zone1",
        "zone2",
        "metric_name",
        "value1",
        "value2",
        percentage_difference(F.col("value1"), F.col("value2")).alias("percentage_diff"),
        F.lit(time_period).alias("time_period"),
    )
