"""Alert lifecycle over finished time windows, as a batch plan.

Per road and zone, windows are read in order of their end. A window that breaks
limits opens an alert of its type or refreshes the open one, and escalates it
when more than the type's limit has passed since the last escalation. A quiet
window resolves every open alert of that road and zone. A missing window is
neither.

Input has one row per window, road and zone, so a series is as long as the time
span divided by the window, whatever the number of events behind it.

The plan does not walk through a series. It takes it apart into chunks of time, whatever its length:

* Quiet windows end episodes, so a window's episode is the number of quiet windows before it: those of earlier chunks (a sum over
  one row per chunk) and those of its own. The windows of a type in an episode are one alert.
* Escalations depend on the last one before, so a chunk is summed up as a function of that: for each window that could be the first to
  escalate in the chunk, how many escalate from there on and which is the last. Only windows within the type's limit from the
  chunk's start, and the one after them, can be the first, since everything before the chunk lies before its start.
* Per alert these functions are applied one after the other, a handful of entries for each chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadflux.functions import rules
from roadflux.functions.timeparts import epoch_micros, epoch_seconds

SERIES = ["road_id", "zone"]
METRICS = ["vehicle_count", "average_speed", "occupancy_rate"]


def window_metrics(events: DataFrame, duration: str = "1 minute") -> DataFrame:
    grouped = events.groupBy(F.window("event_time", duration), *SERIES).agg(
        F.avg("vehicle_count").alias("avg_vehicle_count"),
        F.avg("average_speed").alias("avg_speed"),
        F.avg("occupancy_rate").alias("avg_occupancy_rate"),
        F.count("*").alias("event_count"),
        F.max("vehicle_count").alias("max_vehicles"),
        F.min("average_speed").alias("min_speed"),
    )
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *[c for c in grouped.columns if c != "window"],
    )


def detect(windows: DataFrame) -> DataFrame:
    """Add the alert type each window calls for; NULL for a quiet one."""
    kind = rules.alert_type(F.col("avg_vehicle_count"), F.col("avg_speed"), F.col("avg_occupancy_rate"))
    return windows.withColumn("alert_type", kind)


def alert_id(opened: Column) -> Column:
    return F.concat_ws("_", "alert_type", "road_id", "zone", epoch_seconds(opened).cast("string"))


State = tuple  # opened, last escalation, last update (epoch microseconds), escalations, three metrics
SECOND = 1_000_000


def next_state(state: State | None, kind: str, end: int, metrics: tuple) -> tuple[State, str]:
    """The state of an alert after a window that calls for it, and the change."""
    if state is None:
        return (end, end, end, 0, *metrics), "OPENED"
    opened, escalated, _, n, *_ = state
    due = end - escalated > rules.ALERTS[kind][4] * SECOND
    return (opened, end if due else escalated, end, n + 1 if due else n, *metrics), "ESCALATED" if due else "REFRESHED"


CHUNK_SECONDS = 86_400


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys that may be NULL, which counts as equal; ``right`` keeps only its other columns."""
    named = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    equal = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_{k}"))
        equal = one if equal is None else equal & one
    return left.join(named, equal, how).drop(*[f"_{k}" for k in keys])


def _with_episodes(detected: DataFrame) -> DataFrame:
    """Add ``episode``, the number of quiet windows before each; the quiet window that ends an episode is part of it."""
    quiet = F.col("alert_type").isNull()
    chunks = detected.groupBy(*SERIES, "chunk").agg(F.count_if(quiet).alias("quiet"))
    earlier = Window.partitionBy(*SERIES).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select(*SERIES, "chunk", F.coalesce(F.sum("quiet").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy(*SERIES, "chunk").orderBy("end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = detected.withColumn("seen", F.count_if(quiet).over(inside))
    return _same(numbered, offsets, [*SERIES, "chunk"], "inner").withColumn("episode", F.col("before") + F.col("seen") - quiet.cast("long"))


def _escalated(calls: DataFrame, chunk_micros: int) -> DataFrame:
    """One row per alert: opened, updated, n (escalations), metrics."""
    limit = rules.escalation_seconds(F.col("alert_type")).cast("long") * SECOND

    def walked(times: Column, last: Column, n: int) -> Column:
        start = F.struct(last.alias("last"), F.lit(n).alias("n"))
        return F.aggregate(times, start, lambda s, t: F.when(
            t - s["last"] > limit, F.struct(t.alias("last"), (s["n"] + 1).alias("n"))).otherwise(s))

    chunks = calls.groupBy(*SERIES, "episode", "alert_type", "chunk").agg(
        F.sort_array(F.collect_list("end")).alias("times"), F.max_by(F.struct(*METRICS), "end").alias("metrics"))
    until = F.col("chunk") * chunk_micros + limit
    possible = F.concat(F.filter("times", lambda t: t <= until), F.slice(F.filter("times", lambda t: t > until), 1, 1))
    entries = F.transform(possible, lambda e: F.struct(e.alias("at"), walked(F.filter("times", lambda t: t > e), e, 1).alias("then")))
    parts = chunks.select(
        *SERIES, "episode", "alert_type", F.struct(
            "chunk", F.get("times", F.lit(0)).alias("opened"), F.element_at("times", -1).alias("updated"), "metrics",
            walked(F.col("times"), F.get("times", F.lit(0)), 0).alias("alone"), entries.alias("entries")).alias("part"))
    whole = parts.groupBy(*SERIES, "episode", "alert_type").agg(F.sort_array(F.collect_list("part")).alias("parts"))

    def applied(state: Column, part: Column) -> Column:
        then = F.get(F.filter(part["entries"], lambda e: e["at"] - state["last"] > limit), F.lit(0))["then"]
        return F.when(then.isNull(), state).otherwise(F.struct(then["last"].alias("last"), (state["n"] + then["n"]).alias("n")))

    first, last = F.get("parts", F.lit(0)), F.element_at("parts", -1)
    end = F.aggregate(F.slice("parts", 2, F.size("parts")), first["alone"], applied)
    return whole.select(*SERIES, "episode", "alert_type", first["opened"].alias("opened"), last["updated"].alias("updated"),
                        end["n"].alias("n"), last["metrics"].alias("metrics"))


def lifecycle(windows: DataFrame, seconds_per_chunk: int = CHUNK_SECONDS) -> DataFrame:
    """One row per alert with its final state, as ``streaming.lifecycle`` reaches it batch by batch."""
    kind = windows.schema["window_end"].dataType
    chunk_micros = seconds_per_chunk * SECOND
    detected = detect(windows).select(
        *SERIES, epoch_micros(F.col("window_end")).alias("end"), "alert_type",
        *[F.col(c).cast("double").alias(m) for c, m in zip(("avg_vehicle_count", "avg_speed", "avg_occupancy_rate"), METRICS)],
    ).withColumn("chunk", F.floor(F.col("end") / chunk_micros))
    numbered = _with_episodes(detected)
    ends = numbered.filter(F.col("alert_type").isNull()).select(*SERIES, "episode", F.col("end").alias("resolved"))
    folded = _same(_escalated(numbered.filter(F.col("alert_type").isNotNull()), chunk_micros), ends, [*SERIES, "episode"], "left")
    moment = lambda c: F.timestamp_micros(F.col(c)).cast(kind)
    alerts = folded.withColumns({"timestamp": moment("opened"), "last_update": moment("updated"), "resolved_at": moment("resolved")})
    return alerts.select(
        alert_id(F.col("timestamp")).alias("alert_id"),
        "alert_type",
        rules.alert_severity(F.col("alert_type")).alias("severity"),
        *SERIES,
        "metrics.*",
        "timestamp",
        F.when(F.col("resolved_at").isNull(), "ACTIVE").otherwise("RESOLVED").alias("status"),
        F.col("n").alias("escalation_count"),
        "last_update",
        "resolved_at",
        (epoch_seconds(F.col("resolved_at")) - epoch_seconds(F.col("timestamp"))).alias("duration_seconds"),
    )


def recent_summary(alerts: DataFrame, since: Column) -> DataFrame:
    """Per type and severity: alerts opened from a moment on and their mean metrics."""
    return alerts.filter(F.col("timestamp") >= since).groupBy("alert_type", "severity").agg(
        F.count("*").alias("count"),
        F.avg("vehicle_count").alias("avg_vehicles"),
        F.avg("average_speed").alias("avg_speed"),
        F.avg("occupancy_rate").alias("avg_occupancy"),
    )


def dashboard_sections(summary: DataFrame, top: int = 5) -> DataFrame:
    """(section, key, value) rows over ``recent_summary``, which is read once.

    Averages are means of the summary's rows. The summary has one row per type
    and severity, so ranking it in one window is no bottleneck. Totals and
    averages are there, as zero, when there was no alert at all.
    """
    means = ["avg_vehicles", "avg_speed", "avg_occupancy"]
    line = lambda section, key, value: F.struct(
        F.lit(section).alias("section"), key.alias("key"), value.cast("double").alias("value")
    )
    largest = Window.partitionBy(F.lit(0)).orderBy(F.desc("count"), "alert_type", "severity")
    n = F.col("count")
    fixed = [("total_alerts", "all", n), *[("average_metrics", c, F.col(c)) for c in means]]
    lines = F.array(
        *[line(section, F.lit(key), value) for section, key, value in fixed],
        line("alerts_by_type", F.col("alert_type"), n),
        line("alerts_by_severity", F.col("severity"), n),
        F.when(F.col("_place") <= top, line("top_alert_types", F.col("alert_type"), n)),
    )
    placed = summary.withColumn("_place", F.row_number().over(largest))
    exploded = placed.select(F.explode(lines).alias("_l")).filter(F.col("_l").isNotNull()).select("_l.*")
    nothing = F.array(*[line(section, F.lit(key), F.lit(None)) for section, key, _ in fixed])
    always = summary.sparkSession.range(1).select(F.inline(nothing))
    value = F.when(F.col("section") == "average_metrics", F.avg("value")).otherwise(F.sum("value"))
    return exploded.unionByName(always).groupBy("section", "key").agg(F.coalesce(value, F.lit(0.0)).alias("value"))


def active_summary(alerts: DataFrame) -> DataFrame:
    """(section, key, value) rows over active alerts: total, by severity, type and zone.

    Active alerts are counted once per severity, type and zone; the sections
    only add those counts up.
    """
    counted = alerts.filter(F.col("status") == "ACTIVE").groupBy("severity", "alert_type", "zone").agg(
        F.count("*").alias("n")
    )
    sections = {"by_severity": "severity", "by_type": "alert_type", "by_zone": "zone"}
    lines = F.array(
        F.struct(F.lit("total_active").alias("section"), F.lit("all").alias("key")),
        *[F.struct(F.lit(s).alias("section"), F.col(c).alias("key")) for s, c in sections.items()],
    )
    return counted.select(F.inline(lines), "n").groupBy("section", "key").agg(F.sum("n").alias("n"))
