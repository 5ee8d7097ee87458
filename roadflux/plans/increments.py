"""KPI tables that are carried forward: one mergeable state per batch of events instead of the events of all time.

A state has a row per road, type, zone, hour of day and weekday: counts, and of each measure sum, number, extremes and the sum of
squared deviations from its own mean. States of different events add up, in any order, to the state of all of them; so do parts
of a state, which gives the coarser tables. All nine tables of both KPI families come from it.

A store is a folder. ``batches/batch=N`` holds the state of one batch; a batch that arrives again replaces itself, so a replay
changes nothing. ``folds/upto=N`` holds the states up to batch N added up; a reader takes the newest and the batches after
it. Only folders that were finished (``_SUCCESS``) count. One job adds and folds; readers need not wait for it, since what a fold replaces
stays until the next fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadflux import workspace
from roadflux.functions import rules
from roadflux.functions.timeparts import with_day_parts
from roadflux.operators import kpis
from roadflux.plans import jobs, marts
from roadflux.sinks import files

KEYS = [*jobs.ROLLUP_KEYS, "weekday"]
MEASURES = {"v": kpis.VEHICLES, "s": kpis.SPEED, "o": kpis.OCCUPANCY}
COUNTS = ["n", "congested", "slow"]
LAYOUT = {
    **files.PROCESSED_LAYOUT,
    "trafic_par_zone": [], "vitesse_moyenne": [], "taux_congestion": [], "evolution_trafic": [], "zones_critiques": [],
}


def state(events: DataFrame) -> DataFrame:
    """The state of some events, in one pass and one partial aggregate."""
    congested = rules.is_congested(F.col("road_type"), F.col(kpis.SPEED), F.col(kpis.OCCUPANCY))
    timed = with_day_parts(events).withColumn("weekday", F.date_format("event_time", "EEEE"))
    columns = [F.count("*").alias("n"), F.count_if(congested).alias("congested"),
               F.count_if(F.col(kpis.SPEED) < rules.SLOW_SPEED).alias("slow")]
    for m, name in MEASURES.items():
        spread = F.coalesce(F.var_pop(name) * F.count(name), F.lit(0.0))
        columns += [F.sum(name).alias(f"{m}_sum"), F.count(name).alias(f"{m}_n"), F.min(name).alias(f"{m}_min"),
                    F.max(name).alias(f"{m}_max"), spread.alias(f"{m}_m2")]
    return timed.groupBy(*KEYS).agg(*columns)


def _mean(m: str) -> Column:
    return F.try_divide(F.col(f"{m}_sum"), F.col(f"{m}_n"))


def combined(states: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """States added up per ``keys``, which may be fewer than those of the states.

    Deviations from a part's mean become deviations from the common mean by the square of the distance between the two,
    which takes the common means first. That loses no digits where sums of squares would. Both steps combine before their shuffle.
    """
    sums = [F.sum(f"{m}_{part}").alias(f"_{m}_{part}") for m in MEASURES for part in ("sum", "n")]
    centres = states.groupBy(*keys).agg(*sums).select(
        *[F.col(k).alias(f"_{k}") for k in keys], *[F.try_divide(f"_{m}_sum", f"_{m}_n").alias(f"_{m}") for m in MEASURES])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    columns = [F.sum(c).alias(c) for c in COUNTS]
    for m in MEASURES:
        moved = F.coalesce(F.col(f"{m}_n") * (_mean(m) - F.col(f"_{m}")) ** 2, F.lit(0.0))
        columns += [F.sum(f"{m}_sum").alias(f"{m}_sum"), F.sum(f"{m}_n").alias(f"{m}_n"), F.min(f"{m}_min").alias(f"{m}_min"),
                    F.max(f"{m}_max").alias(f"{m}_max"), F.sum(F.col(f"{m}_m2") + moved).alias(f"{m}_m2")]
    return states.join(centres, same).groupBy(*keys).agg(*columns)


def _spread(m: str) -> Column:
    return F.when(F.col(f"{m}_n") > 1, F.sqrt(F.col(f"{m}_m2") / (F.col(f"{m}_n") - 1)))


def kpi_tables(states: DataFrame) -> dict[str, DataFrame]:
    """The nine tables of both families, as over the events themselves."""
    occupancy = _mean("o") / 100  # the second family counts it as a fraction
    profile = combined(states, ["zone"]).select(
        "zone", F.col("n").alias("nombre_mesures"), _mean("v").alias("trafic_moyen_vehicules_heure"), F.col("v_sum").alias("trafic_total"),
        F.col("v_max").alias("pic_trafic"), _spread("v").alias("variabilite_trafic"),
        _mean("s").alias("vitesse_moyenne_kmh"), F.col("s_min").alias("vitesse_minimale"), F.col("s_max").alias("vitesse_maximale"),
        _spread("s").alias("ecart_type_vitesse"),
        F.col("n").alias("total_mesures"), F.col("slow").alias("mesures_congestionnees"), occupancy.alias("taux_occupation_moyen"),
        _mean("s").alias("vitesse_moyenne"),
    )
    times = states.groupBy(F.col("hour").alias("heure"), F.col("weekday").alias("jour_semaine")).agg(
        F.sum("n").alias("nombre_mesures"), *[F.sum(f"{m}_{part}").alias(f"{m}_{part}") for m in MEASURES for part in ("sum", "n")])
    zones = kpis.zone_tables(profile)
    return {
        **jobs.processed_tables(states),
        **zones,
        "evolution_trafic": times.select(
            "heure", "jour_semaine", _mean("v").alias("trafic_horaire_moyen"), _mean("s").alias("vitesse_horaire_moyenne"),
            occupancy.alias("occupation_horaire_moyenne"), "nombre_mesures",
        ).withColumn("periode_journee", rules.rush_period(F.col("heure"))),
        "zones_critiques": marts.critical_zones(zones["trafic_par_zone"], zones["taux_congestion"]),
    }


# --- store ---------------------------------------------------------------------

def _folded(spark: SparkSession, store: str) -> int:
    return max(workspace.finished(spark, f"{store}/folds", "upto"), default=-1)


def add(events: DataFrame, store: str, batch: int) -> None:
    """Store the state of batch number ``batch`` (0 or more). The same batch again takes its own place."""
    spark = events.sparkSession
    if batch <= _folded(spark, store):
        raise ValueError(f"batch {batch} of {store} is folded")
    state(events).write.mode("overwrite").parquet(f"{store}/batches/batch={batch}")


def states(spark: SparkSession, store: str) -> DataFrame:
    """The states that make up all batches so far, not added up yet."""
    upto = _folded(spark, store)
    paths = [f"{store}/batches/batch={n}" for n in workspace.finished(spark, f"{store}/batches", "batch") if n > upto]
    if upto >= 0:
        paths.append(f"{store}/folds/upto={upto}")
    if not paths:
        raise ValueError(f"{store} has no batches")
    return spark.read.schema(spark.read.parquet(paths[0]).schema).parquet(*paths)


def fold(spark: SparkSession, store: str) -> int:
    """Add all batches up to one state, so that there are few files to read; returns the last batch in it.

    Removes what the fold before had replaced already: readers of that time are done by then.
    """
    before, batches = _folded(spark, store), workspace.finished(spark, f"{store}/batches", "batch")
    upto = max(batches, default=-1)
    if upto <= before:
        return before
    combined(states(spark, store)).write.mode("overwrite").parquet(f"{store}/folds/upto={upto}")
    for n in batches:
        if n <= before:
            workspace.remove(spark, f"{store}/batches/batch={n}")
    for n in workspace.finished(spark, f"{store}/folds", "upto"):
        if n < before:
            workspace.remove(spark, f"{store}/folds/upto={n}")
    return upto


def write_tables(spark: SparkSession, store: str, base: str) -> dict[str, str]:
    """The nine tables as stored ones, from a single reading of the states."""
    with workspace.scratch(spark):
        whole = workspace.written(states(spark, store), "kpi-states")
        return files.write_zone(kpi_tables(whole), base, LAYOUT)
