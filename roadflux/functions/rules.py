"""Classification rules.

A rule is an ordered list of cuts. The first cut that holds decides; a NULL
measure satisfies no cut and so falls through to the default.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

ABOVE, AT_LEAST, BELOW = operator.gt, operator.ge, operator.lt


def first_match(cases: Sequence[tuple[Column, object]], default: object) -> Column:
    (condition, value), *rest = cases
    chain = F.when(condition, F.lit(value))
    for condition, value in rest:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(default))


def cut(measure: Column, holds, steps: Sequence[tuple[float, object]], default: object) -> Column:
    return first_match([(holds(measure, F.lit(limit)), value) for limit, value in steps], default)


# --- Fixed values -----------------------------------------------------------
# Limits and labels below are part of the data contract; labels are also used
# as filter and join values and stay verbatim.
CONGESTED_BELOW_SPEED = {"autoroute": 50, "avenue": 30, "rue": 25}
CONGESTED_ABOVE_OCCUPANCY = 30
SLOW_SPEED = 30

SERVICE_LEVEL = [(70, "A - Excellent"), (50, "B - Bon"), (30, "C - Moyen"), (20, "D - Faible")]
SERVICE_LEVEL_DEFAULT = "E - Critique"
PERFORMANCE_SCORE = [(80, 100), (60, 80), (40, 60), (30, 40)]
ROAD_STATUS = [(30, "CRITIQUE - Intervention requise"), (50, "ALERTE - Surveillance renforcée")]
ROAD_STATUS_DEFAULT = "NORMAL - Bonnes conditions"
CONGESTION_BAND = [(50, "Élevée ( > 50%)"), (30, "Modérée (30-50%)"), (15, "Légère (15-30%)")]
CONGESTION_BAND_DEFAULT = "Fluide ( < 15%)"
BAND_PRIORITY = [(50, 1), (30, 2), (15, 3)]
IMPACT_MINUTES_PER_PERCENT = 1.5
DAY_PERIOD = [
    ((6, 9), "Heures de pointe matin"),
    ((16, 19), "Heures de pointe soir"),
    ((10, 15), "Pleine journée"),
    ((20, 23), "Soirée"),
]
DAY_PERIOD_DEFAULT = "Nuit"
TRAFFIC_LEVEL = [(200, "Élevé"), (120, "Moyen")]
FLUIDITY = [(60, "Excellente"), (50, "Bonne"), (40, "Moyenne"), (30, "Faible")]
CONGESTION_LEVEL = [(70, "Critique"), (50, "Élevé"), (30, "Modéré")]
LEVEL_PRIORITY = [(70, 1), (50, 2), (30, 3)]
RUSH_PERIOD = [
    ((7, 9), "Heure de pointe matin"),
    ((16, 19), "Heure de pointe soir"),
    ((12, 14), "Pause déjeuner"),
]
RUSH_PERIOD_DEFAULT = "Heure normale"
EVENT_SERVICE_LETTER = [(60, "A"), (50, "B"), (40, "C"), (30, "D"), (20, "E")]
# alert type: speed below, occupancy above, vehicles above, severity, seconds until it escalates
ALERTS = {
    "HIGH_CONGESTION": (30, 80, 150, "HIGH", 300),
    "MODERATE_CONGESTION": (40, 70, 120, "MEDIUM", 600),
    "LOW_CONGESTION": (50, 60, 100, "LOW", 900),
}
RATE_SEVERITY = [(70, "CRITIQUE"), (50, "ÉLEVÉ"), (30, "MOYEN")]
DENSITY = [(200, "Critical"), (150, "High"), (100, "Medium"), (50, "Low")]
MARKER_DENSITY = [(200, "High"), (100, "Medium")]
CONGESTION_STATE = [(20, "Green: Fluide"), (40, "Yellow: Modéré"), (60, "Orange: Dense")]
CONGESTION_STATE_DEFAULT = "Red: Congestionné"
# congestion level: required action, numeric priority, recommendation
INTERVENTION = {
    "Élevé": ("RED: URGENT", 3, "Immediate"),
    "Modéré": ("ORANGE: ATTENTION", 2, "Under 30min"),
}
INTERVENTION_DEFAULT = ("GREEN: NORMAL", 1, "Monitoring")
# --- End of fixed values ----------------------------------------------------


def is_congested(road_type: Column, speed: Column, occupancy: Column) -> Column:
    """Congestion of one reading; the speed limit depends on the road type."""
    limit = F.lit(None).cast("double")
    for kind, value in CONGESTED_BELOW_SPEED.items():
        limit = F.when(road_type == kind, F.lit(float(value))).otherwise(limit)
    slow = speed < limit
    full = limit.isNotNull() & (occupancy > CONGESTED_ABOVE_OCCUPANCY)
    return F.coalesce(slow, F.lit(False)) | F.coalesce(full, F.lit(False))


def service_level(speed: Column) -> Column:
    return cut(speed, ABOVE, SERVICE_LEVEL, SERVICE_LEVEL_DEFAULT)


def performance_score(speed: Column) -> Column:
    return cut(speed, ABOVE, PERFORMANCE_SCORE, 20)


def road_status(speed: Column) -> Column:
    return cut(speed, BELOW, ROAD_STATUS, ROAD_STATUS_DEFAULT)


def congestion_band(rate: Column) -> Column:
    return cut(rate, ABOVE, CONGESTION_BAND, CONGESTION_BAND_DEFAULT)


def band_priority(rate: Column) -> Column:
    return cut(rate, ABOVE, BAND_PRIORITY, 4)


def impact_minutes(rate: Column) -> Column:
    return F.round(rate * F.lit(IMPACT_MINUTES_PER_PERCENT), 2)


def _period(hour: Column, periods, default: str) -> Column:
    return first_match([(hour.between(*bounds), label) for bounds, label in periods], default)


def day_period(hour: Column) -> Column:
    return _period(hour, DAY_PERIOD, DAY_PERIOD_DEFAULT)


def rush_period(hour: Column) -> Column:
    return _period(hour, RUSH_PERIOD, RUSH_PERIOD_DEFAULT)


def traffic_level(mean_vehicles: Column) -> Column:
    return cut(mean_vehicles, ABOVE, TRAFFIC_LEVEL, "Faible")


def fluidity(speed: Column) -> Column:
    return cut(speed, AT_LEAST, FLUIDITY, "Mauvaise")


def congestion_level(rate: Column) -> Column:
    return cut(rate, AT_LEAST, CONGESTION_LEVEL, "Faible")


def level_priority(rate: Column) -> Column:
    return cut(rate, AT_LEAST, LEVEL_PRIORITY, 4)


def zone_status(traffic: Column, congestion: Column) -> Column:
    busy = F.coalesce(traffic == "Élevé", F.lit(False))
    jammed = F.coalesce(congestion.isin("Critique", "Élevé"), F.lit(False))
    return first_match(
        [(busy & jammed, "Zone Critique - Action Immédiate"), (busy | jammed, "Zone à Surveiller")],
        "Zone Normale",
    )


def event_service_letter(speed: Column) -> Column:
    return cut(speed, AT_LEAST, EVENT_SERVICE_LETTER, "F")


def alert_type(vehicles: Column, speed: Column, occupancy: Column) -> Column:
    """Most severe alert whose limits are broken, or NULL."""
    return first_match(
        [
            ((speed < slow) | (occupancy > full) | (vehicles > many), name)
            for name, (slow, full, many, _, _) in ALERTS.items()
        ],
        None,
    )


def alert_severity(kind: Column) -> Column:
    return first_match([(kind == name, spec[3]) for name, spec in ALERTS.items()], None)


def escalation_seconds(kind: Column) -> Column:
    return first_match([(kind == name, spec[4]) for name, spec in ALERTS.items()], None)


def rate_severity(rate: Column) -> Column:
    return cut(rate, ABOVE, RATE_SEVERITY, "FAIBLE")


def density(mean_vehicles: Column) -> Column:
    return cut(mean_vehicles, ABOVE, DENSITY, "Very Low")


def marker_density(mean_vehicles: Column) -> Column:
    return cut(mean_vehicles, ABOVE, MARKER_DENSITY, "Low")


def congestion_state(rate: Column) -> Column:
    return cut(rate, BELOW, CONGESTION_STATE, CONGESTION_STATE_DEFAULT)


def intervention(level: Column, part: int) -> Column:
    """Part 0 is the required action, 1 the numeric priority, 2 the recommendation."""
    cases = [(level == name, parts[part]) for name, parts in INTERVENTION.items()]
    return first_match(cases, INTERVENTION_DEFAULT[part])


def congestion_target(next_speed: Column, next_occupancy: Column) -> Column:
    """Training label: is the following reading congested?"""
    return first_match([(next_speed < SLOW_SPEED, 1.0), (next_occupancy > 70, 1.0)], 0.0)
