"""Notification outbox: what would be sent, per alert change and enabled channel."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Titles, closing lines and recommended actions of the messages.
TITLE, SUBJECT, ESCALATED_SUBJECT = "ALERTE TRAFIC", "🚨 ALERTE TRAFIC - ", "🚨 ESCALADE ALERTE TRAFIC - "
CHAT_END = "Vérifier immédiatement la situation."
ACTIONS_TITLE = "Actions recommandées"
ACTIONS = (
    "Vérifier la situation sur place",
    "Activer les panneaux de signalisation",
    "Contacter les équipes de régulation",
    "Envisager des déviations",
)
CHANNELS = {"email": True, "slack": False, "webhook": False}  # fixed values: on by default?
ESCALATED = " (ESCALADE)"  # fixed value


def _subject(escalated: Column) -> Column:
    head = F.when(escalated, ESCALATED_SUBJECT).otherwise(SUBJECT)
    return F.concat(head, "alert_type", F.lit(" sur "), "road_id")


def _number(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("N/A"))


def _facts(bullet: str, before: str, after: str) -> Column:
    """Type, severity, road, zone and metrics, one line each. Labels are fixed values."""
    rows = [
        ("Type", F.col("alert_type"), ""),
        ("Sévérité", F.col("severity"), ""),
        ("Route", F.col("road_id"), ""),
        ("Zone", F.col("zone"), ""),
        ("Véhicules", _number("vehicle_count"), ""),
        ("Vitesse", _number("average_speed"), " km/h"),
        ("Taux occupation", _number("occupancy_rate"), "%"),
    ]
    lines = [F.concat(F.lit(f"{bullet}{before}{name}:{after} "), value, F.lit(unit)) for name, value, unit in rows]
    return F.concat_ws("\n", *lines)


def _chat_text(escalated: Column) -> Column:
    mark = F.when(F.col("severity") == "HIGH", "🚨").otherwise("⚠️")
    title = F.concat(mark, F.lit(f" *{TITLE}"), F.when(escalated, ESCALATED).otherwise(""), F.lit("*"))
    return F.concat(title, F.lit("\n\n"), _facts("", "*", "*"), F.lit(f"\n\n{CHAT_END}"))


def _mail_text(escalated: Column) -> Column:
    title = F.concat(F.lit(TITLE), F.when(escalated, ESCALATED).otherwise(""))
    stamp = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    actions = "".join(f"\n- {action}" for action in ACTIONS)
    return F.concat(title, F.lit("\n"), _facts("- ", "", ""), F.lit("\n- Timestamp: "), stamp, F.lit(f"\n\n{ACTIONS_TITLE}{actions}"))


def _hook_body(escalated: Column) -> Column:
    body = F.struct(
        "alert_id",
        F.lit("traffic_alert").alias("type"),
        "severity",
        "road_id",
        "zone",
        F.struct("vehicle_count", "average_speed", "occupancy_rate").alias("metrics"),
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        escalated.alias("is_escalation"),
    )
    return F.to_json(body, {"ignoreNullFields": "false"})


def outbox(
    alerts: DataFrame, channels: Mapping[str, bool] = CHANNELS, escalated: Column | None = None
) -> DataFrame:
    """One row per alert and enabled channel.

    ``escalated`` tells whether a row announces an escalation; by default
    an alert that has escalated at least once does.
    """
    again = F.col("escalation_count") > 0 if escalated is None else escalated
    payload = {
        "email": (_subject(again), _mail_text(again)),
        "slack": (F.lit(None).cast("string"), _chat_text(again)),
        "webhook": (F.lit(None).cast("string"), _hook_body(again)),
    }
    messages = F.array(*[
        F.struct(F.lit(name).alias("channel"), subject.alias("subject"), body.alias("body"))
        for name, (subject, body) in payload.items()
        if channels.get(name)
    ])
    return alerts.select("alert_id", again.alias("is_escalation"), F.inline(messages))
