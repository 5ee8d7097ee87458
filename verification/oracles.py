"""DuckDB SQL for the registered queries, written against the supplied tables.

``PARTS`` are named subqueries; ``sql`` puts those a text refers to in front of it.
"""

from __future__ import annotations

import re

from verification.fixtures import DIRECTIONS, ROAD_TYPES, ZONES


def _case(index: str, names: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names))
    return f"CASE CAST({index} AS INTEGER) {arms} END"


def _steps(value: str, sign: str, steps: list[tuple], default) -> str:
    show = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    arms = " ".join(f"WHEN {value} {sign} {limit} THEN {show(label)}" for limit, label in steps)
    return f"CASE {arms} ELSE {show(default)} END"


def _service(v):
    return _steps(v, ">", [(70, "A - Excellent"), (50, "B - Bon"), (30, "C - Moyen"), (20, "D - Faible")], "E - Critique")


def _score(v):
    return _steps(v, ">", [(80, 100), (60, 80), (40, 60), (30, 40)], 20)


def _status(v):
    return _steps(v, "<", [(30, "CRITIQUE - Intervention requise"), (50, "ALERTE - Surveillance renforcée")],
                  "NORMAL - Bonnes conditions")


def _band(v):
    return _steps(v, ">", [(50, "Élevée ( > 50%)"), (30, "Modérée (30-50%)"), (15, "Légère (15-30%)")],
                  "Fluide ( < 15%)")


def _band_priority(v):
    return _steps(v, ">", [(50, 1), (30, 2), (15, 3)], 4)


def _traffic(v):
    return _steps(v, ">", [(200, "Élevé"), (120, "Moyen")], "Faible")


def _fluid(v):
    return _steps(v, ">=", [(60, "Excellente"), (50, "Bonne"), (40, "Moyenne"), (30, "Faible")], "Mauvaise")


def _level(v):
    return _steps(v, ">=", [(70, "Critique"), (50, "Élevé"), (30, "Modéré")], "Faible")


def _level_priority(v):
    return _steps(v, ">=", [(70, 1), (50, 2), (30, 3)], 4)


def _letter(v):
    return _steps(v, ">=", [(60, "A"), (50, "B"), (40, "C"), (30, "D"), (20, "E")], "F")


def _density(v):
    return _steps(v, ">", [(200, "Critical"), (150, "High"), (100, "Medium"), (50, "Low")], "Very Low")


def _marker(v):
    return _steps(v, ">", [(200, "High"), (100, "Medium")], "Low")


def _state(v):
    return _steps(v, "<", [(20, "Green: Fluide"), (40, "Yellow: Modéré"), (60, "Orange: Dense")], "Red: Congestionné")


def _rate_severity(v):
    return _steps(v, ">", [(70, "CRITIQUE"), (50, "ÉLEVÉ"), (30, "MOYEN")], "FAIBLE")


def _period(h):
    return (f"CASE WHEN {h} BETWEEN 6 AND 9 THEN 'Heures de pointe matin' WHEN {h} BETWEEN 16 AND 19 THEN "
            f"'Heures de pointe soir' WHEN {h} BETWEEN 10 AND 15 THEN 'Pleine journée' "
            f"WHEN {h} BETWEEN 20 AND 23 THEN 'Soirée' ELSE 'Nuit' END")


def _rush(h):
    return (f"CASE WHEN {h} BETWEEN 7 AND 9 THEN 'Heure de pointe matin' WHEN {h} BETWEEN 16 AND 19 THEN "
            f"'Heure de pointe soir' WHEN {h} BETWEEN 12 AND 14 THEN 'Pause déjeuner' ELSE 'Heure normale' END")


def _alert(v, s, o):
    return (f"CASE WHEN {s} < 30 OR {o} > 80 OR {v} > 150 THEN 'HIGH_CONGESTION' "
            f"WHEN {s} < 40 OR {o} > 70 OR {v} > 120 THEN 'MODERATE_CONGESTION' "
            f"WHEN {s} < 50 OR {o} > 60 OR {v} > 100 THEN 'LOW_CONGESTION' END")


def _severity(t):
    return (f"CASE {t} WHEN 'HIGH_CONGESTION' THEN 'HIGH' WHEN 'MODERATE_CONGESTION' THEN 'MEDIUM' "
            f"WHEN 'LOW_CONGESTION' THEN 'LOW' END")


def _zone_status(t, c):
    return (f"CASE WHEN {t} = 'Élevé' AND {c} IN ('Critique', 'Élevé') THEN 'Zone Critique - Action Immédiate' "
            f"WHEN {t} = 'Élevé' OR {c} IN ('Critique', 'Élevé') THEN 'Zone à Surveiller' ELSE 'Zone Normale' END")


CONGESTED = """((road_type = 'autoroute' AND (coalesce(average_speed < 50, false) OR coalesce(occupancy_rate > 30, false)))
 OR (road_type = 'avenue' AND (coalesce(average_speed < 30, false) OR coalesce(occupancy_rate > 30, false)))
 OR (road_type = 'rue' AND (coalesce(average_speed < 25, false) OR coalesce(occupancy_rate > 30, false))))"""


def _fields(quote: str, gap: str, stamp: str) -> str:
    """The text of one raw line, as a concatenation."""
    q = quote
    parts = [f"'{q}{c}{q}:{gap}{q}' || {c} || '{q}'" for c in ("sensor_id", "road_id", "road_type", "zone")]
    parts += [f"'{q}{c}{q}:{gap}' || coalesce(CAST({c} AS VARCHAR), 'null')"
              for c in ("vehicle_count", "average_speed", "occupancy_rate")]
    parts.append(f"'{q}event_time{q}:{gap}{q}' || {stamp} || '{q}'")
    return "'{' || " + f" || ',{gap}' || ".join(parts) + " || '}'"


ISO_MICROS = "strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f')"
ISO = "strftime(event_time, '%Y-%m-%dT%H:%M:%S')"
PLAIN = "strftime(event_time, '%Y-%m-%d %H:%M:%S')"
JSON_LINE = f"""CASE event_type WHEN 'view' THEN {_fields('"', '', ISO_MICROS)}
 WHEN 'click' THEN {_fields('"', '', PLAIN)} WHEN 'signup' THEN {_fields('"', '', "'n/a'")} END"""
TIME_KEPT = """CASE event_type WHEN 'view' THEN event_time
 WHEN 'click' THEN date_trunc('second', event_time) WHEN 'purchase' THEN date_trunc('second', event_time) END"""


def _settled(value: str, digits: int) -> str:
    """Round half up in decimal, free of the last bits of a sum."""
    return f"CAST(round(CAST({value} AS DECIMAL(24,10)), {digits}) AS DOUBLE)"


def _repaired(column: str, after: str) -> str:
    return f"SELECT {column} AS before, {after} AS after, count(*) AS n FROM dirty GROUP BY 1, 2"


GIVEN_CLASS = """(SELECT target, CASE WHEN average_speed IS NOT NULL THEN CAST(CAST(average_speed < 35 AS INTEGER) AS DOUBLE) END AS p
 FROM history WHERE vehicle_count_target IS NOT NULL AND next_speed IS NOT NULL)"""
# The exact cut: the smallest score that a tenth of all scores does not exceed.
GIVEN_FLAGS = """(SELECT *, CASE WHEN anomaly_score IS NOT NULL THEN CAST(anomaly_score < (SELECT min(s) FROM (
  SELECT anomaly_score AS s, count(*) OVER () AS n,
   count(*) OVER (ORDER BY anomaly_score) AS upto FROM given_scores WHERE anomaly_score IS NOT NULL) WHERE upto >= (n + 9) // 10) AS INTEGER) END
 AS is_anomaly FROM given_scores)"""

PARTS = {
    "preds": """SELECT zone, processed_at + INTERVAL 1 HOUR AS prediction_timestamp, trafic_moyen_vehicules_heure AS predicted_traffic,
 vitesse_moyenne_kmh AS predicted_speed, CAST(0.75 AS DOUBLE) AS confidence_score, 1 AS prediction_horizon_hours,
 'v1.0' AS model_version FROM snaps""",
    "given_scores": """SELECT *, CASE WHEN average_speed IS NOT NULL AND occupancy_rate IS NOT NULL
  THEN -CAST((event_id * 7919) % 1000 + 1 AS DOUBLE) / 1024 END AS anomaly_score FROM traffic""",
    "parted": """SELECT percent, bucket < percent AS train FROM (SELECT CAST(('0x' || substr(md5(concat_ws('|', '42', sensor_id, road_id, zone,
   strftime(event_time, '%Y-%m-%d %H:%M:%S.%f'))), 1, 8)) AS BIGINT) % 100 AS bucket FROM history
  WHERE vehicle_count_target IS NOT NULL AND next_speed IS NOT NULL), (VALUES (70), (80)) AS t(percent)""",
    "hour_means": """SELECT road_id, zone, date_trunc('hour', event_time) AS t, avg(vehicle_count) AS v, avg(average_speed) AS s,
 avg(occupancy_rate) AS o FROM traffic GROUP BY 1, 2, 3""",
    "step0": """SELECT 0 AS step, road_id, zone, max(t) AS t, list(v ORDER BY t DESC)[1:4] AS v, list(s ORDER BY t DESC)[1:4] AS s,
 list(o ORDER BY t DESC)[1:4] AS o FROM hour_means GROUP BY 2, 3""",
    "step1": """SELECT 1 AS step, road_id, zone, t + INTERVAL 1 HOUR AS t, list_concat([v[1] + 1], v[1:3]) AS v,
 list_concat([s[1] + 0.5], s[1:3]) AS s, list_concat([o[1]], o[1:3]) AS o FROM step0""",
    "step2": """SELECT 2 AS step, road_id, zone, t + INTERVAL 1 HOUR AS t, list_concat([v[1] + 1], v[1:3]) AS v,
 list_concat([s[1] + 0.5], s[1:3]) AS s, list_concat([o[1]], o[1:3]) AS o FROM step1""",
    "b": """SELECT event_id, user_id, value, ts, event_type, CAST((props->>'k') AS DOUBLE) AS k,
 CAST(((user_id % 100) // 4) % 6 AS INT) AS z, hour(ts) AS h FROM events""",
    "traffic": f"""SELECT event_id, event_type, ts AS event_time,
 printf('SENSOR_%04d', CAST(1 + event_id % 50 AS INT)) AS sensor_id,
 printf('ROAD_%04d', CAST(1 + user_id % 100 AS INT)) AS road_id,
 {_case('user_id % 4', ROAD_TYPES)} AS road_type, {_case('z', ZONES)} AS zone,
 CAST(floor(value * CAST(CASE z WHEN 0 THEN 5 WHEN 1 THEN 3 ELSE 1 END AS DOUBLE)
   * CAST(CASE WHEN h BETWEEN 7 AND 9 OR h BETWEEN 17 AND 19 THEN 2 ELSE 1 END AS DOUBLE)) AS BIGINT) AS vehicle_count,
 CASE WHEN event_id % 97 = 0 THEN NULL
      ELSE CAST(5 AS DOUBLE) + k * (CAST(1 + z AS DOUBLE) / CAST(4 AS DOUBLE)) END AS average_speed,
 CASE WHEN event_id % 89 = 0 THEN NULL
      ELSE CAST((event_id * 37) % 101 AS DOUBLE) * (CAST(1 + z % 4 AS DOUBLE) / CAST(4 AS DOUBLE)) END AS occupancy_rate
 FROM b""",
    "now": "SELECT max(event_time) AS as_of FROM traffic",
    "lines": f"""SELECT event_id, event_type, CASE event_type WHEN 'purchase' THEN {_fields('', ' ', ISO)}
   WHEN 'error' THEN 'corrupt ' || event_id ELSE {JSON_LINE} END AS value FROM traffic
 UNION ALL SELECT event_id, event_type, '   ' FROM traffic WHERE event_type = 'error'""",
    "readings": f"""SELECT event_time AS timestamp, zone, vehicle_count, average_speed AS speed,
 occupancy_rate / CAST(100 AS DOUBLE) AS occupancy, {_letter('average_speed')} AS service_level, sensor_id, road_type
 FROM traffic""",
    "zone_hour": """SELECT zone, CAST(hour(event_time) AS INTEGER) AS hour, road_type,
 avg(vehicle_count) AS avg_vehicle_count, avg(average_speed) AS avg_speed, avg(occupancy_rate) AS avg_occupancy_rate,
 CAST(sum(vehicle_count) AS BIGINT) AS total_vehicles, count(*) AS event_count, max(vehicle_count) AS max_vehicles,
 min(average_speed) AS min_speed FROM traffic GROUP BY 1, 2, 3""",
    "roads": """SELECT road_id, road_type, zone, avg(average_speed) AS avg_speed, avg(vehicle_count) AS avg_vehicles,
 avg(occupancy_rate) AS avg_occupancy, count(*) AS measurement_count, max(average_speed) AS max_speed,
 min(average_speed) AS min_speed FROM traffic GROUP BY 1, 2, 3""",
    "zones": f"""SELECT zone, count(*) AS total_events, count(*) FILTER (WHERE {CONGESTED}) AS congested_events,
 avg(occupancy_rate) AS avg_occupancy, avg(average_speed) AS avg_speed,
 CAST(count(*) FILTER (WHERE {CONGESTED}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS congestion_rate_percent
 FROM traffic GROUP BY zone""",
    "hours": """SELECT CAST(hour(event_time) AS INTEGER) AS hour, zone, avg(vehicle_count) AS avg_vehicles,
 avg(average_speed) AS avg_speed, avg(occupancy_rate) AS avg_occupancy, count(*) AS event_count
 FROM traffic GROUP BY 1, 2""",
    "strategic0": f"""SELECT zone, {_settled('avg(avg_vehicle_count)', 2)} AS trafic_moyen_vehicules,
 {_settled('avg(avg_speed)', 2)} AS vitesse_moyenne_kmh, {_settled('avg(avg_occupancy_rate)', 2)} AS taux_occupation_moyen,
 CAST(sum(total_vehicles) AS BIGINT) AS total_vehicules_zone, CAST(sum(event_count) AS BIGINT) AS nombre_mesures,
 max(max_vehicles) AS pic_trafic, min(min_speed) AS vitesse_minimale,
 {_settled('stddev_samp(avg_vehicle_count)', 2)} AS variabilite_trafic FROM zone_hour GROUP BY zone""",
    "strategic": f"""SELECT *, CASE WHEN taux_occupation_moyen > 0
   THEN round(vitesse_moyenne_kmh / taux_occupation_moyen, 2) ELSE CAST(0 AS DOUBLE) END AS efficacite_circulation,
 {_service('vitesse_moyenne_kmh')} AS niveau_service FROM strategic0""",
    "analysis": f"""SELECT *, {_band('congestion_rate_percent')} AS niveau_congestion,
 {_band_priority('congestion_rate_percent')} AS priorite_intervention,
 round(congestion_rate_percent * CAST(1.5 AS DOUBLE), 2) AS impact_estime_minutes FROM zones""",
    "hourly0": f"""SELECT hour, {_settled('avg(avg_vehicles)', 2)} AS trafic_horaire_moyen,
 {_settled('avg(avg_speed)', 2)} AS vitesse_horaire_moyenne, {_settled('avg(avg_occupancy)', 2)} AS occupation_horaire_moyenne,
 CAST(sum(event_count) AS BIGINT) AS total_mesures_heure FROM hours GROUP BY hour""",
    "hourly": f"""SELECT *, {_period('hour')} AS periode_journee, CASE WHEN vitesse_horaire_moyenne > 0
   THEN round(occupation_horaire_moyenne / vitesse_horaire_moyenne, 3) ELSE CAST(0 AS DOUBLE) END
   AS ratio_occupation_vitesse FROM hourly0""",
    "overview": f"""SELECT 'Rapport Trafic Urbain' AS titre_rapport,
 {_settled('(SELECT avg(congestion_rate_percent) FROM zones)', 2)} AS taux_congestion_moyen,
 {_settled('(SELECT avg(avg_speed) FROM roads)', 2)} AS vitesse_moyenne_globale,
 CAST((SELECT sum(total_vehicles) FROM zone_hour) AS BIGINT) AS total_vehicules_jour,
 (SELECT count(*) FROM zones) AS zones_surveillees""",
    "traffic2": f"""SELECT *, {_traffic('trafic_moyen_vehicules_heure')} AS niveau_trafic FROM (
 SELECT zone, count(*) AS nombre_mesures, avg(vehicle_count) AS trafic_moyen_vehicules_heure,
 CAST(sum(vehicle_count) AS BIGINT) AS trafic_total, max(vehicle_count) AS pic_trafic,
 stddev_samp(vehicle_count) AS variabilite_trafic FROM readings GROUP BY zone)""",
    "speed2": f"""SELECT *, {_fluid('vitesse_moyenne_kmh')} AS niveau_fluidite FROM (
 SELECT zone, avg(speed) AS vitesse_moyenne_kmh, min(speed) AS vitesse_minimale, max(speed) AS vitesse_maximale,
 stddev_samp(speed) AS ecart_type_vitesse FROM readings GROUP BY zone)""",
    "congestion2": f"""SELECT *, {_level('taux_congestion_pourcentage')} AS niveau_congestion,
 {_level_priority('taux_congestion_pourcentage')} AS priorite_intervention FROM (
 SELECT zone, count(*) AS total_mesures, count(*) FILTER (WHERE speed < 30) AS mesures_congestionnees,
 avg(occupancy) AS taux_occupation_moyen, avg(speed) AS vitesse_moyenne,
 CAST(count(*) FILTER (WHERE speed < 30) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS taux_congestion_pourcentage
 FROM readings GROUP BY zone)""",
    "evolution": f"""SELECT *, {_rush('heure')} AS periode_journee FROM (
 SELECT CAST(hour(timestamp) AS INTEGER) AS heure, dayname(timestamp) AS jour_semaine,
 avg(vehicle_count) AS trafic_horaire_moyen, avg(speed) AS vitesse_horaire_moyenne,
 avg(occupancy) AS occupation_horaire_moyenne, count(*) AS nombre_mesures FROM readings GROUP BY 1, 2)""",
    "critical": f"""SELECT t.zone, t.trafic_moyen_vehicules_heure, t.niveau_trafic, c.taux_congestion_pourcentage,
 c.niveau_congestion, c.priorite_intervention, {_zone_status('t.niveau_trafic', 'c.niveau_congestion')} AS statut_zone
 FROM traffic2 t JOIN congestion2 c ON t.zone = c.zone""",
    "weekly": """SELECT CAST(hour(event_time) AS INTEGER) AS hour, CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week,
 avg(vehicle_count) AS avg_traffic, avg(average_speed) AS avg_speed, avg(occupancy_rate) AS avg_occupancy,
 count(*) AS sample_count FROM traffic GROUP BY 1, 2""",
    "routes": """SELECT road_id, road_type, zone, avg(average_speed) AS avg_speed, avg(occupancy_rate) AS avg_occupancy,
 count(*) AS total_measurements, count(*) FILTER (WHERE average_speed < 30) AS congestion_events,
 CAST(count(*) FILTER (WHERE average_speed < 30) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS congestion_rate
 FROM traffic GROUP BY 1, 2, 3""",
    "slow": """SELECT road_id, avg(average_speed) AS avg_speed FROM traffic GROUP BY 1 HAVING avg(average_speed) < 40
 ORDER BY 2, 1 LIMIT 5""",
    "worst": """SELECT zone, niveau_congestion, congestion_rate_percent, priorite_intervention, impact_estime_minutes
 FROM analysis ORDER BY congestion_rate_percent DESC, zone LIMIT 10""",
    "lenient": """SELECT coalesce(zone, 'Unknown') AS zone, count(*) AS event_count,
 round(avg(coalesce(average_speed, 0)), 2) AS avg_speed, round(avg(coalesce(vehicle_count, 0)), 2) AS avg_vehicles
 FROM traffic GROUP BY 1""",
    "hour_parts": f"""SELECT zone, event_time, vehicle_count, average_speed, {CONGESTED} AS congested FROM traffic""",
    "metrics": """SELECT zone, timestamp, period, metric_name, metric_value, metric_unit FROM (
 SELECT zone, period, timestamp, avg(vehicle_count) AS v, avg(average_speed) AS s,
  CAST(count(*) FILTER (WHERE congested) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS c FROM (
   SELECT *, 'hourly' AS period, date_trunc('hour', event_time) AS timestamp FROM hour_parts
   UNION ALL SELECT *, 'daily', CAST(date_trunc('day', event_time) AS TIMESTAMP) FROM hour_parts
   UNION ALL SELECT *, 'weekly', CAST(date_trunc('week', event_time) AS TIMESTAMP) FROM hour_parts)
  GROUP BY 1, 2, 3) CROSS JOIN LATERAL (VALUES ('traffic_volume', v, 'vehicles/hour'), ('average_speed', s, 'km/h'),
   ('congestion_rate', c, '%')) AS m(metric_name, metric_value, metric_unit)""",
    "halves": """SELECT zone, vehicle_count, average_speed,
 (hour(event_time) BETWEEN 7 AND 9 OR hour(event_time) BETWEEN 16 AND 19) AS peak,
 dayofweek(event_time) BETWEEN 1 AND 5 AS weekday FROM traffic""",
    "zone_cmp": """SELECT 'zone_vs_zone' AS comparison_type, a.zone AS zone1, b.zone AS zone2, a.m AS metric_name,
 round(a.v, 6) AS value1, round(b.v, 6) AS value2, round((a.v - b.v) / b.v * 100, 6) AS percentage_diff,
 'whole_period' AS time_period FROM zone_means a JOIN zone_means b ON a.m = b.m
 WHERE a.zone = 'Centre-Ville' AND b.zone <> 'Centre-Ville'""",
    "zone_means": """SELECT zone, 'traffic_volume' AS m, avg(vehicle_count) AS v FROM traffic GROUP BY 1
 UNION ALL SELECT zone, 'average_speed', avg(average_speed) FROM traffic GROUP BY 1""",
    "peak_cmp": """SELECT 'time_period' AS comparison_type, zone AS zone1, zone AS zone2, m AS metric_name,
 round(v1, 6) AS value1, round(v2, 6) AS value2, round((v1 - v2) / v2 * 100, 6) AS percentage_diff,
 'peak_vs_offpeak' AS time_period FROM (
  SELECT zone, 'traffic_volume' AS m, avg(vehicle_count) FILTER (WHERE peak) AS v1,
   avg(vehicle_count) FILTER (WHERE NOT peak) AS v2 FROM halves GROUP BY 1
  UNION ALL SELECT zone, 'average_speed', avg(average_speed) FILTER (WHERE peak),
   avg(average_speed) FILTER (WHERE NOT peak) FROM halves GROUP BY 1)""",
    "week_cmp": """SELECT 'weekday_vs_weekend' AS comparison_type, zone AS zone1, zone AS zone2, m AS metric_name,
 round(v1, 6) AS value1, round(v2, 6) AS value2, round((v1 - v2) / v2 * 100, 6) AS percentage_diff,
 'weekday_vs_weekend' AS time_period FROM (
  SELECT zone, 'traffic_volume' AS m, avg(vehicle_count) FILTER (WHERE weekday) AS v1,
   avg(vehicle_count) FILTER (WHERE NOT weekday) AS v2 FROM halves GROUP BY 1
  UNION ALL SELECT zone, 'average_speed', avg(average_speed) FILTER (WHERE weekday),
   avg(average_speed) FILTER (WHERE NOT weekday) FROM halves GROUP BY 1)""",
    "flow": f"""SELECT printf('ROAD_%04d', CAST(1 + l.l_suppkey % 100 AS INT)) AS road_id,
 {_case('s.s_nationkey % 6', ZONES)} AS from_zone, {_case('c.c_nationkey % 6', ZONES)} AS to_zone, CAST(l.l_quantity AS BIGINT) AS flow_volume,
 CAST(20 AS DOUBLE) + CAST((l.l_partkey * 7) % 320 AS DOUBLE) / CAST(4 AS DOUBLE) AS average_speed,
 {_case('(s.s_nationkey + 3 * c.c_nationkey) % 8', DIRECTIONS)} AS direction, l.l_shipdate AS timestamp
 FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
 JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "coords": """SELECT * FROM (VALUES
 ('Centre_Ville', 33.5731, -7.5898, 'Casablanca Centre', 'Urban'),
 ('Centre_Commercial', 33.5789, -7.6328, 'Maarif District', 'Commercial'),
 ('Périphérie_Nord', 33.6157, -7.5285, 'Hay Hassani', 'Residential'),
 ('Périphérie_Sud', 33.5333, -7.5833, 'Ain Diab', 'Coastal'),
 ('Quartier_Résidentiel', 33.6014, -7.6317, 'Racine', 'Residential'),
 ('Quartier_Est', 33.5731, -7.5898, 'Lissasfa', 'Mixed'),
 ('Zone_Industrielle', 33.5478, -7.6578, 'Ain Sebaa', 'Industrial'),
 ('Zone_Commerciale', 33.5789, -7.6328, 'Gauthier', 'Commercial')) AS t(zone, latitude, longitude, zone_name, zone_type)""",
    "canon": """SELECT replace(replace(replace(zone, '-', '_'), 'Peripherie', 'Périphérie'), 'Residentiel', 'Résidentiel')
 AS zone, avg(vehicle_count) AS t FROM traffic GROUP BY 1""",
    "dirty": f"""SELECT event_id, vehicle_count, CASE event_type WHEN 'view' THEN replace(a, 'é', '�') WHEN 'click' THEN a
   ELSE zone END AS zone,
 {_case('vehicle_count % 6', ['Critique', 'Élevé', 'Modéré', 'Faible', '�lev�', 'Mod�r�'])} AS label
 FROM (SELECT *, replace(replace(replace(zone, '-', '_'), 'Peripherie', 'Périphérie'), 'Residentiel', 'Résidentiel') AS a
  FROM traffic)""",
    "win": f"""SELECT date_trunc('hour', event_time) AS window_start,
 date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end, road_id, zone,
 avg(vehicle_count) AS avg_vehicle_count, avg(average_speed) AS avg_speed, avg(occupancy_rate) AS avg_occupancy_rate,
 count(*) AS event_count, max(vehicle_count) AS max_vehicles, min(average_speed) AS min_speed
 FROM traffic GROUP BY 1, 2, 3, 4""",
    "tagged": f"""SELECT *, {_alert('avg_vehicle_count', 'avg_speed', 'avg_occupancy_rate')} AS alert_type FROM win""",
    "episodes": """SELECT *, sum(CASE WHEN alert_type IS NULL THEN 1 ELSE 0 END) OVER
 (PARTITION BY road_id, zone ORDER BY window_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ep FROM tagged""",
    "quiet": "SELECT road_id, zone, ep - 1 AS ep, window_end AS resolved_at FROM episodes WHERE alert_type IS NULL",
    "last_seen": """SELECT * FROM episodes WHERE alert_type IS NOT NULL QUALIFY row_number() OVER
 (PARTITION BY road_id, zone, ep, alert_type ORDER BY window_end DESC) = 1""",
    "ends": """SELECT alert_type, road_id, zone, ep, min(window_end) AS opened_at, max(window_end) AS last_update,
 list(CAST(epoch(window_end) AS BIGINT) ORDER BY window_end) AS moments,
 CASE alert_type WHEN 'HIGH_CONGESTION' THEN 300 WHEN 'MODERATE_CONGESTION' THEN 600 ELSE 900 END AS lim
 FROM episodes WHERE alert_type IS NOT NULL GROUP BY 1, 2, 3, 4""",
    "opened": """SELECT alert_type, road_id, zone, ep, opened_at, last_update, list_reduce(
 list_transform(moments, lambda t: {'at': t, 'was': t, 'n': 0}), lambda a, b: {'at': b['at'],
  'was': CASE WHEN b['at'] - a['was'] > lim THEN b['at'] ELSE a['was'] END,
  'n': CASE WHEN b['at'] - a['was'] > lim THEN a['n'] + 1 ELSE a['n'] END})['n'] AS again FROM ends""",
    "alerts": f"""SELECT o.alert_type || '_' || o.road_id || '_' || o.zone || '_' || CAST(epoch(o.opened_at) AS BIGINT)
   AS alert_id, o.alert_type, {_severity('o.alert_type')} AS severity, o.road_id, o.zone,
 l.avg_vehicle_count AS vehicle_count, l.avg_speed AS average_speed, l.avg_occupancy_rate AS occupancy_rate,
 o.opened_at AS timestamp, CASE WHEN q.resolved_at IS NULL THEN 'ACTIVE' ELSE 'RESOLVED' END AS status,
 CAST(o.again AS INTEGER) AS escalation_count, o.last_update, q.resolved_at,
 CAST(epoch(q.resolved_at) - epoch(o.opened_at) AS BIGINT) AS duration_seconds
 FROM opened o JOIN last_seen l ON o.road_id = l.road_id AND o.zone = l.zone AND o.ep = l.ep AND o.alert_type = l.alert_type
 LEFT JOIN quiet q ON o.road_id = q.road_id AND o.zone = q.zone AND o.ep = q.ep""",
    "recent": """SELECT alert_type, severity, count(*) AS count, avg(vehicle_count) AS avg_vehicles,
 avg(average_speed) AS avg_speed, avg(occupancy_rate) AS avg_occupancy FROM alerts, now
 WHERE timestamp >= as_of - INTERVAL 240 HOUR GROUP BY 1, 2""",
    "snaps": """SELECT zone, date_trunc('hour', event_time) AS processed_at, avg(vehicle_count) AS trafic_moyen_vehicules_heure,
 avg(average_speed) AS vitesse_moyenne_kmh FROM traffic GROUP BY 1, 2""",
    "daily": """SELECT zone, CAST(date_trunc('day', event_time) AS TIMESTAMP) AS observed, avg(vehicle_count) AS trafic,
 count(*) AS mesures FROM traffic GROUP BY 1, 2""",
    "history": f"""SELECT *, CASE WHEN next_speed < 30 THEN 1.0 WHEN next_occupancy > 70 THEN 1.0 ELSE 0.0 END AS target
 FROM (SELECT *, lag(vehicle_count, 1) OVER w AS vehicle_count_lag1, lag(vehicle_count, 2) OVER w AS vehicle_count_lag2,
 lag(average_speed, 1) OVER w AS speed_lag1, lag(average_speed, 2) OVER w AS speed_lag2,
 lag(occupancy_rate, 1) OVER w AS occupancy_lag1, lag(occupancy_rate, 2) OVER w AS occupancy_lag2,
 avg(vehicle_count) OVER r AS vehicle_count_ma3, avg(average_speed) OVER r AS speed_ma3,
 avg(occupancy_rate) OVER r AS occupancy_ma3, stddev_samp(vehicle_count) OVER r AS vehicle_count_std3,
 stddev_samp(average_speed) OVER r AS speed_std3, lead(vehicle_count, 1) OVER w AS vehicle_count_target,
 lead(average_speed, 1) OVER w AS next_speed, lead(occupancy_rate, 1) OVER w AS next_occupancy FROM traffic
 WINDOW w AS (PARTITION BY road_id, zone ORDER BY event_time, sensor_id),
 r AS (PARTITION BY road_id, zone ORDER BY event_time, sensor_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))""",
}


PARTS["closed_win"] = "SELECT * FROM win WHERE window_end <= (SELECT as_of FROM now) - INTERVAL 2 MINUTE"
PARTS["minute_win"] = (
    PARTS["win"].replace("'hour'", "'minute'").replace("1 HOUR", "1 MINUTE")
)
# The alert parts again: over the windows a stream has closed, and over windows of a minute.
_CHAIN = ("tagged", "episodes", "quiet", "last_seen", "ends", "opened", "alerts")
for _prefix in ("closed", "minute"):
    for _name in _CHAIN:
        _text = PARTS[_name]
        for _other in ("win", *_CHAIN):
            _text = re.sub(rf"\b(FROM|JOIN) {_other}\b", rf"\1 {_prefix}_{_other}", _text)
        PARTS[f"{_prefix}_{_name}"] = _text


def _or_zero(*names: str) -> str:
    return ", ".join(f"coalesce({n}, 0) AS {n}" for n in names)


FEATURE_SQL = f"""SELECT event_id, CAST(hour(event_time) AS INTEGER) AS hour,
 CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week, CAST(month(event_time) AS INTEGER) AS month,
 CAST(year(event_time) AS INTEGER) AS year, vehicle_count_target, round(next_speed, 6) AS speed_target,
 CAST(target AS DOUBLE) AS congestion_target, {_or_zero('vehicle_count_lag1', 'vehicle_count_lag2')},
 {', '.join(f'round(coalesce({n}, 0), 6) AS {n}' for n in (
    'speed_lag1', 'speed_lag2', 'occupancy_lag1', 'occupancy_lag2', 'vehicle_count_ma3', 'speed_ma3', 'occupancy_ma3',
    'vehicle_count_std3', 'speed_std3'))}
 FROM history WHERE vehicle_count_target IS NOT NULL AND next_speed IS NOT NULL"""


def _serving(part: str, columns: dict[str, str]) -> str:
    # By way of a wide decimal: a double like 0.145 is a little off the half it stands for.
    wide = lambda c, t: f"CAST({c} AS DECIMAL(24,12))" if t.startswith("DECIMAL") else c
    return "SELECT " + ", ".join(f"CAST({wide(c, t)} AS {t}) AS {c}" for c, t in columns.items()) + f" FROM {part}"


D2 = "DECIMAL(10,2)"
LIKE_REPAIR = """CASE WHEN zone NOT LIKE '%�%' AND zone NOT LIKE '%P%riph%' AND zone NOT LIKE '%Quartier_R%' THEN zone
 WHEN zone LIKE '%P%riph%rie_Nord%' THEN 'Périphérie_Nord' WHEN zone LIKE '%P%riph%rie_Sud%' THEN 'Périphérie_Sud'
 WHEN zone LIKE '%Quartier_R%sidentiel%' THEN 'Quartier_Résidentiel' ELSE replace(zone, '�', 'é') END"""
EXACT_REPAIR = """CASE zone WHEN 'P�riph�rie_Nord' THEN 'Périphérie_Nord' WHEN 'P�riph�rie_Sud' THEN 'Périphérie_Sud'
 WHEN 'Quartier_R�sidentiel' THEN 'Quartier_Résidentiel' ELSE zone END"""
CANONICAL = """replace(replace(replace(replace(zone, '-', '_'), '�', 'é'), 'Peripherie', 'Périphérie'),
 'Residentiel', 'Résidentiel')"""
LABEL_REPAIR = """CASE WHEN label LIKE '%�%' OR label LIKE '%lev%' OR label LIKE '%Mod%' THEN
 CASE WHEN label LIKE '%lev%' THEN 'Élevé' WHEN label LIKE '%Mod%' THEN 'Modéré' ELSE 'Faible' END ELSE label END"""
TRAFFIC_LABEL = """CASE WHEN label LIKE '%lev%' OR hex(label) LIKE '%C389%' THEN 'Élevé' ELSE label END"""
BARE_JSON = _fields('"', "", ISO)
SHOWN = "CAST(CAST(round({0}, 1) AS DECIMAL(20,1)) AS VARCHAR)"
MAIL_FACTS = """'- Type: ' || alert_type || chr(10) || '- Sévérité: ' || severity || chr(10) || '- Route: ' || road_id
 || chr(10) || '- Zone: ' || zone || chr(10) || '- Véhicules: ' || coalesce(CAST(vehicle_count AS VARCHAR), 'N/A')
 || chr(10) || '- Vitesse: ' || coalesce(CAST(average_speed AS VARCHAR), 'N/A') || ' km/h' || chr(10)
 || '- Taux occupation: ' || coalesce(CAST(occupancy_rate AS VARCHAR), 'N/A') || '%'"""
CHAT_FACTS = MAIL_FACTS.replace("'- ", "'*").replace(": '", ":* '")

LANDED = """SELECT date, zone, count(*) AS messages, CAST(sum(length(value)) AS BIGINT) AS characters FROM (
 SELECT CASE WHEN l.event_type IN ('view', 'click') THEN strftime(t.event_time, '%Y-%m-%d') ELSE 'quarantine' END AS date,
 CASE WHEN l.event_type IN ('view', 'click', 'signup') THEN replace(t.zone, '-', '_') ELSE 'Unknown' END AS zone, l.value
 FROM lines l JOIN traffic t ON l.event_id = t.event_id) GROUP BY 1, 2"""

BODIES = {
    "i1_raw_text_read": "SELECT count(*) AS lines, CAST(sum(length(value)) AS BIGINT) AS characters FROM lines",
    "i2_non_blank_lines": "SELECT event_id, event_type, value FROM lines WHERE trim(value) <> ''",
    "i3_repaired_json": f"""SELECT event_id, CASE event_type WHEN 'purchase' THEN {BARE_JSON} ELSE {JSON_LINE} END AS json_str
 FROM traffic""",
    "i4_regex_repaired_json": """SELECT event_id, CASE event_type WHEN 'signup' THEN '{"sensor_id":"' || sensor_id || '","road_id":"'
 || road_id || '","road_type":"' || road_type || '","zone":"' || zone || '","vehicle_count":"' || vehicle_count
 || '","average_speed":"' || coalesce(CAST(average_speed AS VARCHAR), 'null') || '","occupancy_rate":"'
 || coalesce(CAST(occupancy_rate AS VARCHAR), 'null') || '","event_time":"n/a"}' END AS json_str FROM traffic
 UNION ALL SELECT event_id, NULL FROM traffic WHERE event_type = 'error'""",
    "i5_parsed_events": f"""SELECT event_id, sensor_id, road_id, road_type, zone, vehicle_count, average_speed,
 occupancy_rate, {TIME_KEPT} AS event_time FROM traffic WHERE event_type IN ('view', 'click', 'purchase')""",
    "i6_strict_json_read": f"""SELECT sensor_id, road_id, road_type, zone, CAST(vehicle_count AS DOUBLE) AS vehicle_count,
 average_speed, occupancy_rate, {TIME_KEPT} AS event_time FROM traffic WHERE event_type IN ('view', 'click')""",
    "i7_decodable_lines": "SELECT event_id, value FROM lines WHERE event_type IN ('view', 'click', 'signup')",
    "i8_event_time_formats": f"""SELECT event_id, {TIME_KEPT} AS event_time FROM traffic
 UNION ALL SELECT event_id, NULL FROM traffic WHERE event_type = 'error'""",
    "i9_second_precision": """SELECT event_id, event_second, event_second IS NULL AS quarantined FROM (
 SELECT event_id, CASE WHEN event_type IN ('view', 'click', 'purchase') THEN date_trunc('second', event_time) END
 AS event_second FROM traffic UNION ALL SELECT event_id, NULL FROM traffic WHERE event_type = 'error')""",
    "i10_rejected_lines": """SELECT value, CASE WHEN trim(value) = '' THEN 'blank' WHEN event_type = 'error' THEN 'bad_json'
 ELSE 'bad_time' END AS reject_reason FROM lines WHERE event_type IN ('error', 'signup')""",
    "i10_ingest_rejects": """SELECT value, CASE WHEN trim(value) = '' THEN 'blank' WHEN event_type = 'error' THEN 'bad_json'
 ELSE 'bad_time' END AS reject_reason FROM lines WHERE event_type IN ('error', 'signup')""",
    "i11_day_parts": """SELECT event_id, CAST(hour(event_time) AS INTEGER) AS hour,
 strftime(event_time, '%Y-%m-%d') AS date_str FROM traffic""",
    "i12_calendar": """SELECT event_id, CAST(hour(event_time) AS INTEGER) AS hour,
 CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week, CAST(month(event_time) AS INTEGER) AS month,
 CAST(year(event_time) AS INTEGER) AS year, strftime(event_time, '%Y-%m-%d') AS date FROM traffic""",
    "i13_null_counts": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM traffic"
        for c in ("event_id", "sensor_id", "road_id", "road_type", "zone", "vehicle_count", "average_speed",
                  "occupancy_rate", "event_time", "event_type")),
    "i14_load_profile": """SELECT count(*) AS total_rows, count(vehicle_count) AS vehicle_count_present,
 count(average_speed) AS average_speed_present, count(occupancy_rate) AS occupancy_rate_present,
 min(event_time) AS first_event, max(event_time) AS last_event FROM traffic""",
    "i15_reject_counts": """SELECT CASE WHEN trim(value) = '' THEN 'blank' WHEN event_type = 'error' THEN 'bad_json'
 WHEN event_type = 'signup' THEN 'bad_time' ELSE 'accepted' END AS reason, count(*) AS lines FROM lines GROUP BY 1""",
    "i15_stage_counts": """SELECT count(*) AS raw_lines, count(*) FILTER (WHERE trim(value) <> '') AS non_blank,
 count(*) FILTER (WHERE event_type <> 'error') AS converted,
 count(*) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS accepted,
 count(*) FILTER (WHERE event_type = 'signup') AS bad_time FROM lines""",
    "i15_ingest_counts": """SELECT count(*) AS raw_lines, count(*) FILTER (WHERE trim(value) <> '') AS non_blank,
 count(*) FILTER (WHERE event_type <> 'error') AS converted,
 count(*) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS accepted,
 count(*) FILTER (WHERE event_type = 'signup') AS bad_time FROM lines""",
    "i16_period_covered": """SELECT min(strftime(event_time, '%Y-%m-%d')) AS first_date,
 max(strftime(event_time, '%Y-%m-%d')) AS last_date FROM traffic""",
    "i17_volume_gates": """SELECT g.c AS "check", CAST(g.m AS BIGINT) AS minimum, n AS actual, n >= g.m AS passed
 FROM (SELECT count(*) AS n FROM traffic), (VALUES ('not_empty', 1), ('history', 100), ('traffic_model', 50),
 ('congestion_model', 20)) AS g(c, m)""",
    "i18_processed_zone_read": """SELECT 'traffic_by_zone' AS dataset, (SELECT count(*) FROM zone_hour) AS rows, 11 AS columns
 UNION ALL SELECT 'speed_by_road', (SELECT count(*) FROM roads), 10
 UNION ALL SELECT 'congestion_by_zone', (SELECT count(*) FROM zones), 7
 UNION ALL SELECT 'hourly_analysis', (SELECT count(*) FROM hours), 7""",
    "i20_catalog_read": "SELECT * FROM roads",
    "i21_coordinate_merge": """SELECT coalesce(c.zone, n.zone) AS zone,
 CAST(coalesce(n.lat, c.latitude) AS DECIMAL(10,8)) AS latitude, CAST(coalesce(n.lon, c.longitude) AS DECIMAL(11,8)) AS longitude,
 coalesce(c.zone_name, 'Capteurs ' || n.zone) AS zone_name, coalesce(c.zone_type, 'Observed') AS zone_type
 FROM coords c FULL JOIN (SELECT zone, CAST(30 + CAST(count(*) AS DOUBLE) / 1000000 AS DECIMAL(10,8)) AS lat,
  CAST(-7 - CAST(count(*) AS DOUBLE) / 1000000 AS DECIMAL(11,8)) AS lon
  FROM (SELECT replace(replace(replace(zone, '-', '_'), 'Peripherie', 'Périphérie'), 'Residentiel', 'Résidentiel') AS zone
   FROM traffic) GROUP BY 1) n ON c.zone = n.zone""",
    "i22_kpi_input": """SELECT timestamp, zone, vehicle_count, speed, round(occupancy, 12) AS occupancy, service_level,
 sensor_id, road_type FROM readings""",
    "k1_partitioned_write": "SELECT * FROM zone_hour",
    "k1_write_check": "SELECT count(*) AS rows, count(DISTINCT (zone, hour)) AS partitions FROM zone_hour",
    "k2_analytics_zone": """SELECT 'kpi_zone_strategique' AS dataset, (SELECT count(*) FROM strategic) AS rows, 12 AS columns
 UNION ALL SELECT 'performance_routes', (SELECT count(*) FROM roads), 13
 UNION ALL SELECT 'analyse_congestion', (SELECT count(*) FROM zones), 10
 UNION ALL SELECT 'analyse_temporelle', (SELECT count(*) FROM hourly), 8
 UNION ALL SELECT 'tableau_bord_executif', 1, 6""",
    "k3_replace_rows": """SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY zone ORDER BY observed DESC) = 1""",
    "k3_update_columns": """SELECT f.zone, f.observed, l.trafic, f.mesures FROM
 (SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY zone ORDER BY observed) = 1) f JOIN
 (SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY zone ORDER BY observed DESC) = 1) l ON f.zone = l.zone""",
    "k3_versions": """SELECT *, 0 AS version FROM daily QUALIFY row_number() OVER (PARTITION BY zone ORDER BY observed) = 1
 UNION ALL SELECT f.zone, f.observed, l.trafic, f.mesures, 1 FROM
 (SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY zone ORDER BY observed) = 1) f JOIN
 (SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY zone ORDER BY observed DESC) = 1) l ON f.zone = l.zone
 UNION ALL SELECT *, 2 FROM daily QUALIFY row_number() OVER (PARTITION BY zone ORDER BY observed DESC) = 1""",
    "k3_touched_files": """SELECT count(*) AS rows, count(*) FILTER (o = m) AS merged, CAST(sum(n) FILTER (o < m) AS BIGINT) AS mesures,
 true AS rewrote_only_touched FROM (SELECT zone, date_trunc('hour', event_time) AS o, count(*) AS n,
 max(date_trunc('hour', event_time)) OVER () AS m FROM traffic GROUP BY 1, 2 ORDER BY 1)""",
    "k5_serving_trafic_par_zone": _serving("traffic2", {
        "zone": "VARCHAR", "nombre_mesures": "BIGINT", "trafic_moyen_vehicules_heure": D2, "trafic_total": "BIGINT",
        "pic_trafic": "BIGINT", "variabilite_trafic": D2, "niveau_trafic": "VARCHAR"}),
    "k5_serving_vitesse_moyenne": _serving("speed2", {
        "zone": "VARCHAR", "vitesse_moyenne_kmh": D2, "vitesse_minimale": D2, "vitesse_maximale": D2,
        "ecart_type_vitesse": D2, "niveau_fluidite": "VARCHAR"}),
    "k5_serving_taux_congestion": _serving("congestion2", {
        "zone": "VARCHAR", "total_mesures": "BIGINT", "mesures_congestionnees": "BIGINT", "taux_occupation_moyen": D2,
        "vitesse_moyenne": D2, "taux_congestion_pourcentage": D2, "niveau_congestion": "VARCHAR",
        "priorite_intervention": "INTEGER"}),
    "k5_serving_zones_critiques": _serving("critical", {
        "zone": "VARCHAR", "trafic_moyen_vehicules_heure": D2, "niveau_trafic": "VARCHAR",
        "taux_congestion_pourcentage": D2, "niveau_congestion": "VARCHAR", "priorite_intervention": "INTEGER",
        "statut_zone": "VARCHAR"}),
    "k5_serving_evolution_trafic": _serving("evolution", {
        "heure": "INTEGER", "jour_semaine": "VARCHAR", "trafic_horaire_moyen": D2, "vitesse_horaire_moyenne": D2,
        "occupation_horaire_moyenne": D2, "nombre_mesures": "BIGINT", "periode_journee": "VARCHAR"}),
    "k5_serving_traffic_alerts": _serving("alerts", {
        "alert_id": "VARCHAR", "alert_type": "VARCHAR", "severity": "VARCHAR", "road_id": "VARCHAR", "zone": "VARCHAR",
        "average_speed": "DECIMAL(5,2)", "occupancy_rate": "DECIMAL(5,2)",
        "timestamp": "TIMESTAMP", "status": "VARCHAR", "escalation_count": "INTEGER", "resolved_at": "TIMESTAMP",
        "duration_seconds": "INTEGER"}).replace(" FROM alerts", ", CAST(trunc(vehicle_count) AS INTEGER) AS vehicle_count FROM alerts"),
    "k5_serving_kpi_metrics": _serving("metrics", {
        "metric_name": "VARCHAR", "metric_value": D2, "metric_unit": "VARCHAR", "zone": "VARCHAR", "timestamp": "TIMESTAMP",
        "period": "VARCHAR"}),
    "k5_serving_traffic_flow": _serving("flow", {
        "road_id": "VARCHAR", "from_zone": "VARCHAR", "to_zone": "VARCHAR", "flow_volume": "INTEGER",
        "average_speed": "DECIMAL(5,2)", "direction": "VARCHAR", "timestamp": "TIMESTAMP"}),
    "k5_serving_traffic_predictions": _serving("preds", {
        "zone": "VARCHAR", "prediction_timestamp": "TIMESTAMP", "predicted_traffic": D2, "predicted_speed": "DECIMAL(5,2)",
        "confidence_score": "DECIMAL(3,2)", "prediction_horizon_hours": "INTEGER", "model_version": "VARCHAR"}),
    "k5_serving_zone_coordinates": """SELECT zone, CAST(latitude AS DECIMAL(10,8)) AS latitude,
 CAST(longitude AS DECIMAL(11,8)) AS longitude, zone_name, zone_type FROM coords WHERE zone IN (SELECT zone FROM canon)""",
    "k5_serving_comparative_analytics": _serving(
        "(SELECT * FROM zone_cmp UNION ALL SELECT * FROM peak_cmp UNION ALL SELECT * FROM week_cmp) JOIN now ON true", {
        "comparison_type": "VARCHAR", "zone1": "VARCHAR", "zone2": "VARCHAR", "metric_name": "VARCHAR", "value1": D2,
        "value2": D2, "percentage_diff": D2, "time_period": "VARCHAR"}).replace(" FROM (", ", as_of AS timestamp FROM ("),
    "k6_catalog_tables": """SELECT 'zone_kpi_zone_strategique' AS "table", (SELECT count(*) FROM strategic) AS rows
 UNION ALL SELECT 'zone_performance_routes', (SELECT count(*) FROM roads)
 UNION ALL SELECT 'zone_analyse_congestion', (SELECT count(*) FROM zones)
 UNION ALL SELECT 'zone_analyse_temporelle', (SELECT count(*) FROM hourly)
 UNION ALL SELECT 'zone_tableau_bord_executif', 1""",
    "k7_keyed_messages": f"SELECT coalesce(zone, 'default') AS key, {_fields(chr(34), '', ISO_MICROS)} AS value FROM traffic",
    "n1_path_safe_zone": _repaired("zone", "replace(replace(zone, ' ', '_'), '-', '_')"),
    "n2_restored_accents": _repaired("zone", "replace(zone, '�', 'é')"),
    "n3_zone_by_pattern": _repaired("zone", LIKE_REPAIR),
    "n4_zone_by_map": _repaired("zone", EXACT_REPAIR),
    "n5_canonical_zone": _repaired("zone", CANONICAL),
    "n6_congestion_label": _repaired("label", LABEL_REPAIR),
    "n7_traffic_label": _repaired("label", TRAFFIC_LABEL),
    "r_event_rules": f"""SELECT event_id, {CONGESTED} AS is_congested, {_letter('average_speed')} AS service_letter,
 alert_type, {_severity('alert_type')} AS severity, CASE alert_type WHEN 'HIGH_CONGESTION' THEN 300
 WHEN 'MODERATE_CONGESTION' THEN 600 WHEN 'LOW_CONGESTION' THEN 900 END AS escalation_seconds,
 {_service('average_speed')} AS service_level, {_score('average_speed')} AS performance_score,
 {_status('average_speed')} AS road_status, {_fluid('average_speed')} AS fluidity,
 {_traffic('vehicle_count')} AS traffic_level, {_density('vehicle_count')} AS density,
 {_marker('vehicle_count')} AS marker_density
 FROM (SELECT *, {_alert('vehicle_count', 'average_speed', 'occupancy_rate')} AS alert_type FROM traffic)""",
    "r_rate_rules": f"""SELECT event_id, {_band('occupancy_rate')} AS band, {_band_priority('occupancy_rate')} AS band_priority,
 round(occupancy_rate * CAST(1.5 AS DOUBLE), 2) AS impact_minutes, {_level('occupancy_rate')} AS level,
 {_level_priority('occupancy_rate')} AS level_priority, {_rate_severity('occupancy_rate')} AS severity,
 {_state('occupancy_rate')} AS state, {_period('hour(event_time)')} AS day_period,
 {_rush('hour(event_time)')} AS rush_period,
 {_zone_status('(' + _traffic('vehicle_count') + ')', '(' + _level('occupancy_rate') + ')')} AS zone_status FROM traffic""",
    "a1_zone_hour_traffic": "SELECT * FROM zone_hour",
    "a2_road_speed": "SELECT * FROM roads",
    "a3_zone_congestion": "SELECT * FROM zones",
    "a4_hourly_zone": "SELECT * FROM hours",
    "a5_strategic_zones": "SELECT * FROM strategic",
    "a6_congestion_analysis": "SELECT * FROM analysis",
    "a7_hourly_analysis": "SELECT * FROM hourly",
    "a8_executive_overview": "SELECT * FROM overview",
    "a8_executive_overview_from_tables": "SELECT * FROM overview",
    "a9_zone_traffic": """SELECT * REPLACE (round(trafic_moyen_vehicules_heure, 6) AS trafic_moyen_vehicules_heure,
 round(variabilite_trafic, 6) AS variabilite_trafic) FROM traffic2""",
    "a10_zone_speed": """SELECT * REPLACE (round(vitesse_moyenne_kmh, 6) AS vitesse_moyenne_kmh,
 round(ecart_type_vitesse, 6) AS ecart_type_vitesse) FROM speed2""",
    "a11_zone_congestion_levels": """SELECT * REPLACE (round(taux_occupation_moyen, 12) AS taux_occupation_moyen,
 round(vitesse_moyenne, 12) AS vitesse_moyenne, round(taux_congestion_pourcentage, 12) AS taux_congestion_pourcentage)
 FROM congestion2""",
    "a12_temporal_evolution": """SELECT * REPLACE (round(trafic_horaire_moyen, 12) AS trafic_horaire_moyen,
 round(vitesse_horaire_moyenne, 12) AS vitesse_horaire_moyenne,
 round(occupation_horaire_moyenne, 12) AS occupation_horaire_moyenne) FROM evolution""",
    "a13_weekly_profile": "SELECT * FROM weekly",
    "a14_road_type_profile": """SELECT road_type, CAST(hour(event_time) AS INTEGER) AS hour,
 round(avg(vehicle_count), 6) AS avg_traffic, round(avg(average_speed), 6) AS avg_speed,
 round(stddev_samp(vehicle_count), 6) AS traffic_variability FROM traffic GROUP BY 1, 2""",
    "a15_peak_periods": "SELECT * FROM weekly WHERE avg_traffic > (SELECT avg(avg_traffic) FROM weekly) * CAST(1.5 AS DOUBLE)",
    "a16_route_congestion": "SELECT * FROM routes",
    "a16_congested_routes": "SELECT * FROM routes WHERE congestion_rate > CAST(0.2 AS DOUBLE)",
    "a17_slow_roads": "SELECT * FROM slow",
    "o4_service_level_order": """SELECT niveau_service, row_number() OVER (ORDER BY substr(niveau_service, 1, 1)) AS position
 FROM (SELECT DISTINCT niveau_service FROM strategic)""",
    "o4_day_period_order": """SELECT periode_journee, row_number() OVER (ORDER BY list_position(['Heures de pointe matin', 'Pleine journée',
 'Heures de pointe soir', 'Soirée', 'Nuit'], periode_journee)) AS position FROM (SELECT DISTINCT periode_journee FROM hourly)""",
    "o1_congestion_order": """SELECT zone, row_number() OVER (ORDER BY congestion_rate_percent DESC, zone) AS position FROM analysis
 ORDER BY 2 LIMIT 10""",
    "a18_network_performance": """SELECT niveau_service, count(*) AS nombre_zones, round(avg(vitesse_moyenne_kmh), 6)
 AS vitesse_moyenne, round(avg(trafic_moyen_vehicules), 6) AS trafic_moyen FROM strategic GROUP BY 1""",
    "a19_period_report": """SELECT periode_journee, round(avg(trafic_horaire_moyen), 6) AS trafic_moyen,
 round(avg(vitesse_horaire_moyenne), 6) AS vitesse_moyenne, round(avg(occupation_horaire_moyenne), 6)
 AS occupation_moyenne FROM hourly GROUP BY 1""",
    "a20_executive_report": """SELECT (SELECT count(DISTINCT zone) FROM strategic) AS zones,
 round((SELECT avg(vitesse_moyenne_kmh) FROM strategic), 6) AS vitesse_moyenne,
 round((SELECT avg(congestion_rate_percent) FROM analysis), 6) AS congestion_moyenne,
 (SELECT count(*) FROM analysis WHERE niveau_congestion = 'Élevée ( > 50%)') AS zones_critiques""",
    "a21_total_impact": f"SELECT {_settled('sum(impact_estime_minutes)', 1)} AS impact_total_minutes FROM worst",
    "a22_recent_alerts": """SELECT alert_type, severity, count, round(avg_vehicles, 6) AS avg_vehicles,
 round(avg_speed, 6) AS avg_speed, round(avg_occupancy, 6) AS avg_occupancy FROM recent""",
    "a23_alert_dashboard": """SELECT 'total_alerts' AS section, 'all' AS key, CAST(sum(count) AS DOUBLE) AS value FROM recent
 UNION ALL SELECT 'average_metrics', 'avg_vehicles', round(avg(avg_vehicles), 6) FROM recent
 UNION ALL SELECT 'average_metrics', 'avg_speed', round(avg(avg_speed), 6) FROM recent
 UNION ALL SELECT 'average_metrics', 'avg_occupancy', round(avg(avg_occupancy), 6) FROM recent
 UNION ALL SELECT 'alerts_by_type', alert_type, CAST(sum(count) AS DOUBLE) FROM recent GROUP BY alert_type
 UNION ALL SELECT 'alerts_by_severity', severity, CAST(sum(count) AS DOUBLE) FROM recent GROUP BY severity
 UNION ALL SELECT 'top_alert_types', alert_type, CAST(count AS DOUBLE) FROM (SELECT * FROM recent
  ORDER BY count DESC, alert_type, severity LIMIT 5)""",
    "a24_active_alerts": """SELECT 'total_active' AS section, 'all' AS key, count(*) AS n FROM alerts WHERE status = 'ACTIVE'
 UNION ALL SELECT 'by_severity', severity, count(*) FROM alerts WHERE status = 'ACTIVE' GROUP BY 2
 UNION ALL SELECT 'by_type', alert_type, count(*) FROM alerts WHERE status = 'ACTIVE' GROUP BY 2
 UNION ALL SELECT 'by_zone', zone, count(*) FROM alerts WHERE status = 'ACTIVE' GROUP BY 2""",
    "a25_lenient_summary": "SELECT * FROM lenient",
    "a26_global_summary": f"""SELECT count(*) AS total_zones, {_settled('avg(avg_speed)', 2)} AS vitesse_globale_moyenne,
 {_settled('avg(avg_vehicles)', 2)} AS trafic_total_moyen, list_sort(list(zone)) AS zones_analysees FROM lenient""",
    "a28_row_counts": """SELECT 'traffic_by_zone' AS "table", (SELECT count(*) FROM zone_hour) AS rows
 UNION ALL SELECT 'speed_by_road', (SELECT count(*) FROM roads)
 UNION ALL SELECT 'congestion_by_zone', (SELECT count(*) FROM zones)
 UNION ALL SELECT 'hourly_analysis', (SELECT count(*) FROM hours)""",
    "a29_serving_checks": """SELECT (SELECT string_agg(DISTINCT niveau_congestion, ', ' ORDER BY niveau_congestion)
  FROM critical) AS niveaux, (SELECT count(*) FROM critical WHERE niveau_congestion <> 'Faible') AS zones_critiques,
 round((SELECT avg(trafic_moyen_vehicules_heure) FROM traffic2), 6) AS trafic_moyen_global""",
    "a30_zone_validation": """SELECT 'raw' AS "check", (SELECT count(*) FROM lines) AS actual, (SELECT count(*) FROM lines) > 0 AS passed
 UNION ALL SELECT 'processed', (SELECT count(*) FROM zone_hour), (SELECT count(*) FROM zone_hour) > 0
 UNION ALL SELECT 'analytics', (SELECT count(*) FROM strategic), (SELECT count(*) FROM strategic) > 0""",
    "a31_metric_rows": "SELECT * REPLACE (round(metric_value, 6) AS metric_value) FROM metrics",
    "w1_road_performance": f"""SELECT *, CAST(dense_rank() OVER (PARTITION BY road_type ORDER BY avg_speed DESC NULLS LAST)
 AS INTEGER) AS rank, {_score('avg_speed')} AS performance_score, {_status('avg_speed')} AS status FROM roads""",
    "w2_lags": """SELECT event_id, vehicle_count_lag1, vehicle_count_lag2, speed_lag1, speed_lag2, occupancy_lag1,
 occupancy_lag2 FROM history""",
    "w3_rolling_means": """SELECT event_id, round(vehicle_count_ma3, 6) AS vehicle_count_ma3, round(speed_ma3, 6) AS speed_ma3,
 round(occupancy_ma3, 6) AS occupancy_ma3 FROM history""",
    "w4_rolling_spread": """SELECT event_id, round(vehicle_count_std3, 6) AS vehicle_count_std3,
 round(speed_std3, 6) AS speed_std3 FROM history""",
    "w5_next_step": """SELECT event_id, vehicle_count_target, next_speed AS speed_target,
 CAST(target AS DOUBLE) AS congestion_target FROM history""",
    "w6_ranked_zones": """SELECT zone, niveau_trafic, trafic_moyen_vehicules_heure, CAST(row_number() OVER
 (ORDER BY trafic_moyen_vehicules_heure DESC, zone) AS INTEGER) AS rang FROM traffic2""",
    "m2_feature_table": FEATURE_SQL,
    "m2_feature_table_chunked": FEATURE_SQL,
    "j1_critical_zones": """SELECT * REPLACE (round(trafic_moyen_vehicules_heure, 6) AS trafic_moyen_vehicules_heure,
 round(taux_congestion_pourcentage, 6) AS taux_congestion_pourcentage) FROM critical""",
    "j2_main_dashboard": """SELECT k.zone, k.trafic_moyen_vehicules, k.vitesse_moyenne_kmh, k.taux_occupation_moyen,
 k.niveau_service, c.congestion_rate_percent, c.niveau_congestion, c.priorite_intervention, c.impact_estime_minutes
 FROM strategic k LEFT JOIN analysis c ON k.zone = c.zone""",
    "j4_zone_comparisons": "SELECT * FROM zone_cmp",
    "j4_peak_comparisons": "SELECT * FROM peak_cmp",
    "j4_weekday_comparisons": "SELECT * FROM week_cmp",
    "o2_top_three_congested": "SELECT * FROM zones ORDER BY congestion_rate_percent DESC, zone LIMIT 3",
    "o3_top_ten_congested": "SELECT * FROM worst",
    "o3_chart_top_five": "SELECT * FROM worst ORDER BY congestion_rate_percent DESC, zone LIMIT 5",
    "u1_serving_totals": f"""SELECT 'Trafic Total' AS metric, {_settled('sum(trafic_moyen_vehicules_heure)', 2)} AS value FROM traffic2
 UNION ALL SELECT 'Zones Critiques', CAST(count(*) AS DOUBLE) FROM critical WHERE niveau_congestion <> 'Faible'
 UNION ALL SELECT 'Congestion Moyenne', {_settled('avg(taux_congestion_pourcentage)', 2)} FROM congestion2
 UNION ALL SELECT 'Vitesse Moyenne', {_settled('avg(vitesse_moyenne_kmh)', 2)} FROM speed2""",
    "u3_distinct_zones": "SELECT DISTINCT zone FROM traffic",
    "m7_recommendations": """SELECT road_id, zone, 'HIGH_CONGESTION' AS type,
 'Augmenter la capacité ou ajouter des voies alternatives' AS recommendation, congestion_rate, 'HIGH' AS priority,
 CAST(NULL AS DOUBLE) AS avg_speed FROM routes WHERE congestion_rate > CAST(0.3 AS DOUBLE)
 UNION ALL SELECT road_id, NULL, 'LOW_SPEED', 'Améliorer les conditions de circulation', NULL, 'MEDIUM', avg_speed FROM slow""",
    "q2_hours_view": """SELECT hour, trafic_horaire_moyen, vitesse_horaire_moyenne, occupation_horaire_moyenne,
 periode_journee FROM hourly""",
    "q3_congestion_alerts_view": f"""SELECT zone, congestion_rate_percent, niveau_congestion, priorite_intervention,
 {_rate_severity('congestion_rate_percent')} AS severite FROM analysis WHERE congestion_rate_percent > 30""",
    "q7_hourly_trend": "SELECT hour, trafic_horaire_moyen, vitesse_horaire_moyenne FROM hourly",
    "g1_heat_map": f"""SELECT zone_name, CAST(latitude AS DECIMAL(10,8)) AS latitude, CAST(longitude AS DECIMAL(11,8)) AS longitude,
 coalesce(t, CAST(0 AS DOUBLE)) AS traffic_density, zone_type, {_density('t')} AS density_level,
 zone_name || chr(10) || 'Traffic: ' || {SHOWN.format('coalesce(t, 0)')} || ' veh/h' || chr(10) || 'Level: ' || {_density('t')}
 AS tooltip_info FROM coords LEFT JOIN canon USING (zone)""",
    "g2_average_congestion": "SELECT 'Average Congestion' AS metric, round(avg(taux_congestion_pourcentage), 6) AS value FROM congestion2",
    "g3_critical_zone_count": "SELECT 'Alert: Zones Critiques' AS metric, count(*) AS value FROM critical WHERE niveau_congestion <> 'Faible'",
    "g4_busiest_zone": f"""SELECT 'Zone: ' || zone || ': ' || {SHOWN.format('trafic_moyen_vehicules_heure')} || ' véhicules/h' AS name,
 trafic_moyen_vehicules_heure AS value FROM traffic2 ORDER BY 2 DESC, zone LIMIT 1""",
    "g5_fastest_zone": f"""SELECT 'Fast: ' || zone || ': ' || {SHOWN.format('vitesse_moyenne_kmh')} || ' km/h' AS name,
 vitesse_moyenne_kmh AS value FROM speed2 ORDER BY 2 DESC, zone LIMIT 1""",
    "g6_traffic_ranking": """SELECT zone, trafic_moyen_vehicules_heure,
 round(trafic_moyen_vehicules_heure * CAST(1.2 AS DOUBLE), 0) AS estimation_totale FROM traffic2 ORDER BY 2 DESC, 1 LIMIT 8""",
    "g7_congestion_ranking": f"""SELECT zone, taux_congestion_pourcentage, {_state('taux_congestion_pourcentage')} AS etat
 FROM congestion2 ORDER BY 2 DESC, 1 LIMIT 8""",
    "g8_speed_series": """SELECT processed_at AS time, vitesse_moyenne_kmh, zone FROM snaps, now
 WHERE processed_at >= as_of - INTERVAL 4 HOUR""",
    "g9_traffic_series": "SELECT processed_at AS time, trafic_moyen_vehicules_heure, zone FROM snaps",
    "g10_interventions": """SELECT zone, niveau_congestion AS alert_level,
 CASE niveau_congestion WHEN 'Élevé' THEN 'RED: URGENT' WHEN 'Modéré' THEN 'ORANGE: ATTENTION' ELSE 'GREEN: NORMAL' END
 AS required_action, CASE niveau_congestion WHEN 'Élevé' THEN 3 WHEN 'Modéré' THEN 2 ELSE 1 END AS priority,
 CASE niveau_congestion WHEN 'Élevé' THEN 'Immediate' WHEN 'Modéré' THEN 'Under 30min' ELSE 'Monitoring' END
 AS recommendation FROM critical ORDER BY priority DESC, zone LIMIT 10""",
    "g11_global_performance": f"SELECT 'Performance Globale' AS name, {_settled('avg(vitesse_moyenne_kmh) / 50 * 100', 1)} AS value FROM speed2",
    "g12_zone_count": "SELECT 'Zones Surveillées' AS metric, count(*) AS value FROM traffic2",
    "g13_fluidity_rate": f"SELECT 'Taux de Fluidité' AS metric, {_settled('100 - avg(taux_congestion_pourcentage)', 1)} AS value FROM congestion2",
    "g14_markers": f"""SELECT zone_name AS name, CAST(latitude AS DECIMAL(10,8)) AS latitude,
 CAST(longitude AS DECIMAL(11,8)) AS longitude, t AS traffic_density, zone_type, {_marker('t')} AS density_level
 FROM coords LEFT JOIN canon USING (zone)""",
    "g15_forecast_series": """SELECT prediction_timestamp AS time, predicted_traffic, predicted_speed, zone,
 confidence_score * 100 AS confidence_percent FROM preds, now WHERE prediction_timestamp >= as_of - INTERVAL 4 HOUR""",
    "m8_forecast_inputs": f"""SELECT step, road_id, zone, t AS event_time, CAST(hour(t) AS INTEGER) AS hour,
 {', '.join(f"round({x}[{i}], 6) AS {n}" for x, names in (
    ("v", ("vehicle_count", "vehicle_count_lag1", "vehicle_count_lag2")), ("s", ("average_speed", "speed_lag1", "speed_lag2")),
    ("o", ("occupancy_rate", "occupancy_lag1", "occupancy_lag2"))) for i, n in enumerate(names, 1))},
 round(list_aggregate(v, 'avg'), 6) AS vehicle_count_ma3, round(list_aggregate(s, 'avg'), 6) AS speed_ma3,
 round(list_aggregate(o, 'avg'), 6) AS occupancy_ma3, round(list_aggregate(v, 'stddev_samp'), 6) AS vehicle_count_std3,
 round(list_aggregate(s, 'stddev_samp'), 6) AS speed_std3
 FROM (SELECT * FROM step0 UNION ALL SELECT * FROM step1 UNION ALL SELECT * FROM step2)""",
    "m3_split_rows": "SELECT percent, train, CAST(count(*) AS BIGINT) AS rows FROM parted GROUP BY 1, 2",
    "m3_given_scores": """SELECT count(e) AS rows, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae,
 round(1 - avg(e * e) / var_pop(l), 6) AS r2 FROM (SELECT vehicle_count_target - p AS e,
  CASE WHEN p IS NOT NULL THEN vehicle_count_target END AS l FROM (SELECT vehicle_count_target,
   CASE WHEN average_speed IS NOT NULL THEN vehicle_count + average_speed / 4 END AS p FROM history
   WHERE vehicle_count_target IS NOT NULL AND next_speed IS NOT NULL))""",
    "m4_given_accuracy": f"SELECT count(p) AS rows, round(avg(CASE WHEN p IS NOT NULL THEN CAST(target = p AS INTEGER) END), 6) AS accuracy FROM {GIVEN_CLASS}",
    "a27_given_predictions": f"""SELECT CAST(target AS DOUBLE) AS congestion_target, p AS congestion_prediction, count(*) AS count
 FROM {GIVEN_CLASS} WHERE p IS NOT NULL GROUP BY 1, 2""",
    "m1_one_hot_vectors": """SELECT road_type, array_to_string(list_transform(range(4), lambda i: CAST(i = idx AS INTEGER)), ',') AS vector
 FROM (SELECT road_type, row_number() OVER (ORDER BY count(*) DESC, road_type) - 1 AS idx FROM traffic GROUP BY 1)""",
    "m6_given_share": f"""SELECT CAST(sum(is_anomaly) AS BIGINT) AS anomalies, count(is_anomaly) AS rows,
 round(avg(is_anomaly) * 100, 1) AS percent FROM {GIVEN_FLAGS}""",
    "m6_given_most_severe": f"""SELECT vehicle_count, average_speed, occupancy_rate, CAST(hour(event_time) AS INTEGER) AS hour,
 anomaly_score FROM {GIVEN_FLAGS} WHERE is_anomaly = 1 ORDER BY anomaly_score, vehicle_count, average_speed, occupancy_rate,
 hour(event_time), dayofweek(event_time) LIMIT 10""",
    "k10_given_tables": """SELECT 'traffic_predictions' AS "table", count(*) AS rows FROM parted WHERE percent = 80 AND NOT train
 UNION ALL SELECT 'congestion_predictions', count(*) FROM parted WHERE percent = 70 AND NOT train
 UNION ALL SELECT 'anomalies_detected', count(*) FROM parted WHERE percent = 80""",
    "g16_active_alert_count": """SELECT 'Active Alerts' AS metric, count(*) AS value FROM alerts, now
 WHERE status = 'ACTIVE' AND timestamp >= as_of - INTERVAL 48 HOUR""",
    "g17_flow_by_direction": """SELECT direction, CAST(sum(flow_volume) AS BIGINT) AS flow_volume,
 avg(average_speed) AS avg_speed FROM flow WHERE timestamp >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 365 DAY
 GROUP BY 1""",
    "g18_metric_series": """SELECT timestamp AS time, round(metric_value, 6) AS metric_value,
 metric_name || ' (' || metric_unit || ')' AS metric, zone FROM metrics, now WHERE timestamp >= as_of - INTERVAL 24 HOUR""",
    "g19_largest_differences": """SELECT zone1 || ' vs ' || zone2 AS comparison, metric_name, value1, value2,
 percentage_diff, time_period FROM (SELECT * FROM zone_cmp UNION ALL SELECT * FROM peak_cmp UNION ALL SELECT * FROM week_cmp)
 ORDER BY abs(percentage_diff) DESC, zone1, zone2, metric_name, time_period LIMIT 10""",
    "g20_latest_alerts": """SELECT alert_type, severity, zone, vehicle_count, average_speed, occupancy_rate,
 timestamp AS time, status FROM alerts, now WHERE timestamp >= as_of - INTERVAL 24 HOUR
 ORDER BY timestamp DESC, alert_id LIMIT 20""",
    "g21_repaired_zone_ranking": f"""SELECT zone, {_traffic('v')} AS niveau_trafic, v AS trafic_moyen_vehicules_heure,
 CAST(row_number() OVER (ORDER BY v DESC, zone) AS INTEGER) AS rang
 FROM (SELECT {CANONICAL} AS zone, avg(vehicle_count) AS v FROM dirty GROUP BY 1)""",
    "t4_window_metrics": "SELECT * FROM win",
    "t6_detected_alerts": "SELECT window_end, road_id, zone, alert_type FROM tagged",
    "t11_alert_lifecycle": "SELECT * FROM alerts",
    "t11_alert_lifecycle_minutes": "SELECT * FROM minute_alerts",
    "t2_parsed_messages": f"""SELECT sensor_id, road_id, road_type, zone, vehicle_count, average_speed, occupancy_rate,
 {TIME_KEPT} AS event_time FROM traffic WHERE event_type IN ('view', 'click', 'purchase')""",
    "t2_rejected_messages": """SELECT value, CASE WHEN trim(value) = '' THEN 'blank' WHEN event_type = 'error' THEN 'bad_json'
 ELSE 'bad_time' END AS reject_reason FROM lines WHERE event_type IN ('error', 'signup')""",
    "t4_stream_window_metrics": """SELECT * FROM (SELECT date_trunc('minute', event_time) AS window_start,
 date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end, road_id, zone,
 avg(vehicle_count) AS avg_vehicle_count, avg(average_speed) AS avg_speed, avg(occupancy_rate) AS avg_occupancy_rate,
 count(*) AS event_count, max(vehicle_count) AS max_vehicles, min(average_speed) AS min_speed
 FROM traffic GROUP BY 1, 2, 3, 4) WHERE window_end <= (SELECT as_of FROM now) - INTERVAL 2 MINUTE""",
    "t7_stream_alerts": "SELECT * FROM closed_alerts",
    "t7_open_state": """SELECT road_id, zone, alert_type, vehicle_count, average_speed, occupancy_rate, timestamp, escalation_count, last_update
 FROM closed_alerts WHERE status = 'ACTIVE'""",
    "t7_ended_stream_alerts": "SELECT * FROM alerts",
    "t7_stream_alerts_many_batches": "SELECT * FROM closed_alerts",
    "t13_stream_announcements": """SELECT 'email' AS channel, false AS is_escalation, count(*) AS messages, count(*) AS alerts
 FROM closed_alerts UNION ALL SELECT 'email', true, CAST(sum(escalation_count) AS BIGINT),
 count(*) FILTER (WHERE escalation_count > 0) FROM closed_alerts""",
    "k8_landed_messages": LANDED,
    "k8_landed_stream": LANDED,
    "k8_compacted": LANDED,
    "k1_rollup_traffic_by_zone": "SELECT * FROM zone_hour",
    "k1_rollup_speed_by_road": "SELECT * FROM roads",
    "k1_rollup_congestion_by_zone": "SELECT * FROM zones",
    "k1_rollup_hourly_analysis": "SELECT * FROM hours",
    "j1_second_family_one_pass": """SELECT * REPLACE (round(trafic_moyen_vehicules_heure, 6) AS trafic_moyen_vehicules_heure,
 round(taux_congestion_pourcentage, 6) AS taux_congestion_pourcentage) FROM critical""",
    "m1_category_index": """SELECT t.road_type, CAST(r.i AS DOUBLE) AS road_type_index, t.zone, CAST(z.i AS DOUBLE) AS zone_index,
 count(*) AS n FROM traffic t
 JOIN (SELECT road_type, row_number() OVER (ORDER BY count(*) DESC, road_type) - 1 AS i FROM traffic GROUP BY 1) r
  ON t.road_type = r.road_type
 JOIN (SELECT zone, row_number() OVER (ORDER BY count(*) DESC, zone) - 1 AS i FROM traffic GROUP BY 1) z
  ON t.zone = z.zone GROUP BY 1, 2, 3, 4""",
    "t13_outbox": f"""SELECT alert_id, escalation_count > 0 AS is_escalation, 'email' AS channel,
 CASE WHEN escalation_count > 0 THEN '🚨 ESCALADE ALERTE TRAFIC - ' ELSE '🚨 ALERTE TRAFIC - ' END || alert_type
  || ' sur ' || road_id AS subject,
 'ALERTE TRAFIC' || CASE WHEN escalation_count > 0 THEN ' (ESCALADE)' ELSE '' END || chr(10) || {MAIL_FACTS}
  || chr(10) || '- Timestamp: ' || strftime(timestamp, '%Y-%m-%d %H:%M:%S') || chr(10) || chr(10)
  || array_to_string(['Actions recommandées', '- Vérifier la situation sur place', '- Activer les panneaux de signalisation',
   '- Contacter les équipes de régulation', '- Envisager des déviations'], chr(10)) AS body FROM alerts
 UNION ALL SELECT alert_id, escalation_count > 0, 'slack', NULL,
 CASE WHEN severity = 'HIGH' THEN '🚨' ELSE '⚠️' END || ' *ALERTE TRAFIC'
  || CASE WHEN escalation_count > 0 THEN ' (ESCALADE)' ELSE '' END || '*' || chr(10) || chr(10) || {CHAT_FACTS}
  || chr(10) || chr(10) || 'Vérifier immédiatement la situation.' FROM alerts
 UNION ALL SELECT alert_id, escalation_count > 0, 'webhook', NULL, '{{"alert_id":"' || alert_id
  || '","type":"traffic_alert","severity":"' || severity || '","road_id":"' || road_id || '","zone":"' || zone
  || '","metrics":{{"vehicle_count":' || coalesce(CAST(vehicle_count AS VARCHAR), 'null') || ',"average_speed":'
  || coalesce(CAST(average_speed AS VARCHAR), 'null') || ',"occupancy_rate":'
  || coalesce(CAST(occupancy_rate AS VARCHAR), 'null') || '}},"timestamp":"' || strftime(timestamp, '%Y-%m-%dT%H:%M:%S')
  || '","is_escalation":' || CAST(escalation_count > 0 AS VARCHAR) || '}}' FROM alerts""",
}

# The stored analytics tables hold what their makers return.
BODIES |= {
    "k2_stored_kpi_zone_strategique": BODIES["a5_strategic_zones"],
    "k2_stored_performance_routes": BODIES["w1_road_performance"],
    "k2_stored_analyse_congestion": BODIES["a6_congestion_analysis"],
    "k2_stored_analyse_temporelle": BODIES["a7_hourly_analysis"],
    "k2_stored_tableau_bord_executif": BODIES["a8_executive_overview"],
}

BODIES |= {"a13_stored_weekly_profile": BODIES["a13_weekly_profile"], "a13_stored_road_type_profile": BODIES["a14_road_type_profile"]}
BODIES |= {f"k5_export_{n}": BODIES[f"k5_serving_{n}"] for n in (
    "trafic_par_zone", "vitesse_moyenne", "taux_congestion", "zones_critiques", "evolution_trafic")}

# Tables built from batches equal those built at once.
BODIES |= {
    "k1_two_batches_traffic_by_zone": BODIES["k1_rollup_traffic_by_zone"],
    "k1_two_batches_speed_by_road": BODIES["k1_rollup_speed_by_road"],
    "k1_two_batches_congestion_by_zone": BODIES["k1_rollup_congestion_by_zone"],
    "k1_two_batches_hourly_analysis": BODIES["k1_rollup_hourly_analysis"],
    "k1_two_batches_trafic_par_zone": BODIES["a9_zone_traffic"],
    "k1_two_batches_vitesse_moyenne": BODIES["a10_zone_speed"],
    "k1_two_batches_taux_congestion": BODIES["a11_zone_congestion_levels"],
    "k1_two_batches_evolution_trafic": BODIES["a12_temporal_evolution"],
    "k1_two_batches_zones_critiques": BODIES["j1_second_family_one_pass"],
}


def _needed(text: str, seen: list[str]) -> None:
    for name, part in PARTS.items():
        if name not in seen and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
            _needed(part, seen)
            if name not in seen:
                seen.append(name)


def sql(body: str) -> str:
    parts: list[str] = []
    _needed(body, parts)
    if not parts:
        return body
    return "WITH " + ",\n".join(f"{p} AS ({PARTS[p]})" for p in parts) + "\n" + body


def oracle_sql() -> dict[str, str]:
    return {name: sql(body) for name, body in BODIES.items()}
