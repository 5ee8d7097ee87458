"""Declared schemas; nothing in the engine infers one."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
NTZ = T.TimestampNTZType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# One sensor reading as it arrives: event_time is still text.
RAW_EVENT = struct(
    sensor_id=S, road_id=S, road_type=S, zone=S,
    vehicle_count=L, average_speed=D, occupancy_rate=D, event_time=S,
)
# One sensor reading after parsing. Wall-clock time without a zone.
EVENT = struct(
    sensor_id=S, road_id=S, road_type=S, zone=S,
    vehicle_count=L, average_speed=D, occupancy_rate=D, event_time=NTZ,
)

FLOW = struct(
    road_id=S, from_zone=S, to_zone=S, flow_volume=L, average_speed=D, direction=S, timestamp=NTZ,
)

ZONE_COORDINATES = T.StructType([
    T.StructField("zone", S),
    T.StructField("latitude", T.DecimalType(10, 8)),
    T.StructField("longitude", T.DecimalType(11, 8)),
    T.StructField("zone_name", S),
    T.StructField("zone_type", S),
])

# Column types of the serving tables, as Spark type names. the
# names and widths have to fit the dashboards that read them. Counters are 64
# bits wide and relative differences have room for large ratios; narrower types
# would make the export of a large table fail.
SERVING = {
    "trafic_par_zone": {
        "zone": "string", "nombre_mesures": "bigint", "trafic_moyen_vehicules_heure": "decimal(10,2)",
        "trafic_total": "bigint", "pic_trafic": "bigint", "variabilite_trafic": "decimal(10,2)",
        "niveau_trafic": "string",
    },
    "vitesse_moyenne": {
        "zone": "string", "vitesse_moyenne_kmh": "decimal(10,2)", "vitesse_minimale": "decimal(10,2)",
        "vitesse_maximale": "decimal(10,2)", "ecart_type_vitesse": "decimal(10,2)",
        "niveau_fluidite": "string",
    },
    "taux_congestion": {
        "zone": "string", "total_mesures": "bigint", "mesures_congestionnees": "bigint",
        "taux_occupation_moyen": "decimal(10,2)", "vitesse_moyenne": "decimal(10,2)",
        "taux_congestion_pourcentage": "decimal(10,2)", "niveau_congestion": "string",
        "priorite_intervention": "int",
    },
    "evolution_trafic": {
        "heure": "int", "jour_semaine": "string", "trafic_horaire_moyen": "decimal(10,2)",
        "vitesse_horaire_moyenne": "decimal(10,2)", "occupation_horaire_moyenne": "decimal(10,2)",
        "nombre_mesures": "bigint", "periode_journee": "string",
    },
    "zones_critiques": {
        "zone": "string", "trafic_moyen_vehicules_heure": "decimal(10,2)", "niveau_trafic": "string",
        "taux_congestion_pourcentage": "decimal(10,2)", "niveau_congestion": "string",
        "priorite_intervention": "int", "statut_zone": "string",
    },
    "traffic_alerts": {
        "alert_id": "string", "alert_type": "string", "severity": "string", "road_id": "string",
        "zone": "string", "vehicle_count": "int", "average_speed": "decimal(5,2)",
        "occupancy_rate": "decimal(5,2)", "timestamp": "timestamp_ntz", "status": "string",
        "escalation_count": "int", "resolved_at": "timestamp_ntz", "duration_seconds": "int",
    },
    "traffic_predictions": {
        "zone": "string", "prediction_timestamp": "timestamp_ntz", "predicted_traffic": "decimal(10,2)",
        "predicted_speed": "decimal(5,2)", "confidence_score": "decimal(3,2)",
        "prediction_horizon_hours": "int", "model_version": "string",
    },
    "kpi_metrics": {
        "metric_name": "string", "metric_value": "decimal(10,2)", "metric_unit": "string",
        "zone": "string", "timestamp": "timestamp_ntz", "period": "string",
    },
    "traffic_flow": {
        "road_id": "string", "from_zone": "string", "to_zone": "string", "flow_volume": "int",
        "average_speed": "decimal(5,2)", "direction": "string", "timestamp": "timestamp_ntz",
    },
    "comparative_analytics": {
        "comparison_type": "string", "zone1": "string", "zone2": "string", "metric_name": "string",
        "value1": "decimal(10,2)", "value2": "decimal(10,2)", "percentage_diff": "decimal(10,2)",
        "time_period": "string", "timestamp": "timestamp_ntz",
    },
    "zone_coordinates": {
        "zone": "string", "latitude": "decimal(10,8)", "longitude": "decimal(11,8)",
        "zone_name": "string", "zone_type": "string",
    },
}
