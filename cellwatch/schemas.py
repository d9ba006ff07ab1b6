"""Column lists and schemas of the records that move through the engine."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the three JSON event kinds.
EVENT_KEYS = {"h3Cell": "string", "lat": "double", "lon": "double", "eventTime": "bigint", "eventDate": "date"}

WEATHER_FIELDS = {
    **EVENT_KEYS,
    "temperature": "double",
    "humidity": "double",
    "windSpeed": "double",
    "precipitation": "double",
    "soilMoisture": "double",
    "vpd": "double",
}

SENSOR_FIELDS = {
    **EVENT_KEYS,
    "co2": "double",
    "smoke": "double",
    "sensorTemperature": "double",
    "battery": "double",
    "alertLevel": "string",
    "fireRelated": "boolean",
}

FIRE_FIELDS = {
    **EVENT_KEYS,
    "declaredAt": "bigint",
    "agentId": "string",
    "intensity": "double",
    "burnedArea": "double",
    "cause": "string",
    "declared": "boolean",
}

EVENT_FIELDS = {"weather": WEATHER_FIELDS, "sensor": SENSOR_FIELDS, "fire": FIRE_FIELDS}

# Stream topics.
TOPICS = {"weather": "meteo-events", "sensor": "sensor-events", "fire": "fire-events"}

# Numeric columns of the static cell dimension.
STATIC_COLUMNS = [
    "altitude_moy",
    "pente_moy",
    "dist_route_m",
    "dist_urbain_m",
    "ndvi_30d_mean",
    "ndvi_30d_min",
    "ndvi_30d_std",
    "h3_center_lat",
    "h3_center_lon",
]

# Descriptive columns of the cell metadata dimension.
METADATA_COLUMNS = ["wilaya", "daira", "commune", "nom_foret_ou_lieu_dit", "essence_principale"]

# Measures of the unified events, by source.
WEATHER_MEASURES = ["temperature", "humidity", "wind_speed", "precipitation", "soil_moisture", "vpd"]
SENSOR_MEASURES = ["co2", "smoke", "sensor_temperature", "battery"]
FIRE_MEASURES = {"fire_declared": "int", "intensity": "double", "burned_area": "double"}

# Columns of unified events.
UNIFIED_SCHEMA = T.StructType(
    [
        T.StructField("source_type", T.StringType()),
        T.StructField("h3_cell", T.StringType()),
        T.StructField("event_time", T.LongType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        *[T.StructField(c, T.DoubleType()) for c in WEATHER_MEASURES],
        *[T.StructField(c, T.DoubleType()) for c in SENSOR_MEASURES],
        T.StructField("fire_declared", T.IntegerType()),
        T.StructField("intensity", T.DoubleType()),
        T.StructField("burned_area", T.DoubleType()),
        *[T.StructField(c, T.DoubleType()) for c in STATIC_COLUMNS],
    ]
)

# Columns of the snapshot table.
SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("h3_cell", T.StringType()),
        T.StructField("h3_commune", T.StringType()),
        T.StructField("event_time", T.LongType()),
        T.StructField("event_date", T.DateType()),
        *[
            T.StructField(c, T.DoubleType())
            for c in [
                "h3_center_lat",
                "h3_center_lon",
                "altitude_moy",
                "pente_moy",
                "dist_route_m",
                "dist_urbain_m",
                "humidity_min",
                "temperature_moy",
                "wind_speed_max",
                "precipitation_1d_mm",
                "precipitation_7d_sum_mm",
                "soil_moisture",
                "vpd_kpa",
                "ndvi_30d_mean",
                "ndvi_30d_min",
                "ndvi_30d_std",
            ]
        ],
        T.StructField("month", T.IntegerType()),
        *[T.StructField(c, T.DoubleType()) for c in ["month_sin", "month_cos", "doy_sin", "doy_cos"]],
        T.StructField("is_weekend", T.IntegerType()),
    ]
)

# Columns of the prediction table.
PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("h3_cell", T.StringType()),
        T.StructField("event_time", T.LongType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("prediction", T.IntegerType()),
        T.StructField("probability", T.DoubleType()),
        T.StructField("risk_level", T.StringType()),
        T.StructField("suspected_voluntary", T.IntegerType()),
        T.StructField("trigger_type", T.StringType()),
        T.StructField("trigger_source", T.StringType()),
        T.StructField("is_neighbor_prediction", T.BooleanType()),
        T.StructField("trigger_h3_cell", T.StringType()),
        T.StructField("confirmed_alert", T.BooleanType()),
        T.StructField("fire_observed", T.BooleanType()),
        T.StructField("sensor_confirmed", T.BooleanType()),
        T.StructField("confirmation_time", T.LongType()),
        T.StructField("prediction_slot", T.StringType()),
    ]
)

# Columns of the daily outcome table.
OUTCOME_SCHEMA = T.StructType(
    [
        T.StructField("h3_cell", T.StringType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("sensor_confirmed", T.BooleanType()),
        T.StructField("fire_observed", T.BooleanType()),
        T.StructField("fire_confirmed_with_sensor", T.BooleanType()),
        T.StructField("confirmation_time", T.LongType()),
        T.StructField("confirmation_source", T.StringType()),
        T.StructField("last_prediction_before_alert", T.IntegerType()),
        T.StructField("last_probability_before_alert", T.DoubleType()),
        T.StructField("last_risk_before_alert", T.StringType()),
        T.StructField("suspected_voluntary", T.IntegerType()),
        T.StructField("latest_meteo_event_time", T.LongType()),
        T.StructField("latest_meteo_slot", T.StringType()),
    ]
)

_TRAINING_FEATURES = [f for f in SNAPSHOT_SCHEMA.fields if f.name not in ("h3_cell", "event_time", "event_date")]

# Columns of the daily training table.
TRAINING_SCHEMA = T.StructType(
    [
        T.StructField("h3_cell", T.StringType()),
        T.StructField("event_date", T.DateType()),
        *_TRAINING_FEATURES,
        T.StructField("input_event_time", T.LongType()),
        T.StructField("input_slot", T.StringType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("confirmation_source", T.StringType()),
        T.StructField("suspected_voluntary", T.IntegerType()),
        T.StructField("fire_observed", T.BooleanType()),
        T.StructField("sensor_confirmed", T.BooleanType()),
    ]
)

TRAINING_FEATURES = [f.name for f in _TRAINING_FEATURES]
SNAPSHOT_COLUMNS = SNAPSHOT_SCHEMA.fieldNames()
PREDICTION_COLUMNS = PREDICTION_SCHEMA.fieldNames()
OUTCOME_COLUMNS = OUTCOME_SCHEMA.fieldNames()
TRAINING_COLUMNS = TRAINING_SCHEMA.fieldNames()

# Rows that a job refuses: where, why, and what is left of them.
QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("h3_cell", T.StringType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("event_time", T.LongType()),
        T.StructField("seq", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)
QUARANTINE_COLUMNS = QUARANTINE_SCHEMA.fieldNames()
