"""Schemas of the messages and tables, and the fixed values they use."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# Readings and their units.
UNITS = {
    "gas_temperature": "°C",
    "gas_pressure": "bar",
    "humidity": "%RH",
    "spin_rate": "RPM",
    "torque": "Nm",
}
MEASUREMENTS = tuple(UNITS)

# Vocabularies.
TRACKIN, TRACKOUT = "trackin", "trackout"
CONDITIONS = ("greater_than", "less_than", "between", "outside", "rate_above", "rate_below", "custom")
SEVERITIES = ("info", "warning", "critical")
DATA_TYPES = ("BOOLEAN", "INT32", "INT64", "FLOAT", "DOUBLE", "TEXT")
WINDOW_TYPES = ("instant", "tumbling", "sliding")
TRIM_ACTIONS = ("drop", "tag")
TIMESTAMP_UNITS = ("ms", "s", "us")
REQUEST_KINDS = ("CREATE_STORAGE_GROUP", "CREATE_TEMPLATE", "CREATE_TIMESERIES", "APPLY_TEMPLATE")
JSON_PARSE_ERROR = "JSON_PARSE_ERROR"
SCHEMA_VALIDATION_ERROR = "SCHEMA_VALIDATION_ERROR"
TYPE_CONVERSION_ERROR = "TYPE_CONVERSION_ERROR"
#: Ours: a time ahead of the message's own arrival.
CLOCK_ERROR = "CLOCK_ERROR"
SEQUENCE_ANOMALY = "SEQUENCE_ANOMALY"
UNRESOLVED, RESOLVED = "UNRESOLVED", "RESOLVED"
MATCH_WITH_DELAYED_TRACKOUT = "MATCH_WITH_DELAYED_TRACKOUT"
IMPLICIT_RUN_CLOSE = "IMPLICIT_RUN_CLOSE"

# Topics and the storage group readings are kept under.
TELEMETRY_TOPIC, CONTEXT_TOPIC, RULES_TOPIC = "sensor-topic", "context-topic", "rules-topic"
EVALUATION_TOPIC, DLQ_TOPIC, ERROR_TOPIC = "evaluation-topic", "dlq-topic", "sensor-topic-dlq"
MANIFEST_TOPIC, ALERT_TOPIC = "manifests", "alerts"
STORAGE_GROUP = "root.factory1"

# Machine types and locations, indexed by machine number.
MACHINE_TYPES = ("compressor", "turbine", "pump", "generator", "conveyor")
LOCATIONS = ("zone_A", "zone_B", "zone_C", "zone_D")

# Reading bands that identify a fault: (profile, fault code, measurement, low, high).
FAULT_BANDS = (
    ("overtemp", "F0001", "gas_temperature", 470.0, 520.0),
    ("overtemp", "F0001", "gas_pressure", 4.5, 6.0),
    ("overpressure", "F0002", "gas_temperature", 380.0, 450.0),
    ("overpressure", "F0002", "gas_pressure", 6.5, 8.0),
    ("high_vibration", "F0003", "spin_rate", 3500.0, 4200.0),
    ("high_vibration", "F0003", "torque", 18.0, 25.0),
    ("low_humidity", "F0004", "humidity", 5.0, 15.0),
)
FAULT_BAND_SCHEMA = _struct(profile=S, fault_code=S, measurement=S, lo=D, hi=D)

# The driver's events table.
EVENTS = T.StructType([
    T.StructField("event_id", L), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", L),
    T.StructField("event_type", S), T.StructField("value", D), T.StructField("props", S),
])

# Kafka's column shape, used for file sources as well.
RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", S),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", L),
    T.StructField("timestamp", T.TimestampType()),
])

TELEMETRY = T.StructType(
    [T.StructField("machine_id", S), T.StructField("machine_type", S), T.StructField("location", S),
     T.StructField("timestamp", L)]
    + [T.StructField(m, D, True, {"unit": u}) for m, u in UNITS.items()]
    + [T.StructField("status", S), T.StructField("fault_code", S)]
)
GENERIC_TELEMETRY = _struct(deviceId=S, ts=L, measurements=T.MapType(S, D))
CONTEXT = _struct(device_id=S, run_id=S, event_type=S, timestamp=L, start_ts=L, end_ts=L)

RULE_WINDOW = _struct(type=S, sizeSeconds=D, slideSeconds=D)
RULE = T.StructType(
    _struct(rule_id=S, version=S, device_type=S, rule_type=S, measurement=S, condition=S,
            threshold=D, severity=S, enabled=B).fields
    + _struct(lo=D, hi=D, window=RULE_WINDOW, durationSec=D, actions=T.ArrayType(S),
              alertChannel=S, params=T.MapType(S, S)).fields
)

MANIFEST_MEASUREMENT = _struct(name=S, dataType=S, encoding=S, compression=S, unit=S, description=S)
# A threshold is a number or a pair of numbers, so its JSON text is kept and read later.
MANIFEST_RULE = _struct(id=S, displayName=S, description=S, measurement=S, condition=S, threshold=S,
                        window=RULE_WINDOW, durationSec=D, severity=S, actions=T.ArrayType(S),
                        alertChannel=S, params=T.MapType(S, S))
MANIFEST = _struct(
    version=S, deviceType=S, storageGroup=S, devicePathPattern=S, templateName=S,
    measurements=T.ArrayType(MANIFEST_MEASUREMENT),
    defaults=_struct(timestampField=S, deviceIdField=S, timestampUnit=S),
    edgeTrimming=_struct(leadSeconds=D, trailSeconds=D, action=S),
    kpivRules=T.ArrayType(MANIFEST_RULE),
    knownDeviceIds=T.ArrayType(S),
    meta=S,
)

ALERT = _struct(alert_id=S, alert_time=L, rule_id=S, alert_type=S, measurement=S, value=D,
                threshold=D, severity=S, message=S)
ANOMALY = _struct(type=S, previous_run_id=S, current_run_id=S, implicit_transition_ts=L, reason=S)
