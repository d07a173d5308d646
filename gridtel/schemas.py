"""Explicit schemas (never inferred)."""
from __future__ import annotations

from pyspark.sql import types as T

# Telemetry payload, contract version 1.
PAYLOAD_FIELDS = (
    ("schema_version", T.IntegerType()),
    ("transformer_id", T.StringType()),
    ("timestamp", T.StringType()),
    ("load_percent", T.DoubleType()),
    ("ambient_temperature_c", T.DoubleType()),
    ("oil_temperature_c", T.DoubleType()),
    ("winding_temperature_c", T.DoubleType()),
    ("oil_level_percent", T.DoubleType()),
    ("current_a", T.DoubleType()),
    ("voltage_kv", T.DoubleType()),
    ("state", T.StringType()),
)
PAYLOAD_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in PAYLOAD_FIELDS])
CORRUPT_COL = "_corrupt"
PAYLOAD_SCHEMA_STRICT = T.StructType(
    PAYLOAD_SCHEMA.fields + [T.StructField(CORRUPT_COL, T.StringType(), True)])
# Silver reads every payload field as text (the reference's ->> operator).
PAYLOAD_TEXT_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n, _ in PAYLOAD_FIELDS])

MEASUREMENT_COLUMNS = tuple(n for n, t in PAYLOAD_FIELDS if isinstance(t, T.DoubleType))

# Message envelope (stream / landing files).
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), True),
    T.StructField("payload", T.StringType(), True),
    T.StructField("received_at", T.TimestampType(), True),
])

# Design registry, typed.
REGISTRY_FIELDS = (
    ("transformer_id", T.StringType()),
    ("rated_power_mva", T.DoubleType()),
    ("hv_voltage_kv", T.DoubleType()),
    ("lv_voltage_kv", T.DoubleType()),
    ("frequency_hz", T.IntegerType()),
    ("phase_count", T.IntegerType()),
    ("vector_group", T.StringType()),
    ("impedance_percent", T.DoubleType()),
    ("cooling_type", T.StringType()),
    ("commissioning_year", T.IntegerType()),
    ("application", T.StringType()),
    ("no_load_loss_kw", T.DoubleType()),
    ("load_loss_kw", T.DoubleType()),
    ("total_mass_t", T.DoubleType()),
    ("length_m", T.DoubleType()),
    ("width_m", T.DoubleType()),
    ("height_m", T.DoubleType()),
)
REGISTRY_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in REGISTRY_FIELDS])
REGISTRY_COLUMNS = tuple(n for n, _ in REGISTRY_FIELDS)

# Bronze JSON-lines line kinds.
RAW_LINE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("transformer_id", T.StringType(), True),
    T.StructField("schema_version", T.IntegerType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("received_at", T.StringType(), True),
])
