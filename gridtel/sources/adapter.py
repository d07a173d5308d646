"""Stand-in inputs built from the driver's test tables.

These functions only reshape rows of the test tables into the schemas the
jobs expect (message envelopes, design records, operational events).  They
do none of the jobs' work: validation, deduplication, modelling and
aggregation all happen in ``gridtel.operators`` on whatever rows arrive.

Mapping (restated in SQL for the DuckDB oracle in ``plans.oracle``):

* envelope from ``lineitem``: unit ``TR-%05d`` of ``l_partkey``; contract
  version 2 when ``l_suppkey % 50 = 0``; instant = month of ``l_shipdate`` +
  ``l_linenumber`` hours; received = ``l_shipdate`` + ``l_orderkey`` seconds;
  sensor values from quantity / discount / tax / price / line number, two decimals; a few
  rows carry broken JSON, a zoneless or future timestamp, a foreign topic, a
  lower-case state, a missing field or one reading out of range, so that
  every contract rule sees input.
* design registry from ``part``; for every design rule some rows break it.
* events from ``events``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..functions.text import telemetry_topic
from ..functions.timefmt import to_rfc3339

# --- fixed values: adapter nominal voltages (kV), by index ------------------
HV_LEVELS = (69.0, 138.0, 230.0, 345.0, 500.0)
LV_LEVELS = (13.8, 34.5, 69.0, 115.0, 138.0)
# --- fixed values: adapter variant moduli on l_orderkey ----------------------
BROKEN_JSON_MOD = 211
ZONELESS_TS_MOD = 307
FOREIGN_TOPIC_MOD = 101
LOWER_STATE_MOD = 401
ODD_SEVERITY_MOD = 53  # on user_id
NO_LOAD_MOD = 397        # the field is missing from the message
FUTURE_MOD = 443
# one reading outside its range: modulus on l_orderkey -> column, value
ODD_READINGS = ((409, "ambient_temperature_c", 60.5), (419, "oil_level_percent", 120.0), (421, "current_a", -1.0),
                (431, "voltage_kv", 0.0), (433, "oil_temperature_c", 160.0), (439, "winding_temperature_c", 210.0))
# one field that breaks a design rule: modulus on p_partkey -> column, value
ODD_DESIGNS = ((103, "rated_power_mva", 0.0), (107, "frequency_hz", 55), (109, "vector_group", "XX0"),
               (113, "impedance_percent", 45.0), (127, "cooling_type", "AN"), (131, "commissioning_year", 1950),
               (137, "no_load_loss_kw", -1.0), (139, "total_mass_t", 0.0), (149, "transformer_id", "UNIT-1"),
               (151, "transformer_id", ""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unit_id(key) -> F.Column:
    """``TR-`` + key zero-padded to at least five digits (never truncated)."""
    return F.format_string("TR-%05d", F.col(key) if isinstance(key, str) else key)


def _r2(x) -> F.Column:
    return x.cast("decimal(12,2)").cast("double")


def telemetry_columns(lineitem: DataFrame) -> DataFrame:
    """Typed telemetry columns of each lineitem row (before JSON encoding)."""
    l = lineitem
    ship = l.l_shipdate.cast("timestamp")  # wall time read as UTC instant
    ts = F.timestamp_seconds(F.unix_seconds(F.date_trunc("month", ship)) + l.l_linenumber * 3600)
    rows = l.select(
        unit_id("l_partkey").alias("transformer_id"),
        F.when(l.l_suppkey % 50 == 0, F.lit(2)).otherwise(F.lit(1)).alias("schema_version"),
        ts.alias("ts"),
        F.timestamp_seconds(F.unix_seconds(ship) + l.l_orderkey).alias("received_at"),
        _r2(l.l_quantity * 4.2 + l.l_linenumber * 0.01).alias("load_percent"),
        _r2(F.lit(20.0) + l.l_discount * 100 + l.l_linenumber * 0.02).alias("ambient_temperature_c"),
        _r2(F.lit(20.0) + l.l_discount * 100 + l.l_quantity * 1.5 + l.l_linenumber * 0.03).alias("oil_temperature_c"),
        _r2(F.lit(19.0) + l.l_discount * 100 + l.l_quantity * 1.5 + l.l_tax * 200 + l.l_linenumber * 0.04).alias("winding_temperature_c"),
        (F.lit(85) + l.l_suppkey % 15).cast("double").alias("oil_level_percent"),
        (F.floor(l.l_extendedprice).cast("double") / 100.0).alias("current_a"),
        (F.lit(69) + l.l_suppkey % 5).cast("double").alias("voltage_kv"),
        F.when(l.l_returnflag == "A", "NORMAL").when(l.l_returnflag == "N", "WARNING")
         .otherwise("CRITICAL").alias("state"),
        l.l_orderkey, l.l_suppkey,
    )
    for mod, column, value in ODD_READINGS:
        rows = rows.withColumn(column, F.when(F.col("l_orderkey") % mod == 0, F.lit(value)).otherwise(F.col(column)))
    return rows.withColumn("load_percent", F.when(F.col("l_orderkey") % NO_LOAD_MOD != 0, F.col("load_percent")))


def telemetry_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message envelopes ``(topic, payload, received_at)`` from ``lineitem``."""
    t = telemetry_columns(table(spark, sf_dir, "lineitem"))
    ts_text = F.when(t.l_orderkey % FUTURE_MOD == 0, F.lit("2999-01-01T00:00:00Z")) \
               .when(t.l_orderkey % ZONELESS_TS_MOD == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")) \
               .otherwise(to_rfc3339("ts"))
    state = F.when(t.l_orderkey % LOWER_STATE_MOD == 0, F.lower("state")).otherwise(F.col("state"))
    body = F.to_json(F.struct(
        F.col("schema_version"), F.col("transformer_id"), ts_text.alias("timestamp"),
        "load_percent", "ambient_temperature_c", "oil_temperature_c", "winding_temperature_c",
        "oil_level_percent", "current_a", "voltage_kv", state.alias("state")))
    payload = F.when(t.l_orderkey % BROKEN_JSON_MOD == 0, F.expr("substr(to_json_body, 1, length(to_json_body) - 1)")) \
               .otherwise(F.col("to_json_body"))
    topic_unit = F.when(t.l_orderkey % FOREIGN_TOPIC_MOD == 0, unit_id(F.col("l_suppkey"))) \
                  .otherwise(F.col("transformer_id"))
    return (t.withColumn("to_json_body", body)
             .select(telemetry_topic(topic_unit).alias("topic"), payload.alias("payload"), "received_at"))


def registry_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed design records from ``part`` (each design rule is broken by some)."""
    p = table(spark, sf_dir, "part")
    i = p.p_partkey % 5 + 1
    hv = F.element_at(F.array(*[F.lit(v) for v in HV_LEVELS]), i.cast("int"))
    lv = F.element_at(F.array(*[F.lit(v) for v in LV_LEVELS]), i.cast("int"))
    swap = p.p_partkey % 97 == 0
    power = _r2(p.p_size * 2 + p.p_partkey % 7 * 0.13)
    vg = F.element_at(F.array(*[F.lit(v) for v in P.VECTOR_GROUPS]), (p.p_partkey % 9 + 1).cast("int"))
    cooling = (F.when(power < 15, "ONAN").when(power < 60, "ONAF").when(power < 80, "OFAF").otherwise("ODAF"))
    application = (F.when(p.p_type == "ECONOMY", "distribution").when(p.p_type == "STANDARD", "transmission")
                   .when(p.p_type == "SMALL", "industrial").when(p.p_type == "LARGE", "generation")
                   .otherwise("renewable"))
    rows = p.select(
        "p_partkey", unit_id("p_partkey").alias("transformer_id"),
        power.alias("rated_power_mva"),
        F.when(swap, lv).otherwise(hv).alias("hv_voltage_kv"),
        F.when(swap, hv).otherwise(lv).alias("lv_voltage_kv"),
        F.when(p.p_partkey % 10 == 0, F.lit(50)).otherwise(F.lit(60)).alias("frequency_hz"),
        F.when(p.p_partkey % 101 == 0, F.lit(2)).otherwise(F.lit(3)).alias("phase_count"),
        vg.alias("vector_group"),
        (F.lit(5) + p.p_partkey % 20).cast("double").alias("impedance_percent"),
        cooling.alias("cooling_type"),
        (F.lit(1990) + p.p_partkey % 36).cast("int").alias("commissioning_year"),
        application.alias("application"),
        (F.floor(p.p_retailprice * 5).cast("double") / 100.0).alias("no_load_loss_kw"),
        (F.floor(p.p_retailprice * 50).cast("double") / 100.0).alias("load_loss_kw"),
        _r2(F.lit(22.0) + p.p_size * 1.35).alias("total_mass_t"),
        _r2(F.lit(2.0) + p.p_size * 0.11).alias("length_m"),
        _r2(F.lit(1.5) + p.p_size * 0.05).alias("width_m"),
        _r2(F.lit(2.6) + p.p_size * 0.04).alias("height_m"),
    )
    for mod, column, value in ODD_DESIGNS:
        rows = rows.withColumn(column, F.when(F.col("p_partkey") % mod == 0, F.lit(value)).otherwise(F.col(column)))
    return rows.drop("p_partkey")


def operational_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operational events from ``events``: unit, instant, type, severity, JSON payload."""
    e = table(spark, sf_dir, "events")
    return e.select(
        unit_id("user_id").alias("transformer_id"),
        e.ts.cast("timestamp").alias("ts"),
        e.event_type.alias("event_type"),
        F.when(e.user_id % ODD_SEVERITY_MOD == 0, "NOTICE").when(e.event_type == "error", "CRITICAL")
         .when(e.event_type == "purchase", "WARNING").otherwise("INFO").alias("severity"),
        e.props.alias("payload"),
    )
