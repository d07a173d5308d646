"""Registered queries (Spark) and their DuckDB oracle statements.

Every query reads the driver tables through the stand-in adapter and runs
the library's operators over all rows.  Names list the survey operators
each one exercises.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as PARAMS
from ..functions.timefmt import parse_rfc3339, to_rfc3339
from ..operators import analytics, contract, ingest, lag, paging, quality, registry, similarity
from ..operators.dedup import duplicate_keys, keep_latest
from ..session import shuffles_dropped
from . import oracle as O
from .layers import ADAPTER_ID_PATTERN, Layers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


P = O.pipeline_sql
MEAS_COLS = ("load_percent, ambient_temperature_c, oil_temperature_c, winding_temperature_c, "
             "oil_level_percent, current_a, voltage_kv")
LOOKUP_UNIT = "TR-00001"
EVENT_UNIT = "TR-00008"
WINDOW = ("1994-01-01 00:00:00", "1996-12-31 23:59:59")
TOPIC = "'transformers/' || {u} || '/telemetry'"


# --- contract (V1-V9) ---------------------------------------------------------------
@register("contract_reject_reason", P(f"""
SELECT {TOPIC.format(u='topic_unit')} AS topic, received_at, reject_reason FROM val WHERE reject_reason IS NOT NULL"""))
def q_contract_reject_reason(spark, sf_dir):
    """V1-V8: every rejected envelope with the first rule it fails."""
    L = Layers(spark, sf_dir)
    return contract.rejected(L.validated).select("topic", "received_at", "reject_reason")


@register("reject_counts", P("""
SELECT coalesce(reject_reason, 'accepted') AS outcome, count(*) AS n FROM val GROUP BY 1"""))
def q_reject_counts(spark, sf_dir):
    """V9: accepted / per-reason counters."""
    return contract.reject_counts(Layers(spark, sf_dir).validated)


@register("contract_unknown_unit", P("""
SELECT transformer_id, count(*) AS n FROM val WHERE reject_reason = 'unknown_transformer' GROUP BY 1"""))
def q_contract_unknown_unit(spark, sf_dir):
    """Messages from units missing in the (validated) registry, per unit."""
    v = Layers(spark, sf_dir).validated
    return v.filter(F.col("reject_reason") == "unknown_transformer").groupBy("transformer_id") \
            .agg(F.count(F.lit(1)).alias("n"))


@register("contract_timestamp", P("""
SELECT transformer_id, received_at FROM val WHERE reject_reason = 'bad_timestamp'"""))
def q_contract_timestamp(spark, sf_dir):
    """V4: messages whose timestamp is not strict RFC3339 (or too far in the future)."""
    v = Layers(spark, sf_dir).validated
    return v.filter(F.col("reject_reason") == "bad_timestamp").select("transformer_id", "received_at")


@register("topic_parse", P("""
SELECT topic_unit, count(*) AS n FROM tel GROUP BY 1"""))
def q_topic_parse(spark, sf_dir):
    """V7: unit parsed from each envelope topic, counted."""
    parsed = contract.parse_envelopes(Layers(spark, sf_dir).envelopes)
    return parsed.groupBy("topic_unit").agg(F.count(F.lit(1)).alias("n"))


@register("topic_mismatch", P(f"""
SELECT {TOPIC.format(u='topic_unit')} AS topic, transformer_id, received_at FROM val WHERE reject_reason = 'topic'"""))
def q_topic_mismatch(spark, sf_dir):
    """V8: valid payloads published on another unit's topic."""
    v = Layers(spark, sf_dir).validated
    return v.filter(F.col("reject_reason") == "topic").select("topic", "transformer_id", "received_at")


# --- registry (V10-V12, U3, U4, L1, P9) ----------------------------------------------
@register("registry_reject_reason", P("""
SELECT transformer_id, reject_reason FROM reg_chk WHERE reject_reason IS NOT NULL"""))
def q_registry_reject_reason(spark, sf_dir):
    """Design records failing a rule, with the first failing rule."""
    c = Layers(spark, sf_dir).registry_checked
    return c.filter(F.col("reject_reason").isNotNull()).select("transformer_id", "reject_reason")


@register("registry_audit", P("""
SELECT 'unique_ids' AS check_name, count(transformer_id) = count(DISTINCT transformer_id) AS ok FROM reg_in
UNION ALL SELECT 'power_positive', coalesce(bool_and(rated_power_mva > 0), true) FROM reg_in
UNION ALL SELECT 'hv_above_lv', coalesce(bool_and(hv_voltage_kv > lv_voltage_kv), true) FROM reg_in
UNION ALL SELECT 'frequency_50_60', coalesce(bool_and(frequency_hz IN (50, 60)), true) FROM reg_in
UNION ALL SELECT 'phases_1_or_3', coalesce(bool_and(phase_count IN (1, 3)), true) FROM reg_in
UNION ALL SELECT 'impedance_positive', coalesce(bool_and(impedance_percent > 0), true) FROM reg_in
UNION ALL SELECT 'dimensions_positive', coalesce(bool_and(length_m > 0 AND width_m > 0 AND height_m > 0), true) FROM reg_in"""))
def q_registry_audit(spark, sf_dir):
    """Seven named fleet checks over the incoming design base."""
    return registry.audit(Layers(spark, sf_dir).registry_input)


# CHECK constraints written out for the oracle, apart from the operators' own list.
REG_CHECKS = {
    "rated_power_mva": "rated_power_mva <= 0", "hv_voltage_kv": "hv_voltage_kv <= 0", "lv_voltage_kv": "lv_voltage_kv <= 0",
    "frequency_hz": "frequency_hz <> 50 AND frequency_hz <> 60", "phase_count": "phase_count <> 1 AND phase_count <> 3",
    "impedance_percent": "impedance_percent <= 0 OR impedance_percent > 40",
    "commissioning_year": "commissioning_year < 1960 OR commissioning_year > 2100",
    "no_load_loss_kw": "no_load_loss_kw < 0", "load_loss_kw": "load_loss_kw < 0", "total_mass_t": "total_mass_t <= 0",
    "length_m": "length_m <= 0", "width_m": "width_m <= 0", "height_m": "height_m <= 0",
}
MEAS_CHECKS = {
    "load_percent": "load_percent < 0 OR load_percent > 200",
    "ambient_temperature_c": "ambient_temperature_c < -20 OR ambient_temperature_c > 55",
    "oil_temperature_c": "oil_temperature_c < -20 OR oil_temperature_c > 150",
    "winding_temperature_c": "winding_temperature_c < -20 OR winding_temperature_c > 200",
    "oil_level_percent": "oil_level_percent < 0 OR oil_level_percent > 100",
    "current_a": "current_a < 0", "voltage_kv": "voltage_kv <= 0",
    "state": "state <> 'NORMAL' AND state <> 'WARNING' AND state <> 'CRITICAL'",
}


def _constraint_sql(table, key_expr, src, constraints):
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, {key_expr} AS row_key, '{name}' AS constraint_name FROM {src} "
        f"WHERE {bad}" for name, bad in constraints.items())


@register("constraint_violations", P(
    "SELECT * FROM (" + _constraint_sql("transformers", "transformer_id", "reg_in", REG_CHECKS)
    + "\nUNION ALL " + _constraint_sql("measurements", "transformer_id || '@' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ')",
                                       "meas", MEAS_CHECKS) + ")"))
def q_constraint_violations(spark, sf_dir):
    """Table CHECK constraints evaluated before a write, one row per violation."""
    L = Layers(spark, sf_dir)
    r = registry.constraint_violations(L.registry_input.withColumn("row_key", F.col("transformer_id")),
                                       registry.REGISTRY_CONSTRAINTS, key="row_key")
    m = registry.constraint_violations(
        L.measurements.withColumn("row_key", F.concat_ws("@", "transformer_id", to_rfc3339("ts"))),
        registry.MEASUREMENT_CONSTRAINTS, key="row_key")
    return (r.select(F.lit("transformers").alias("table_name"), "row_key", "constraint_name")
            .unionByName(m.select(F.lit("measurements").alias("table_name"), "row_key", "constraint_name")))


def _upsert_inputs(L: Layers):
    current = L.registry.filter(F.col("application") != "generation")
    incoming = L.registry.filter(F.col("application").isin("generation", "renewable")).withColumn(
        "impedance_percent",
        F.when(F.col("application") == "renewable", F.col("impedance_percent") + 1).otherwise(F.col("impedance_percent")))
    # every unit of the batch comes twice: an earlier, higher impedance and the final one
    twice = incoming.withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "impedance_percent", F.when(F.col("seq") == 1, F.col("impedance_percent") + 5).otherwise(F.col("impedance_percent")))
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return current.withColumn("updated_at", stamp), twice


@register("registry_upsert", P("""
SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM reg WHERE application NOT IN ('generation', 'renewable')
UNION ALL
SELECT * REPLACE (CASE WHEN application = 'renewable' THEN impedance_percent + 1 ELSE impedance_percent END AS impedance_percent),
       TIMESTAMP '2024-06-01 00:00:00' FROM reg WHERE application IN ('generation', 'renewable')"""))
def q_registry_upsert(spark, sf_dir):
    """Merge of a revision batch that repeats its units; the later row wins and is stamped."""
    current, incoming = _upsert_inputs(Layers(spark, sf_dir))
    return registry.upsert(current, incoming, order="seq", stamp="updated_at",
                           now=F.lit("2024-06-01 00:00:00").cast("timestamp"))


@register("event_violations", O.with_ctes(O.REG_IN, O.REG, O.EVENTS) + """
SELECT transformer_id, ts, event_type, severity, payload,
       CASE WHEN NOT EXISTS (SELECT 1 FROM reg WHERE reg.transformer_id = ev_in.transformer_id) THEN 'transformer_id'
            ELSE 'severity' END AS constraint_name
FROM ev_in WHERE severity NOT IN ('INFO', 'WARNING', 'CRITICAL')
  OR NOT EXISTS (SELECT 1 FROM reg WHERE reg.transformer_id = ev_in.transformer_id)""")
def q_event_violations(spark, sf_dir):
    """Events refused on write — unit not registered, or severity outside its set."""
    L = Layers(spark, sf_dir)
    return registry.event_violations(L.events_input, L.registry.select("transformer_id"))


@register("registry_insert", P("""
SELECT b.transformer_id,
       CASE WHEN b.reject_reason IS NOT NULL THEN 'invalid:' || b.reject_reason
            WHEN e.transformer_id IS NOT NULL OR c.n > 1 THEN 'conflict' ELSE 'accepted' END AS outcome
FROM reg_chk b
LEFT JOIN (SELECT transformer_id, count(*) AS n FROM reg_chk GROUP BY 1) c ON c.transformer_id = b.transformer_id
LEFT JOIN (SELECT DISTINCT transformer_id FROM reg WHERE application <> 'generation') e ON e.transformer_id = b.transformer_id"""))
def q_registry_insert(spark, sf_dir):
    """U4: registration batch classified as accepted / invalid:<rule> / conflict."""
    L = Layers(spark, sf_dir)
    existing = L.registry.filter(F.col("application") != "generation")
    return registry.insert_new(existing, L.registry_input, ADAPTER_ID_PATTERN).select("transformer_id", "outcome")


@register("registry_page", P("""
SELECT transformer_id, application, rated_power_mva FROM reg ORDER BY transformer_id LIMIT 100 OFFSET 100"""))
def q_registry_page(spark, sf_dir):
    """Second page of 100 registry rows by id."""
    return registry.page_by_id(Layers(spark, sf_dir).registry, 100, 100) \
                   .select("transformer_id", "application", "rated_power_mva")


@register("unit_lookup", P(f"SELECT * FROM reg WHERE transformer_id = '{LOOKUP_UNIT}'"))
def q_unit_lookup(spark, sf_dir):
    """Key lookup in the registry (empty result = not found)."""
    return Layers(spark, sf_dir).registry.filter(F.col("transformer_id") == LOOKUP_UNIT)


# --- bronze / silver (S4 S5 U1 U2 U5 P1-P8 P14 M1-M3) -------------------------------------
@register("bronze_raw", P(f"""
SELECT id, transformer_id, schema_version, {TOPIC.format(u='transformer_id')} AS topic, 'mqtt' AS source,
       received_at AS ingested_at, {O.PAYLOAD_FIELDS_SQL} AS payload_values FROM first_acc"""))
def q_bronze_raw(spark, sf_dir):
    """Bronze rows, first delivery of each ``unit@timestamp`` key; the verbatim payload is
    shown through its fields as one text, numbers rounded to their two decimals."""
    raw = Layers(spark, sf_dir).raw
    field = lambda c: F.get_json_object("payload", f"$.{c}")
    numbers = [F.coalesce(field(c).cast("decimal(12,2)").cast("string"), F.lit("null")) for c in O_MEAS]
    return raw.withColumn("payload_values", F.concat_ws("|", field("schema_version"), field("transformer_id"),
                                                        field("timestamp"), *numbers, field("state"))).drop("payload")


@register("dedup_first", P("SELECT * FROM meas"))
def q_dedup_first(spark, sf_dir):
    """Normalized measurements, first per (unit, instant), state recomputed."""
    return Layers(spark, sf_dir).measurements


@register("dedup_latest", P(f"""
SELECT transformer_id, ts, received_at, {MEAS_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY transformer_id, ts
        ORDER BY received_at DESC, current_a DESC, load_percent DESC, ambient_temperature_c DESC,
                 winding_temperature_c DESC, voltage_kv DESC, oil_level_percent DESC, state DESC,
                 oil_temperature_c DESC) AS rn
  FROM val WHERE reject_reason IS NULL) WHERE rn = 1"""))
def q_dedup_latest(spark, sf_dir):
    """Latest delivery wins per (unit, timestamp) over all accepted messages."""
    acc = contract.accepted(Layers(spark, sf_dir).validated)
    cols = ["transformer_id", "ts", "received_at", "current_a", "load_percent", "ambient_temperature_c",
            "winding_temperature_c", "voltage_kv", "oil_level_percent", "state", "oil_temperature_c", "payload"]
    latest = keep_latest(acc.select(*cols), ["transformer_id", "ts"], cols[2:])
    return latest.select("transformer_id", "ts", "received_at", *O_MEAS)


O_MEAS = [c.strip() for c in MEAS_COLS.split(",")]


@register("stg_telemetry", P("SELECT * FROM stg"))
def q_stg(spark, sf_dir):
    """Staged silver telemetry extracted from bronze payloads."""
    return Layers(spark, sf_dir).stg


@register("quality_flag", P("SELECT quality_flag, count(*) AS n FROM stg GROUP BY 1"))
def q_quality_flag(spark, sf_dir):
    """Completeness flag distribution."""
    return Layers(spark, sf_dir).stg.groupBy("quality_flag").agg(F.count(F.lit(1)).alias("n"))


@register("normalize_ts", P("SELECT id, ts, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts_text FROM stg"))
def q_normalize_ts(spark, sf_dir):
    """Payload timestamp -> instant (second precision) -> RFC3339 text."""
    return Layers(spark, sf_dir).stg.select("id", "ts", to_rfc3339("ts").alias("ts_text"))


@register("normalize_state", P("SELECT state, state_recomputed, count(*) AS n FROM int_tel GROUP BY 1, 2"))
def q_normalize_state(spark, sf_dir):
    """Payload state (trimmed, upper) against the recomputed state."""
    return Layers(spark, sf_dir).int.groupBy("state", "state_recomputed").agg(F.count(F.lit(1)).alias("n"))


@register("enriched", P("SELECT * FROM int_tel"))
def q_enriched(spark, sf_dir):
    """Enriched silver telemetry (stress index, recomputed state, margins)."""
    return Layers(spark, sf_dir).int


@register("duplicate_keys", P("""
SELECT transformer_id, ts, count(*) AS cnt FROM val WHERE reject_reason IS NULL GROUP BY 1, 2 HAVING count(*) > 1"""))
def q_duplicate_keys(spark, sf_dir):
    """A10/Q5: redelivered (unit, instant) keys among accepted messages."""
    return duplicate_keys(contract.accepted(Layers(spark, sf_dir).validated), ["transformer_id", "ts"])


# --- gold (G1-G6, W2) ---------------------------------------------------------------
@register("dim_time", P("SELECT * FROM dim_time"))
def q_dim_time(spark, sf_dir):
    """Time spine of distinct instants."""
    return Layers(spark, sf_dir).dim_time


@register("dim_transformer", P("SELECT * FROM dim_transformer"))
def q_dim_transformer(spark, sf_dir):
    """Design dimension."""
    return Layers(spark, sf_dir).dim_transformer


@register("dim_location", P("SELECT * FROM dim_location"))
def q_dim_location(spark, sf_dir):
    """Synthetic site dimension."""
    return Layers(spark, sf_dir).dim_location


@register("fact_measurement", P("SELECT * FROM fact"))
def q_fact_measurement(spark, sf_dir):
    """Wide measurement fact."""
    return Layers(spark, sf_dir).fact


@register("fact_event", O.with_ctes(O.REG_IN, O.REG, O.EVENTS) + """
SELECT ts AS time_key, transformer_id AS transformer_key, transformer_id AS location_key, event_type, severity,
       count(*) OVER (PARTITION BY transformer_id, event_type, severity) AS event_count
FROM ev""")
def q_fact_event(spark, sf_dir):
    """Event fact with per-(unit, type, severity) counts."""
    return Layers(spark, sf_dir).fact_event


@register("sensor_envelope", P("""
SELECT s.sensor_name, s.sensor_type, s.unit, s.min_limit, s.max_limit,
       min(x) AS observed_min, max(x) AS observed_max,
       count(*) FILTER (WHERE (s.min_limit IS NOT NULL AND x < s.min_limit) OR (s.max_limit IS NOT NULL AND x > s.max_limit)) AS out_of_limits,
       count(x) AS n
FROM (SELECT 'load' AS sensor_name, load_percent AS x FROM fact
      UNION ALL SELECT 'ambient', ambient_temperature_c FROM fact
      UNION ALL SELECT 'oil_temperature', oil_temperature_c FROM fact
      UNION ALL SELECT 'winding_temperature', winding_temperature_c FROM fact
      UNION ALL SELECT 'oil_level', oil_level_percent FROM fact
      UNION ALL SELECT 'current', current_a FROM fact
      UNION ALL SELECT 'voltage', voltage_kv FROM fact) f
-- fixed values: the sensor catalog
JOIN (VALUES ('load','LOAD','%',0,200), ('ambient','TEMPERATURE','°C',-20,55),
             ('oil_temperature','TEMPERATURE','°C',-20,150), ('winding_temperature','TEMPERATURE','°C',-20,200),
             ('oil_level','LEVEL','%',0,100), ('current','CURRENT','A',0,NULL), ('voltage','VOLTAGE','kV',0,NULL))
     AS s(sensor_name, sensor_type, unit, min_limit, max_limit) ON s.sensor_name = f.sensor_name
GROUP BY 1, 2, 3, 4, 5"""))
def q_sensor_envelope(spark, sf_dir):
    """Sensor catalog joined with observed ranges and out-of-limit counts."""
    L = Layers(spark, sf_dir)
    return analytics.sensor_envelope(L.fact, L.dim_sensor)


# --- lookups, windows, pages (P10 A1 L2) ----------------------------------------------------
@register("telemetry_window", P(f"""
SELECT * FROM meas WHERE transformer_id = '{LOOKUP_UNIT}'
  AND ts >= TIMESTAMP '{WINDOW[0]}' AND ts <= TIMESTAMP '{WINDOW[1]}'
ORDER BY ts DESC LIMIT 100"""))
def q_telemetry_window(spark, sf_dir):
    """P10/L2: one unit's measurements in a closed window, newest first, one page."""
    m = analytics.telemetry_window(Layers(spark, sf_dir).measurements, LOOKUP_UNIT, *WINDOW)
    return analytics.newest_first_page(m, 100)


DEEP_OFFSET = 3_000


@register("measurements_deep_page", P(f"""
SELECT * FROM meas ORDER BY ts DESC, transformer_id LIMIT 100 OFFSET {DEEP_OFFSET}"""))
def q_measurements_deep_page(spark, sf_dir):
    """L2: a deep page of all measurements, newest first, from their stored ranges."""
    m = Layers(spark, sf_dir).measurements
    order, path = [("ts", False), ("transformer_id", True)], _scratch(spark, "measurement-ranges")
    paging.sort_by_range(m, path, order)
    return paging.page(spark, path, m.schema, order, 100, DEEP_OFFSET)


@register("telemetry_window_count", P(f"""
SELECT 'telemetry_window' AS what, count(*) AS n FROM meas WHERE transformer_id = '{LOOKUP_UNIT}'
  AND ts >= TIMESTAMP '{WINDOW[0]}' AND ts <= TIMESTAMP '{WINDOW[1]}'
UNION ALL SELECT 'transformers', count(*) FROM reg
UNION ALL SELECT 'raw_telemetry', count(*) FROM first_acc"""))
def q_telemetry_window_count(spark, sf_dir):
    """A1: window total, registry size and bronze size."""
    L = Layers(spark, sf_dir)
    w = analytics.telemetry_window(L.measurements, LOOKUP_UNIT, *WINDOW)
    cnt = lambda df, what: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "n")
    return cnt(w, "telemetry_window").unionByName(cnt(L.registry, "transformers")).unionByName(cnt(L.raw, "raw_telemetry"))


@register("events_page", O.with_ctes(O.REG_IN, O.REG, O.EVENTS) + f"""
SELECT transformer_id, event_type, severity, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, payload
FROM ev WHERE transformer_id = '{EVENT_UNIT}'
ORDER BY ts DESC, event_type, severity, payload LIMIT 100""")
def q_events_page(spark, sf_dir):
    """L2: one unit's events newest first (full tie-breaker), RFC3339 timestamps."""
    ev = Layers(spark, sf_dir).events.filter(F.col("transformer_id") == EVENT_UNIT)
    page = analytics.newest_first_page(ev, 100, tie=("event_type", "severity", "payload"))
    return page.select("transformer_id", "event_type", "severity", to_rfc3339("ts").alias("timestamp"), "payload")


# --- aggregations (A2-A8, A11-A16) -------------------------------------------------------------
@register("stats_per_unit", P(f"""
SELECT r.transformer_id, coalesce(m.count, 0) AS count,
       coalesce(m.min_load_percent, 0) AS min_load_percent, coalesce(m.max_load_percent, 0) AS max_load_percent,
       coalesce(m.avg_load_percent, 0) AS avg_load_percent, coalesce(m.max_oil_temperature_c, 0) AS max_oil_temperature_c,
       coalesce(m.max_winding_temperature_c, 0) AS max_winding_temperature_c,
       coalesce(m.avg_winding_temperature_c, 0) AS avg_winding_temperature_c,
       coalesce(t.avg_thermal_stress_index, 0) AS avg_thermal_stress_index
FROM reg r
LEFT JOIN (SELECT transformer_id, count(*) AS count, min(load_percent) AS min_load_percent,
                  max(load_percent) AS max_load_percent, {O.xavg('load_percent')} AS avg_load_percent,
                  max(oil_temperature_c) AS max_oil_temperature_c, max(winding_temperature_c) AS max_winding_temperature_c,
                  {O.xavg('winding_temperature_c')} AS avg_winding_temperature_c
           FROM meas GROUP BY 1) m ON m.transformer_id = r.transformer_id
LEFT JOIN (SELECT transformer_key, {O.xavg('thermal_stress_index')} AS avg_thermal_stress_index
           FROM fact GROUP BY 1) t ON t.transformer_key = r.transformer_id"""))
def q_stats_per_unit(spark, sf_dir):
    """Statistics of every registered unit (zeros when it has no rows)."""
    L = Layers(spark, sf_dir)
    return analytics.unit_statistics(L.measurements, L.fact, L.registry)


# Totals of each unit and what its design record says, before any grouping across units.
PER_UNIT = """per_unit AS (
  SELECT transformer_id AS unit, count(*) AS readings, count(oil_temperature_c) AS oil_readings,
         count(thermal_stress_index) AS stress_readings, max(winding_temperature_c) AS hottest,
         sum(CAST(oil_temperature_c AS DECIMAL(18,6))) AS oil_total,
         sum(CAST(thermal_stress_index AS DECIMAL(18,6))) AS stress_total
  FROM int_tel GROUP BY transformer_id),
design AS (SELECT location_key AS unit, region, (SELECT any_value(application) FROM reg WHERE transformer_id = location_key) AS application
           FROM dim_location)"""


@register("top_units", P("""
SELECT transformer_id, n, first_ts, last_ts FROM (
  SELECT transformer_id, len(seen) AS n, list_min(seen) AS first_ts, list_max(seen) AS last_ts
  FROM (SELECT transformer_id, list(ts) AS seen FROM meas GROUP BY transformer_id))
QUALIFY row_number() OVER (ORDER BY n DESC, transformer_id) <= 5"""))
def q_top_units(spark, sf_dir):
    """A3/L3: five busiest units with first/last instant."""
    return analytics.top_units(Layers(spark, sf_dir).measurements)


@register("state_tsi", P(f"""
SELECT transformer_id, state_recomputed, count(*) AS n, {O.rhu(O.xavg('thermal_stress_index'), 4)} AS avg_tsi
FROM int_tel GROUP BY 1, 2 ORDER BY n DESC, transformer_id, state_recomputed LIMIT 5"""))
def q_state_tsi(spark, sf_dir):
    """A4/L3: rows and average stress per (unit, recomputed state), top 5."""
    return analytics.state_tsi(Layers(spark, sf_dir).int)


@register("unit_oil", P(f"""
SELECT unit AS transformer_key, application, readings AS n_measurements, {O.rhu('CAST(oil_total AS DOUBLE) / nullif(oil_readings, 0)', 2)} AS avg_oil_temp_c
FROM per_unit JOIN design USING (unit)
QUALIFY row_number() OVER (ORDER BY readings DESC, unit) <= 6""", (PER_UNIT,)))
def q_unit_oil(spark, sf_dir):
    """Fact x design dimension, top 6 units by rows with average oil."""
    L = Layers(spark, sf_dir)
    return analytics.unit_oil(L.fact, L.dim_transformer)


@register("region_oil", P(f"""
SELECT region, application, {O.rhu('CAST(sum(oil_total) AS DOUBLE) / nullif(sum(oil_readings), 0)', 2)} AS avg_oil_temp_c,
       CAST(sum(readings) AS BIGINT) AS n
FROM design JOIN per_unit USING (unit) GROUP BY ALL""", (PER_UNIT,)))
def q_region_oil(spark, sf_dir):
    """Star join, average oil per (region, application)."""
    L = Layers(spark, sf_dir)
    return analytics.region_oil(L.fact, L.dim_transformer, L.dim_location)


@register("region_tsi", P(f"""
SELECT region, application, {O.rhu('CAST(sum(stress_total) AS DOUBLE) / nullif(sum(stress_readings), 0)', 4)} AS avg_tsi,
       max(hottest) AS max_winding_c, CAST(sum(readings) AS BIGINT) AS n_measurements
FROM design JOIN per_unit USING (unit) GROUP BY ALL""", (PER_UNIT,)))
def q_region_tsi(spark, sf_dir):
    """A7 (flagship): average stress index and peak winding per (region, application)."""
    L = Layers(spark, sf_dir)
    return analytics.region_tsi(L.fact, L.dim_transformer, L.dim_location)


@register("weekday_peak", P("""
SELECT rpad(dayname(day), 9, ' ') AS weekday, max(highest) AS peak_load
FROM (SELECT CAST(ts AS DATE) AS day, max(load_percent) AS highest FROM int_tel GROUP BY day) GROUP BY ALL"""))
def q_weekday_peak(spark, sf_dir):
    """Peak load per weekday through the time dimension."""
    L = Layers(spark, sf_dir)
    return analytics.weekday_peak(L.fact, L.dim_time)


@register("power_describe", P(f"""
SELECT application, count(rated_power_mva) AS count,
       {O.rhe(O.xavg('rated_power_mva'), 1)} AS mean,
       {O.rhe('stddev_samp(rated_power_mva)', 1)} AS std,
       {O.rhe('min(rated_power_mva)', 1)} AS min,
       {O.rhe('quantile_cont(rated_power_mva, 0.25)', 1)} AS p25,
       {O.rhe('quantile_cont(rated_power_mva, 0.5)', 1)} AS p50,
       {O.rhe('quantile_cont(rated_power_mva, 0.75)', 1)} AS p75,
       {O.rhe('max(rated_power_mva)', 1)} AS max
FROM reg GROUP BY 1"""))
def q_power_describe(spark, sf_dir):
    """describe() of rated power per application (exact distributed quartiles)."""
    return analytics.power_describe(Layers(spark, sf_dir).registry)


@register("cooling_crosstab", P("""
SELECT application,
       count(*) FILTER (WHERE cooling_type = 'ONAN') AS ONAN, count(*) FILTER (WHERE cooling_type = 'ONAF') AS ONAF,
       count(*) FILTER (WHERE cooling_type = 'OFAF') AS OFAF, count(*) FILTER (WHERE cooling_type = 'OFWF') AS OFWF,
       count(*) FILTER (WHERE cooling_type = 'ODAF') AS ODAF
FROM reg GROUP BY 1"""))
def q_cooling_crosstab(spark, sf_dir):
    """Application x cooling cross-tab, missing = 0."""
    return analytics.cooling_crosstab(Layers(spark, sf_dir).registry)


@register("histogram", P(f"""
SELECT feature, bin, {O.rhu('mn + (bin - 1) * (mx - mn) / 10e0', 4)} AS bin_lo,
       {O.rhu('mn + bin * (mx - mn) / 10e0', 4)} AS bin_hi, count(*) AS n
FROM (
  SELECT l.feature, r.mn, r.mx,
         CASE WHEN r.mx - r.mn = 0 THEN 1
              ELSE least(CAST(floor((l.x - r.mn) * 10 / (r.mx - r.mn)) AS INTEGER) + 1, 10) END AS bin
  FROM (SELECT 'rated_power_mva' AS feature, CAST(rated_power_mva AS DOUBLE) AS x FROM reg
        UNION ALL SELECT 'hv_voltage_kv', CAST(hv_voltage_kv AS DOUBLE) FROM reg
        UNION ALL SELECT 'commissioning_year', CAST(commissioning_year AS DOUBLE) FROM reg) l
  JOIN (SELECT feature, min(x) AS mn, max(x) AS mx FROM (
          SELECT 'rated_power_mva' AS feature, CAST(rated_power_mva AS DOUBLE) AS x FROM reg
          UNION ALL SELECT 'hv_voltage_kv', CAST(hv_voltage_kv AS DOUBLE) FROM reg
          UNION ALL SELECT 'commissioning_year', CAST(commissioning_year AS DOUBLE) FROM reg) GROUP BY 1) r
    ON r.feature = l.feature) GROUP BY feature, bin, mn, mx"""))
def q_histogram(spark, sf_dir):
    """10-bin histograms of power, HV voltage and commissioning year."""
    return analytics.histogram(Layers(spark, sf_dir).registry)


@register("power_range", P("""
SELECT min(rated_power_mva) AS min_power_mva, max(rated_power_mva) AS max_power_mva, count(*) AS units FROM reg"""))
def q_power_range(spark, sf_dir):
    """Fleet power range."""
    return analytics.power_range(Layers(spark, sf_dir).registry)


def _scaler_sql() -> str:
    """One SELECT per feature over the registry's values as they are; population deviation, 0 -> 1."""
    one = ("SELECT '{f}' AS feature, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1e0 ELSE stddev_pop(x) END AS std "
           "FROM (SELECT coalesce(CAST({f} AS DOUBLE), 0e0) AS x FROM reg)")
    return " UNION ALL ".join(one.format(f=f) for f in PARAMS.DESIGN_FEATURES)


@register("feature_scaler", P(f"""
SELECT feature, {O.rhu('mean', 6)} AS mean, {O.rhu('std', 6)} AS std FROM ({_scaler_sql()})"""))
def q_feature_scaler(spark, sf_dir):
    """Standard-scaler mean and population std of the 10 design features."""
    return analytics.feature_scaler(Layers(spark, sf_dir).registry)


@register("layer_counts", P("""
SELECT 'raw_telemetry' AS layer, count(*) AS n, count(*) >= 15 AS meets_minimum FROM first_acc
UNION ALL SELECT 'measurements', count(*), count(*) >= 15 FROM meas
UNION ALL SELECT 'stg_telemetry', count(*), count(*) >= 15 FROM stg"""))
def q_layer_counts(spark, sf_dir):
    """Bronze / operational / silver reconciliation counts."""
    L = Layers(spark, sf_dir)
    return analytics.layer_counts(L.raw, L.measurements, L.stg)


@register("earliest_sample", P("""
SELECT transformer_id, ts AS timestamp, COLUMNS(['load_percent', 'ambient_temperature_c', 'oil_temperature_c',
       'winding_temperature_c', 'oil_level_percent'])
FROM meas QUALIFY row_number() OVER (ORDER BY ts, transformer_id) <= 200"""))
def q_earliest_sample(spark, sf_dir):
    """Earliest 200 measurements as the telemetry feature matrix."""
    return analytics.earliest_sample(Layers(spark, sf_dir).measurements)


@register("sql_views", P("""
SELECT state_recomputed AS state, weekday, count(*) AS n, max(thermal_stress_index) AS max_tsi
FROM int_tel JOIN dim_time ON time_key = ts GROUP BY ALL"""))
def q_sql_views(spark, sf_dir):
    """A statement over named layers with the macros as SQL functions, through ``spark.sql``."""
    from .views import create_views
    create_views(Layers(spark, sf_dir))
    return spark.sql("""
        SELECT classify_state(winding_temperature_c, oil_temperature_c, load_percent) AS state, weekday, count(*) AS n,
               max(thermal_stress_index(winding_temperature_c, oil_temperature_c, load_percent)) AS max_tsi
        FROM stg_telemetry JOIN dim_time ON dim_time.time_key = stg_telemetry.ts GROUP BY ALL""")


# --- quality (Q1-Q12, J4-J6) -----------------------------------------------------------------
def _dq_tables(L: Layers) -> dict[str, DataFrame]:
    return {"stg_telemetry": L.stg, "int_telemetry": L.int, "transformers": L.registry,
            "dim_time": L.dim_time, "dim_transformer": L.dim_transformer, "dim_location": L.dim_location,
            "dim_sensor": L.dim_sensor, "fact_transformer_measurement": L.fact}


DQ_LAYERS = ("registry", "stg", "int", "dim_time", "dim_transformer", "dim_location", "fact")


def _dq_stored(spark, sf_dir) -> dict[str, DataFrame]:
    """The tables to check, each stored once so that a check pass reads files, not the whole build behind them."""
    L = Layers(spark, sf_dir)
    if not L.stored:
        L.persist_to(_scratch(spark, "dq-layers"), DQ_LAYERS)
    return _dq_tables(L)


@register("orphan_facts", P("""
SELECT transformer_key, time_key FROM fact
WHERE transformer_key NOT IN (SELECT transformer_id FROM reg WHERE commissioning_year >= 1995)"""))
def q_orphan_facts(spark, sf_dir):
    """Facts without a design dimension row, once the designs from before 1995 have left the dimension."""
    L = Layers(spark, sf_dir)
    return quality.orphan_facts(L.fact, L.dim_transformer.where("commissioning_year >= 1995"))


# Predicates and value sets written out for the oracle, apart from the checks' own.
DQ_PREDICATES = {
    "assert_stg_load_percent_range": "NOT load_percent BETWEEN 0 AND 200",
    "assert_stg_payload_id_matches": "transformer_id IS DISTINCT FROM payload_transformer_id",
    "assert_stg_temperature_plausible": "oil_temperature_c > winding_temperature_c OR winding_temperature_c > 200 "
                                        "OR oil_temperature_c > 150 OR NOT ambient_temperature_c BETWEEN -20 AND 55",
    "assert_int_tsi_range": "NOT thermal_stress_index BETWEEN 0 AND 1",
    "assert_int_state_matches_recomputed": "state IS DISTINCT FROM state_recomputed",
}
DQ_VALUES = {"state": "'CRITICAL', 'NORMAL', 'WARNING'", "state_recomputed": "'CRITICAL', 'NORMAL', 'WARNING'",
             "quality_flag": "'complete', 'incomplete'", "country": "'Brazil'"}


DQ_SQL_TABLES = {"stg_telemetry": "stg", "int_telemetry": "int_tel", "transformers": "reg", "dim_time": "dim_time",
                 "dim_transformer": "dim_transformer", "dim_location": "dim_location",
                 "fact_transformer_measurement": "fact",
                 "dim_sensor": "(VALUES ('load'),('ambient'),('oil_temperature'),('winding_temperature'),"
                                  "('oil_level'),('current'),('voltage')) AS s(sensor_name)"}


def _dq_sql() -> str:
    tables = DQ_SQL_TABLES
    rows = []
    for c in quality.CHECKS:
        t = tables[c.table]
        if c.kind == "not_null":
            q = f"SELECT count(*) FROM {t} WHERE {c.column} IS NULL"
        elif c.kind == "unique":
            q = f"SELECT count(*) FROM (SELECT {c.column} FROM {t} WHERE {c.column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        elif c.kind == "unique_key":
            cols = ", ".join(c.columns)
            q = f"SELECT count(*) FROM (SELECT {cols} FROM {t} GROUP BY {cols} HAVING count(*) > 1)"
        elif c.kind == "accepted_values":
            q = f"SELECT count(DISTINCT {c.column}) FROM {t} WHERE {c.column} NOT IN ({DQ_VALUES[c.column]})"
        elif c.kind == "orphans":
            p = tables[c.parent]
            q = (f"SELECT count(*) FROM {t} ch LEFT JOIN {p} pa ON pa.{c.parent_column} = ch.{c.column} "
                 f"WHERE pa.{c.parent_column} IS NULL")
        elif c.kind == "relationships":
            p = tables[c.parent]
            q = (f"SELECT count(*) FROM {t} ch WHERE ch.{c.column} IS NOT NULL AND NOT EXISTS "
                 f"(SELECT 1 FROM {p} pa WHERE pa.{c.parent_column} = ch.{c.column})")
        else:
            q = f"SELECT count(*) FROM {t} WHERE {DQ_PREDICATES[c.name]}"
        rows.append(f"SELECT '{c.name}' AS check_name, '{c.layer}' AS layer, ({q}) AS failures")
    return P("SELECT *, failures = 0 AS passed FROM (" + "\nUNION ALL ".join(rows) + ")")


@register("dq_summary", _dq_sql())
def q_dq_summary(spark, sf_dir):
    """The 45 data checks (20 silver, 25 gold) with failure counts."""
    return quality.summary(_dq_stored(spark, sf_dir))


# --- similarity (K1-K4, L4, P12) ----------------------------------------------------------------
SIMILAR_TARGET = LOOKUP_UNIT


@register("similar_one", O.similar_one_sql(SIMILAR_TARGET, 5, PARAMS.DESIGN_FEATURES))
def q_similar_one(spark, sf_dir):
    """Five most similar designs to one unit (scaler fitted without the target)."""
    return similarity.similar_one(Layers(spark, sf_dir).registry, SIMILAR_TARGET, 5)


# --- physics (M4-M12) ------------------------------------------------------------------------
REG_PHYS = """reg_phys AS (
  SELECT transformer_id, rated_power_mva, hv_voltage_kv,
         CASE WHEN no_load_loss_kw <= 0 THEN 8e0 ELSE load_loss_kw / no_load_loss_kw END AS loss_ratio,
         CASE cooling_type WHEN 'ODAF' THEN 60e0 WHEN 'OFWF' THEN 58e0 WHEN 'OFAF' THEN 55e0 WHEN 'ONAF' THEN 52e0 ELSE 48e0 END AS oil_rise_c,
         CASE cooling_type WHEN 'ODAF' THEN 12e0 WHEN 'OFWF' THEN 13e0 WHEN 'OFAF' THEN 15e0 WHEN 'ONAF' THEN 18e0 ELSE 20e0 END AS winding_grad_c
  FROM reg)"""
K = "(m.load_percent / 100e0)"
OIL_SS = (f"CASE WHEN {K} <= 0 THEN m.ambient_temperature_c ELSE m.ambient_temperature_c + r.oil_rise_c * "
          f"pow((1e0 + r.loss_ratio * {K} * {K}) / (1e0 + r.loss_ratio), 0.8e0) END")
WIND_SS = f"CASE WHEN {K} <= 0 THEN m.oil_temperature_c ELSE m.oil_temperature_c + r.winding_grad_c * pow({K}, 1.6e0) END"
CUR = ("CASE WHEN sqrt(3e0) * r.hv_voltage_kv * 1e3 <= 0 THEN 0e0 ELSE "
       "r.rated_power_mva * 1e6 * m.load_percent / 100e0 / (sqrt(3e0) * r.hv_voltage_kv * 1e3) END")
VOLT = ("r.hv_voltage_kv * (1e0 - CASE WHEN m.load_percent > 0 THEN 0.02e0 * m.load_percent / 100e0 ELSE 0e0 END)")


@register("expected_temps", P(f"""
SELECT m.transformer_id, m.ts, {O.rhu(OIL_SS, 2)} AS expected_oil_c, {O.rhu(WIND_SS, 2)} AS expected_winding_c
FROM meas m JOIN reg_phys r ON r.transformer_id = m.transformer_id""", (REG_PHYS,)))
def q_expected_temps(spark, sf_dir):
    """M4/M5/M7/M8: steady-state top-oil and hot-spot expected for each reading."""
    from ..operators import thermal
    L = Layers(spark, sf_dir)
    return thermal.expected_temperatures(L.measurements, L.registry)


@register("electrical", P(f"""
SELECT m.transformer_id, m.ts, {O.rhu(CUR, 2)} AS expected_current_a, {O.rhu(VOLT, 2)} AS expected_voltage_kv
FROM meas m JOIN reg_phys r ON r.transformer_id = m.transformer_id""", (REG_PHYS,)))
def q_electrical(spark, sf_dir):
    """Expected HV current and loaded voltage for each reading."""
    from ..operators import thermal
    L = Layers(spark, sf_dir)
    return thermal.electrical(L.measurements, L.registry)


@register("sensor_residuals", P(f"""
SELECT transformer_id, count(*) AS n,
       {O.rhu(O.xavg('r_oil'), 3)} AS mean_oil_residual, {O.rhu(O.xavg('r_winding'), 3)} AS mean_winding_residual,
       {O.rhu(O.xavg('r_current'), 3)} AS mean_current_residual, {O.rhu(O.xavg('r_voltage'), 3)} AS mean_voltage_residual
FROM (SELECT m.transformer_id,
             {O.rhu(f'm.oil_temperature_c - ({OIL_SS})', 3)} AS r_oil,
             {O.rhu(f'm.winding_temperature_c - ({WIND_SS})', 3)} AS r_winding,
             {O.rhu(f'm.current_a - ({CUR})', 3)} AS r_current,
             {O.rhu(f'm.voltage_kv - ({VOLT})', 3)} AS r_voltage
      FROM meas m JOIN reg_phys r ON r.transformer_id = m.transformer_id)
GROUP BY 1""", (REG_PHYS,)))
def q_sensor_residuals(spark, sf_dir):
    """Per unit mean residual of oil, winding, current and voltage against the physics model."""
    from ..operators import thermal
    L = Layers(spark, sf_dir)
    return thermal.sensor_residuals(L.measurements, L.registry)


@register("state_events", P("""
SELECT transformer_id, ts, previous_state, state, CASE WHEN state = 'NORMAL' THEN 'INFO' ELSE state END AS severity
FROM (SELECT transformer_id, ts, state,
             lag(state) OVER (PARTITION BY transformer_id ORDER BY ts, state) AS previous_state FROM meas)
WHERE previous_state IS NOT NULL AND previous_state <> state"""))
def q_state_events(spark, sf_dir):
    """Operating-state transitions per unit as events (skew-safe bucketed lag)."""
    from ..operators import thermal
    return thermal.state_transitions(Layers(spark, sf_dir).measurements)


LAG_STEPS = f"""lag_in AS (
  SELECT m.transformer_id, m.ts, m.ambient_temperature_c, m.load_percent, ({OIL_SS}) AS oil_target,
         CASE WHEN {K} <= 0 THEN 0e0 ELSE r.winding_grad_c * pow({K}, 1.6e0) END AS rise,
         row_number() OVER w AS rn, coalesce(epoch(m.ts) - epoch(lag(m.ts) OVER w), 0) AS dt
  FROM meas m JOIN reg_phys r ON r.transformer_id = m.transformer_id
  WINDOW w AS (PARTITION BY m.transformer_id ORDER BY m.ts)),
lag_c AS (SELECT *, exp(-dt / 5400e0) AS ao, exp(-dt / 420e0) AS aw FROM lag_in),
lag_run AS (
  SELECT transformer_id, rn, ambient_temperature_c AS oil, ambient_temperature_c AS winding FROM lag_c WHERE rn = 1
  UNION ALL
  SELECT c.transformer_id, c.rn, c.ao * p.oil + (1 - c.ao) * c.oil_target,
         c.aw * p.winding + (1 - c.aw) * (c.ao * p.oil + (1 - c.ao) * c.oil_target + c.rise)
  FROM lag_run p JOIN lag_c c ON c.transformer_id = p.transformer_id AND c.rn = p.rn + 1)"""


LAG_SQL = P("""
SELECT c.transformer_id, c.ts, c.ambient_temperature_c, c.load_percent, round(p.oil, 6) AS model_oil_c,
       round(p.winding, 6) AS model_winding_c
FROM lag_run p JOIN lag_c c ON c.transformer_id = p.transformer_id AND c.rn = p.rn""",
            (REG_PHYS, LAG_STEPS)).replace("WITH ", "WITH RECURSIVE ", 1)


@register("thermal_lag", LAG_SQL)
def q_thermal_lag(spark, sf_dir):
    """M6: modelled top-oil / winding temperatures with first-order thermal lags."""
    from ..operators import thermal
    L = Layers(spark, sf_dir)
    return thermal.thermal_lag(L.measurements, L.registry)


LANDING_FILES = 12  # files that a landing is written in, at most, and that a micro-batch takes


@register("thermal_lag_stream", LAG_SQL)
def q_thermal_lag_stream(spark, sf_dir):
    """M6 on a stream: measurements landed in three stretches of time, the model's state kept per unit between them."""
    from ..streaming import lag_stream
    L = Layers(spark, sf_dir)
    landing, out = _scratch(spark, "lag-landing"), _scratch(spark, "lag-out")
    rows = L.measurements.select("transformer_id", "ts", "ambient_temperature_c", "load_percent").persist()
    span = rows.agg(F.min(F.year("ts")), F.max(F.year("ts"))).first()
    third = max((span[1] - span[0]) // 3, 1) if span[0] is not None else 1
    part = F.least(F.floor((F.year("ts") - F.lit(span[0] or 0)) / F.lit(third)), F.lit(2))
    for i in range(3):
        # a unit's readings are in one file, so they arrive in order however files are put into micro-batches
        rows.where(part == i).repartition(LANDING_FILES, "transformer_id").write.parquet(f"{landing}/{i}")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", LANDING_FILES).parquet(landing + "/*")
    lag_stream.start(spark, stream, L.registry, out, out + "-checkpoint").awaitTermination()
    rows.unpersist()
    return spark.read.schema(lag.LAG_SCHEMA).parquet(out)


# --- anomaly (K6-K10, A17) ----------------------------------------------------------------------
@register("anomalies")
def q_anomalies(spark, sf_dir):
    """Isolation-Forest labels and scores for every measurement (rows check)."""
    from ..operators import anomaly
    return anomaly.detect(Layers(spark, sf_dir).measurements)


@register("anomaly_summary")
def q_anomaly_summary(spark, sf_dir):
    """Points analysed and outliers found (rows check)."""
    from ..operators import anomaly
    return anomaly.summary(anomaly.detect(Layers(spark, sf_dir).measurements))


@register("anomaly_points", P("""
SELECT transformer_id, count(*) AS points, CAST(0 AS BIGINT) AS bad_scores, CAST(0 AS BIGINT) AS mislabelled
FROM meas GROUP BY transformer_id"""))
def q_anomaly_points(spark, sf_dir):
    """Points analysed per unit, scores outside [-1, 0], and labels that contradict the one threshold."""
    from ..operators import anomaly
    return anomaly.label_audit(anomaly.detect(Layers(spark, sf_dir).measurements))


# --- sources, sinks and streaming (S1-S6, S11, S12, T1-T8) ---------------------------------------
def _scratch(spark, name: str) -> str:
    import uuid
    from ..session import checkpoint_dir
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:10]}"


@register("registry_csv", P(f"SELECT * REPLACE ({O.EXPORTED}) FROM reg"))
def q_registry_csv(spark, sf_dir):
    """S6 -> S1/S12: export the validated registry as CSV (fixed decimals), load it back strictly."""
    from ..sources import files
    path = _scratch(spark, "registry-export")
    files.export_registry(Layers(spark, sf_dir).registry, path, "csv")
    return files.read_registry_csv(spark, path, ADAPTER_ID_PATTERN)


def _raw_with_fields(L: Layers) -> DataFrame:
    """Raw records with the message fields that their measurement lines hold."""
    return ingest.raw_records(L.first, L.source, ("timestamp", *O_MEAS, "state"))


@register("replay", P("SELECT * FROM stg"))
def q_replay(spark, sf_dir):
    """Dump bronze as JSON lines (raw + measurement lines), replay it, rebuild silver."""
    from ..operators import silver
    from ..sources import files
    L = Layers(spark, sf_dir)
    path = _scratch(spark, "bronze-dump")
    files.write_bronze_lines(_raw_with_fields(L), None, path)
    got = files.read_bronze_lines(spark, path)
    return silver.stg_telemetry(got["raw"])


@register("stream_ingest", P("SELECT * FROM meas"))
def q_stream_ingest(spark, sf_dir):
    """Envelope files landed year by year in receive order, then a redelivery, ingested by one run of the
    Structured Streaming query, about a landing per micro-batch; equals the batch measurements."""
    from ..streaming import ingest as stream
    L = Layers(spark, sf_dir)
    landing, out = _scratch(spark, "landing"), _scratch(spark, "bronze")
    env = L.envelopes  # written by row from the table for each landing: kept whole it would take many times the table
    ids = L.registry.select("transformer_id").persist()
    with shuffles_dropped(spark):
        span = env.agg(F.min(F.year("received_at")), F.max(F.year("received_at"))).first()
    years = range(span[0], span[1] + 1) if span[0] is not None else [None]
    received = F.year("received_at")
    landings = [received.eqNullSafe(F.lit(y)) | (received.isNull() if i == 0 else F.lit(False)) for i, y in enumerate(years)]
    landings.append(F.xxhash64("payload") % 20 == 0)  # delivered again
    # messages of one unit and instant are in one file of a landing, so a micro-batch that ends within a landing
    # still decides between them by receive time
    field = lambda c: F.get_json_object("payload", f"$.{c}")
    same = [field("transformer_id"), parse_rfc3339(field("timestamp"))]
    with shuffles_dropped(spark):
        for i, rows in enumerate(landings):
            env.filter(rows).repartition(LANDING_FILES, *same).write.option("compression", "gzip").json(f"{landing}/{i:04d}")
    stream.start_ingest(spark, landing + "/*", ids, out, checkpoint=out + "-checkpoint", max_files_per_trigger=LANDING_FILES,
                        buckets=4, slice_seconds=86_400).awaitTermination()
    ids.unpersist()
    return stream.read_tables(spark, out)["measurements"].drop(*stream.PARTS)


@register("backfill", P("""
SELECT 'transformers' AS what, count(*) AS n FROM reg UNION ALL SELECT 'raw', count(*) FROM first_acc
UNION ALL SELECT 'measurements', count(*) FROM meas"""))
def q_backfill(spark, sf_dir):
    """Registry file and bronze dump loaded through the stream's sink; counts of what was stored."""
    from ..sources import files
    from ..streaming.backfill import backfill
    L = Layers(spark, sf_dir)
    csv, dump = _scratch(spark, "registry-export"), _scratch(spark, "bronze-dump")
    files.export_registry(L.registry, csv, "csv")
    files.write_bronze_lines(_raw_with_fields(L), None, dump)
    return backfill(spark, csv, dump, _scratch(spark, "backfill"), ADAPTER_ID_PATTERN)[1]


@register("similar_all", O.similar_all_sql(5, PARAMS.DESIGN_FEATURES))
def q_similar_all(spark, sf_dir):
    """Exact top-5 similar designs for every unit (k-d partition + box pruning, no all-pairs)."""
    from ..operators import knn
    return knn.similar_all(Layers(spark, sf_dir).registry, 5)


@register("similar_all_refit", O.similar_refit_sql(5, PARAMS.DESIGN_FEATURES))
def q_similar_all_refit(spark, sf_dir):
    """K2/K5: exact top-5 for every unit, each target's scaler fitted on the other units."""
    from ..operators import knn
    return knn.similar_all(Layers(spark, sf_dir).registry, 5, refit=True)


@register("dq_state_mismatch", P("""
SELECT id, transformer_id, ts, state, state_recomputed FROM int_tel WHERE state IS DISTINCT FROM state_recomputed"""))
def q_dq_state_mismatch(spark, sf_dir):
    """The failing rows of one check — payload state differing from the recomputed state."""
    check = next(c for c in quality.CHECKS if c.name == "assert_int_state_matches_recomputed")
    return quality.failing_rows(check, _dq_tables(Layers(spark, sf_dir)))


def _dq_failures_sql() -> str:
    """Failing keys of every check, each by a statement of its own."""
    identity = {"stg_telemetry": "id", "int_telemetry": "id", "fact_transformer_measurement": "transformer_key || '|' || time_key"}
    rows = []
    for c in quality.CHECKS:
        t = DQ_SQL_TABLES[c.table]
        key, where, having = f"CAST({c.column} AS VARCHAR)", "true", "HAVING count(*) > 0"
        if c.kind in ("not_null", "expr"):
            key = identity.get(c.table, "'NULL'")  # elsewhere only the key itself is checked
            where = f"{c.column} IS NULL" if c.kind == "not_null" else DQ_PREDICATES[c.name]
        elif c.kind == "unique":
            where, having = f"{c.column} IS NOT NULL", "HAVING count(*) > 1"
        elif c.kind == "unique_key":
            key, having = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), 'NULL')" for k in c.columns), "HAVING count(*) > 1"
        elif c.kind == "accepted_values":
            where = f"{c.column} NOT IN ({DQ_VALUES[c.column]})"
        else:
            where = f"NOT EXISTS (SELECT 1 FROM {DQ_SQL_TABLES[c.parent]} pa WHERE pa.{c.parent_column} = ch.{c.column})" + \
                (f" AND {c.column} IS NOT NULL" if c.kind == "relationships" else "")
        source = t if t.startswith("(") else f"{t} ch"
        rows.append(f"SELECT '{c.name}' AS check_name, '{c.layer}' AS layer, coalesce({key}, 'NULL') AS failing_key, count(*) AS n "
                    f"FROM {source} WHERE {where} GROUP BY ALL {having}")
    return P("\nUNION ALL ".join(rows))


@register("dq_failing_rows", _dq_failures_sql())
def q_dq_failing_rows(spark, sf_dir):
    """What the failure store keeps of all 45 checks: the failing keys and how many rows have each."""
    return quality.failures(_dq_stored(spark, sf_dir)).drop("row")
