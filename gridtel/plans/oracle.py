"""DuckDB oracle SQL: an independent statement of each query's semantics.

The CTEs restate the stand-in input mapping directly on the driver tables
(no JSON round trip) and the contract / dedup / silver / gold rules in
plain SQL.  Column names match the Spark results.
"""
from __future__ import annotations

def r2(e: str) -> str:
    return f"CAST(CAST({e} AS DECIMAL(12,2)) AS DOUBLE)"


def rhu(e: str, n: int) -> str:
    """Half-away-from-zero rounding through DECIMAL, as DOUBLE."""
    return f"CAST(round(CAST({e} AS DECIMAL(28,9)), {n}) AS DOUBLE)"


def rhe(e: str, n: int) -> str:
    """Half-even rounding through DECIMAL, as DOUBLE."""
    return f"CAST(round_even(CAST({e} AS DECIMAL(28,9)), {n}) AS DOUBLE)"


def xavg(e: str) -> str:
    """Average of the values as they are (six decimals hold every input), order-independent."""
    return f"(CAST(sum(CAST({e} AS DECIMAL(18,6))) AS DOUBLE)/nullif(count({e}),0))"


TSI = rhu("least(1.0e0, 0.5e0*greatest({w},0e0)/105e0 + 0.3e0*greatest({o},0e0)/100e0"
          " + 0.2e0*greatest({l},0e0)/140e0)", 3)


def tsi(w="winding_temperature_c", o="oil_temperature_c", l="load_percent") -> str:
    return TSI.format(w=w, o=o, l=l)


def state(w="winding_temperature_c", o="oil_temperature_c", l="load_percent") -> str:
    return (f"CASE WHEN {w} >= 105e0 OR {o} >= 100e0 OR {l} >= 140e0 THEN 'CRITICAL' "
            f"WHEN {w} >= 95e0 OR {o} >= 90e0 OR {l} > 100e0 THEN 'WARNING' ELSE 'NORMAL' END")


RFC = "strftime({t}, '%Y-%m-%dT%H:%M:%SZ')"

TEL = f"""tel AS (
  SELECT printf('TR-%05d', l_partkey) AS transformer_id,
         CASE WHEN l_suppkey % 50 = 0 THEN 2 ELSE 1 END AS schema_version,
         date_trunc('month', l_shipdate) + to_hours(l_linenumber) AS ts,
         l_shipdate + to_seconds(l_orderkey) AS received_at,
         CASE WHEN l_orderkey % 397 = 0 THEN 0e0 ELSE {r2('l_quantity*4.2e0 + l_linenumber*0.01e0')} END AS load_percent,
         CASE WHEN l_orderkey % 409 = 0 THEN 60.5e0 ELSE {r2('20e0 + l_discount*100 + l_linenumber*0.02e0')} END AS ambient_temperature_c,
         CASE WHEN l_orderkey % 433 = 0 THEN 160e0 ELSE {r2('20e0 + l_discount*100 + l_quantity*1.5e0 + l_linenumber*0.03e0')} END AS oil_temperature_c,
         CASE WHEN l_orderkey % 439 = 0 THEN 210e0 ELSE {r2('19e0 + l_discount*100 + l_quantity*1.5e0 + l_tax*200 + l_linenumber*0.04e0')} END AS winding_temperature_c,
         CASE WHEN l_orderkey % 419 = 0 THEN 120e0 ELSE CAST(85 + l_suppkey % 15 AS DOUBLE) END AS oil_level_percent,
         CASE WHEN l_orderkey % 421 = 0 THEN -1e0 ELSE CAST(floor(l_extendedprice) AS DOUBLE)/100e0 END AS current_a,
         CASE WHEN l_orderkey % 431 = 0 THEN 0e0 ELSE CAST(69 + l_suppkey % 5 AS DOUBLE) END AS voltage_kv,
         CASE WHEN l_orderkey % 401 = 0 THEN lower(st) ELSE st END AS state,
         l_orderkey, l_suppkey,
         printf('TR-%05d', CASE WHEN l_orderkey % 101 = 0 THEN l_suppkey ELSE l_partkey END) AS topic_unit
  FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'NORMAL' WHEN 'N' THEN 'WARNING' ELSE 'CRITICAL' END AS st
        FROM lineitem) li
)"""

PWR = r2("p_size*2 + p_partkey % 7 * 0.13e0")

REG_IN = f"""reg_in AS (
  SELECT CASE WHEN p_partkey % 151 = 0 THEN '' ELSE CASE WHEN p_partkey % 149 = 0 THEN 'UNIT-1' ELSE printf('TR-%05d', p_partkey) END END AS transformer_id,
         CASE WHEN p_partkey % 103 = 0 THEN 0e0 ELSE {PWR} END AS rated_power_mva,
         CASE WHEN p_partkey % 97 = 0 THEN list_extract([13.8e0,34.5e0,69.0e0,115.0e0,138.0e0], CAST(p_partkey % 5 + 1 AS INTEGER))
              ELSE list_extract([69.0e0,138.0e0,230.0e0,345.0e0,500.0e0], CAST(p_partkey % 5 + 1 AS INTEGER)) END AS hv_voltage_kv,
         CASE WHEN p_partkey % 97 = 0 THEN list_extract([69.0e0,138.0e0,230.0e0,345.0e0,500.0e0], CAST(p_partkey % 5 + 1 AS INTEGER))
              ELSE list_extract([13.8e0,34.5e0,69.0e0,115.0e0,138.0e0], CAST(p_partkey % 5 + 1 AS INTEGER)) END AS lv_voltage_kv,
         CASE WHEN p_partkey % 107 = 0 THEN 55 ELSE CASE WHEN p_partkey % 10 = 0 THEN 50 ELSE 60 END END AS frequency_hz,
         CASE WHEN p_partkey % 101 = 0 THEN 2 ELSE 3 END AS phase_count,
         CASE WHEN p_partkey % 109 = 0 THEN 'XX0' ELSE list_extract(['YNd11','YNd1','Ynd5','Yy0','Dyn1','Dd0','YNd5','Yd11','Zyn11'], CAST(p_partkey % 9 + 1 AS INTEGER)) END AS vector_group,
         CASE WHEN p_partkey % 113 = 0 THEN 45e0 ELSE CAST(5 + p_partkey % 20 AS DOUBLE) END AS impedance_percent,
         CASE WHEN p_partkey % 127 = 0 THEN 'AN' ELSE CASE WHEN {PWR} < 15 THEN 'ONAN' WHEN {PWR} < 60 THEN 'ONAF' WHEN {PWR} < 80 THEN 'OFAF' ELSE 'ODAF' END END AS cooling_type,
         CASE WHEN p_partkey % 131 = 0 THEN 1950 ELSE CAST(1990 + p_partkey % 36 AS INTEGER) END AS commissioning_year,
         CASE p_type WHEN 'ECONOMY' THEN 'distribution' WHEN 'STANDARD' THEN 'transmission'
              WHEN 'SMALL' THEN 'industrial' WHEN 'LARGE' THEN 'generation' ELSE 'renewable' END AS application,
         CASE WHEN p_partkey % 137 = 0 THEN -1e0 ELSE CAST(floor(p_retailprice*5) AS DOUBLE)/100e0 END AS no_load_loss_kw,
         CAST(floor(p_retailprice*50) AS DOUBLE)/100e0 AS load_loss_kw,
         CASE WHEN p_partkey % 139 = 0 THEN 0e0 ELSE {r2('22e0 + p_size*1.35e0')} END AS total_mass_t,
         {r2('2e0 + p_size*0.11e0')} AS length_m,
         {r2('1.5e0 + p_size*0.05e0')} AS width_m,
         {r2('2.6e0 + p_size*0.04e0')} AS height_m
  FROM part
)"""

V10 = """CASE
    WHEN coalesce(transformer_id,'') = '' THEN 'empty_id'
    WHEN NOT regexp_full_match(transformer_id, '^TR-\\d{5,}$') THEN 'invalid_id'
    WHEN rated_power_mva <= 0 THEN 'power'
    WHEN hv_voltage_kv <= 0 OR lv_voltage_kv <= 0 OR hv_voltage_kv <= lv_voltage_kv THEN 'voltage_order'
    WHEN frequency_hz NOT IN (50, 60) THEN 'frequency'
    WHEN phase_count NOT IN (1, 3) THEN 'phase'
    WHEN vector_group NOT IN ('YNd11','YNd1','Ynd5','Yy0','Dyn1','Dd0','YNd5','Yd11','Zyn11') THEN 'vector_group'
    WHEN impedance_percent <= 0 OR impedance_percent > 40 THEN 'impedance'
    WHEN cooling_type NOT IN ('ONAN','ONAF','OFAF','OFWF','ODAF') THEN 'cooling_type'
    WHEN commissioning_year < 1960 THEN 'commissioning_year'
    WHEN no_load_loss_kw < 0 OR load_loss_kw < 0 THEN 'losses'
    WHEN total_mass_t <= 0 OR length_m <= 0 OR width_m <= 0 OR height_m <= 0 THEN 'dimensions'
  END"""

REG = f"""reg_chk AS (SELECT *, {V10} AS reject_reason FROM reg_in),
reg AS (SELECT * EXCLUDE (reject_reason) FROM reg_chk WHERE reject_reason IS NULL)"""

VAL = """val AS (
  SELECT tel.*, CASE
    WHEN l_orderkey % 211 = 0 THEN 'unparsable'
    WHEN schema_version <> 1 THEN 'unsupported_schema'
    WHEN NOT EXISTS (SELECT 1 FROM reg WHERE reg.transformer_id = tel.transformer_id) THEN 'unknown_transformer'
    WHEN l_orderkey % 307 = 0 OR l_orderkey % 443 = 0 THEN 'bad_timestamp'
    WHEN load_percent < 0 OR load_percent > 200 THEN 'range:load_percent'
    WHEN ambient_temperature_c < -20 OR ambient_temperature_c > 55 THEN 'range:ambient_temperature_c'
    WHEN oil_temperature_c < -20 OR oil_temperature_c > 150 THEN 'range:oil_temperature_c'
    WHEN winding_temperature_c < oil_temperature_c - 0.5e0 OR winding_temperature_c > 200 THEN 'range:winding_temperature_c'
    WHEN oil_level_percent < 0 OR oil_level_percent > 100 THEN 'range:oil_level_percent'
    WHEN current_a < 0 THEN 'range:current_a'
    WHEN voltage_kv <= 0 THEN 'range:voltage_kv'
    WHEN state NOT IN ('NORMAL','WARNING','CRITICAL') THEN 'bad_state'
    WHEN topic_unit <> transformer_id THEN 'topic'
  END AS reject_reason
  FROM tel
)"""

FIRST_ORDER = ("received_at, current_a, load_percent, ambient_temperature_c, winding_temperature_c, "
               "voltage_kv, oil_level_percent, state, oil_temperature_c")

FIRST = f"""acc AS (
  SELECT *, transformer_id || '@' || {RFC.format(t='ts')} AS id FROM val WHERE reject_reason IS NULL
),
first_acc AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY {FIRST_ORDER}) AS rn FROM acc) WHERE rn = 1
),
meas AS (
  SELECT transformer_id, ts, load_percent, ambient_temperature_c, oil_temperature_c, winding_temperature_c,
         oil_level_percent, current_a, voltage_kv, {state()} AS state, received_at AS ingested_at
  FROM (SELECT *, row_number() OVER (PARTITION BY transformer_id, ts ORDER BY {FIRST_ORDER}) AS rn FROM first_acc)
  WHERE rn = 1
)"""

# Bronze keeps the first row per key; silver's latest-wins on the same key is then a no-op.
STG = """stg AS (
  SELECT id, transformer_id, transformer_id AS payload_transformer_id, 'mqtt' AS source,
         received_at AS ingested_at, ts, CASE WHEN l_orderkey % 397 <> 0 THEN load_percent END AS load_percent,
         ambient_temperature_c, oil_temperature_c, winding_temperature_c, oil_level_percent, current_a, voltage_kv,
         upper(trim(state)) AS state, CASE WHEN l_orderkey % 397 = 0 THEN 'incomplete' ELSE 'complete' END AS quality_flag
  FROM first_acc WHERE schema_version = 1
)"""

INT = f"""int_tel AS (
  SELECT id, transformer_id, ts, source, ingested_at, load_percent, ambient_temperature_c, oil_temperature_c,
         winding_temperature_c, oil_level_percent, current_a, voltage_kv, state,
         {tsi()} AS thermal_stress_index,
         {state()} AS state_recomputed,
         {rhu('105e0 - winding_temperature_c', 2)} AS winding_margin_c,
         {rhu('100e0 - oil_temperature_c', 2)} AS oil_margin_c,
         quality_flag
  FROM stg
)"""

LOC_IDX = "CAST(CAST(('0x' || substr(md5(transformer_id), 1, 8)) AS UBIGINT) % 10 AS INTEGER)"

# The lists of cities and vector groups in these statements are fixed values.
GOLD = f"""fact AS (
  SELECT ts AS time_key, transformer_id AS transformer_key, transformer_id AS location_key,
         load_percent, ambient_temperature_c, oil_temperature_c, winding_temperature_c, oil_level_percent,
         current_a, voltage_kv, thermal_stress_index, state, winding_margin_c, oil_margin_c
  FROM int_tel
),
dim_transformer AS (SELECT transformer_id AS transformer_key, * EXCLUDE (transformer_id) FROM reg),
dim_location AS (
  SELECT transformer_id AS location_key,
         'SUB-' || upper(substr(transformer_id, 4, 3)) || '-' || CAST({LOC_IDX} AS VARCHAR) AS substation,
         list_extract(['São Paulo','Campinas','Jundiaí','Salto','Itu','Sorocaba','Piracicaba','Americana','Valinhos','Indaiatuba'],
                      {LOC_IDX} + 1) AS city,
         CASE WHEN application = 'generation' THEN 'Sul' WHEN application = 'renewable' THEN 'Nordeste'
              ELSE 'Sudeste' END AS region,
         'Brazil' AS country
  FROM reg
),
dim_time AS (
  SELECT time_key, CAST(second(time_key) AS INTEGER) AS second, CAST(minute(time_key) AS INTEGER) AS minute,
         CAST(hour(time_key) AS INTEGER) AS hour, CAST(day(time_key) AS INTEGER) AS day,
         CAST(month(time_key) AS INTEGER) AS month, CAST(year(time_key) AS INTEGER) AS year,
         strftime(time_key, '%Y-%m-%d') AS date, rpad(dayname(time_key), 9, ' ') AS weekday,
         CAST(dayofweek(time_key) AS INTEGER) AS day_of_week, dayofweek(time_key) IN (0, 6) AS is_weekend
  FROM (SELECT DISTINCT ts AS time_key FROM int_tel)
)"""

EVENTS = """ev_in AS (
  SELECT printf('TR-%05d', user_id) AS transformer_id, ts, event_type,
         CASE WHEN user_id % 53 = 0 THEN 'NOTICE' WHEN event_type = 'error' THEN 'CRITICAL' WHEN event_type = 'purchase' THEN 'WARNING' ELSE 'INFO' END AS severity,
         props AS payload
  FROM events
),
ev AS (SELECT * FROM ev_in WHERE severity IN ('INFO', 'WARNING', 'CRITICAL')
       AND EXISTS (SELECT 1 FROM reg WHERE reg.transformer_id = ev_in.transformer_id))"""


# The registry as the export writes it: one decimal, dimensions two.
EXPORTED = ", ".join(
    f"CAST(CAST(CAST({c} AS DECIMAL(14,4)) AS DECIMAL(14,{d})) AS DOUBLE) AS {c}" for c, d in (
        ("rated_power_mva", 1), ("hv_voltage_kv", 1), ("lv_voltage_kv", 1), ("impedance_percent", 1), ("no_load_loss_kw", 1),
        ("load_loss_kw", 1), ("total_mass_t", 1), ("length_m", 2), ("width_m", 2), ("height_m", 2)))

# A message's payload fields as one text, numbers with two decimals.
PAYLOAD_FIELDS_SQL = " || '|' || ".join(
    ["CAST(schema_version AS VARCHAR)", "transformer_id", RFC.format(t="ts"),
     "CASE WHEN l_orderkey % 397 = 0 THEN 'null' ELSE CAST(CAST(load_percent AS DECIMAL(12,2)) AS VARCHAR) END",
     *(f"CAST(CAST({c} AS DECIMAL(12,2)) AS VARCHAR)" for c in (
         "ambient_temperature_c", "oil_temperature_c", "winding_temperature_c", "oil_level_percent",
         "current_a", "voltage_kv")), "state"])


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


PIPE = (TEL, REG_IN, REG, VAL, FIRST, STG, INT, GOLD)


def pipeline_sql(body: str, extra_ctes: tuple = ()) -> str:
    """Full bronze->gold CTE chain (plus ``extra_ctes``) followed by ``body``."""
    return with_ctes(*PIPE, *extra_ctes) + body


def similar_one_sql(target: str, k: int, features, scale: int = 4) -> str:
    """Top-k similarity of one target, scaler fitted on the other units."""
    feat = ", ".join(f"coalesce(CAST({f} AS DOUBLE), 0e0) AS {f}" for f in features)
    moms = ["CAST(count(*) AS DOUBLE) AS n"]
    for f in features:
        x = f"CAST({f} AS DECIMAL(19,{scale}))"
        moms.append(f"CAST(sum({x}) AS DOUBLE) AS s1_{f}")
        moms.append(f"CAST(sum({x} * {x}) AS DOUBLE) AS s2_{f}")
    ms = []
    for f in features:
        sd = f"sqrt(greatest((s2_{f} - s1_{f} * s1_{f} / n) / n, 0e0))"
        ms.append(f"s1_{f} / n AS mean_{f}")
        ms.append(f"CASE WHEN {sd} = 0 THEN 1e0 ELSE {sd} END AS std_{f}")
    terms = []
    for f in features:
        d = f"((t.{f} - ms.mean_{f}) / ms.std_{f} - (c.{f} - ms.mean_{f}) / ms.std_{f})"
        terms.append(f"{d} * {d}")
    dist = "sqrt(" + " + ".join(terms) + ")"
    extra = (f"cands AS (SELECT transformer_id, {feat} FROM reg WHERE transformer_id <> '{target}')",
             f"tgt AS (SELECT {feat} FROM reg WHERE transformer_id = '{target}')",
             f"mom AS (SELECT {', '.join(moms)} FROM cands)",
             f"ms AS (SELECT {', '.join(ms)} FROM mom)")
    return pipeline_sql(f"""SELECT c.transformer_id, {rhe(f'1e0 / (1e0 + {dist})', 4)} AS score
FROM cands c, tgt t, ms
ORDER BY score DESC, c.transformer_id LIMIT {k}""", extra)


def similar_all_sql(k: int, features, scale: int = 4) -> str:
    """Exact top-k for every unit by brute force (scaler fitted on all units)."""
    feat = ", ".join(f"coalesce(CAST({f} AS DOUBLE), 0e0) AS {f}" for f in features)
    moms = ["CAST(count(*) AS DOUBLE) AS n"]
    for f in features:
        x = f"CAST({f} AS DECIMAL(19,{scale}))"
        moms.append(f"CAST(sum({x}) AS DOUBLE) AS s1_{f}")
        moms.append(f"CAST(sum({x} * {x}) AS DOUBLE) AS s2_{f}")
    ms = []
    for f in features:
        sd = f"sqrt(greatest((s2_{f} - s1_{f} * s1_{f} / n) / n, 0e0))"
        ms.append(f"s1_{f} / n AS mean_{f}")
        ms.append(f"CASE WHEN {sd} = 0 THEN 1e0 ELSE {sd} END AS std_{f}")
    zcols = ", ".join(f"(u.{f} - ms.mean_{f}) / ms.std_{f} AS z{i}" for i, f in enumerate(features))
    terms = " + ".join(f"(a.z{i} - b.z{i}) * (a.z{i} - b.z{i})" for i in range(len(features)))
    extra = (f"units AS (SELECT transformer_id, {feat} FROM reg)",
             f"mom AS (SELECT {', '.join(moms)} FROM units)",
             f"ms AS (SELECT {', '.join(ms)} FROM mom)",
             f"zu AS (SELECT u.transformer_id, {zcols} FROM units u, ms)")
    return pipeline_sql(f"""SELECT target_id, rank, transformer_id, score FROM (
  SELECT target_id, transformer_id, score,
         row_number() OVER (PARTITION BY target_id ORDER BY score DESC, transformer_id) AS rank
  FROM (SELECT a.transformer_id AS target_id, b.transformer_id,
               {rhe(f'1e0 / (1e0 + sqrt({terms}))', 4)} AS score
        FROM zu a JOIN zu b ON a.transformer_id <> b.transformer_id))
WHERE rank <= {k}""", extra)


def similar_refit_sql(k: int, features, scale: int = 4) -> str:
    """Exact top-k for every unit by brute force, the scaler fitted for every target on the other units."""
    feat = ", ".join(f"coalesce(CAST({f} AS DOUBLE), 0e0) AS {f}" for f in features)
    exact = {f: f"CAST({f} AS DECIMAL(19,{scale}))" for f in features}
    others = [f"CAST(sum({x}) OVER everyone - {x} AS DOUBLE) AS s1_{f}, CAST(sum({x} * {x}) OVER everyone - {x} * {x} AS DOUBLE) AS s2_{f}"
              for f, x in exact.items()]
    scaler = [f"s1_{f} / n AS mean_{f}, sqrt(greatest((s2_{f} - s1_{f} * s1_{f} / n) / n, 0e0)) AS dev_{f}" for f in features]
    terms = []
    for f in features:
        sd = f"(CASE WHEN t.dev_{f} = 0 THEN 1e0 ELSE t.dev_{f} END)"
        d = f"((t.{f} - t.mean_{f}) / {sd} - (c.{f} - t.mean_{f}) / {sd})"
        terms.append(f"{d} * {d}")
    extra = (f"units AS (SELECT transformer_id, {feat} FROM reg)",
             f"""others AS (SELECT *, CAST(count(*) OVER everyone - 1 AS DOUBLE) AS n, {', '.join(others)}
  FROM units WINDOW everyone AS ())""",
             f"scaled AS (SELECT *, {', '.join(scaler)} FROM others)")
    return pipeline_sql(f"""SELECT target_id, rank, transformer_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY score DESC, transformer_id) AS rank
  FROM (SELECT t.transformer_id AS target_id, c.transformer_id, {rhe(f"1e0 / (1e0 + sqrt({' + '.join(terms)}))", 4)} AS score
        FROM scaled t JOIN units c ON t.transformer_id <> c.transformer_id))
WHERE rank <= {k}""", extra)
