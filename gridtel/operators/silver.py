"""Silver layer: staged telemetry (``stg``) and enriched telemetry (``int``)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from .. import schemas as S
from ..functions.measures import classify_state, oil_margin, thermal_stress_index, winding_margin
from ..functions.timefmt import normalize_ts
from .dedup import KEY_HASH, keep_latest

NUMERIC = S.MEASUREMENT_COLUMNS
# Latest ingestion wins per (unit, payload timestamp text); the remaining
# fields make the order total.
LATEST_ORDER = ("ingested_at", "id", "current_a", "load_percent", "ambient_temperature_c",
                "winding_temperature_c", "voltage_kv", "oil_level_percent", "state_payload",
                "oil_temperature_c", "payload_transformer_id", "source")


def extract_payload(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Version filter, payload fields as text, numeric cast, quality flag.

    One JSON parse per row (all fields as text, JSON null -> NULL).  With
    ANSI casts a non-numeric text aborts the job, as in the reference;
    ``lenient=True`` turns it into NULL instead.  Raw rows that come with their ``timestamp`` text and its ``KEY_HASH``,
    straight from ``ingest.first_by_message``, keep both: they are the payload's own field and the hash of the key.
    """
    src = raw.filter(F.col("schema_version") == P.SCHEMA_VERSION)
    txt = F.from_json(F.col("payload"), S.PAYLOAD_TEXT_SCHEMA)
    src = src.withColumn("_p", txt)
    num = [(F.col("_p." + c).try_cast("double") if lenient else F.col("_p." + c).cast("double")).alias(c)
           for c in NUMERIC]
    incomplete = (F.col("_p.load_percent").isNull() | F.col("_p.winding_temperature_c").isNull()
                  | F.col("_p.oil_temperature_c").isNull())
    dealt = KEY_HASH in raw.columns
    return src.select(
        *[KEY_HASH] * dealt, "id", "transformer_id",
        F.col("_p.transformer_id").alias("payload_transformer_id"),
        F.col("timestamp" if dealt else "_p.timestamp").alias("ts_raw"),
        "source", "ingested_at", *num,
        F.col("_p.state").alias("state_payload"),
        F.when(incomplete, F.lit("incomplete")).otherwise(F.lit("complete")).alias("quality_flag"),
    )


def stg_telemetry(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Staged telemetry: U5 latest-wins dedup on (unit, ts text), P5 instant, P6 state."""
    ex = extract_payload(raw, lenient)
    latest = keep_latest(ex, ["transformer_id", "ts_raw"], LATEST_ORDER)
    return latest.select(
        "id", "transformer_id", "payload_transformer_id", "source", "ingested_at",
        normalize_ts("ts_raw").alias("ts"), *NUMERIC,
        F.upper(F.trim(F.col("state_payload"))).alias("state"), "quality_flag")


def int_telemetry(stg: DataFrame) -> DataFrame:
    """Enriched telemetry: M1 stress index, M2 recomputed state, P14 margins."""
    return stg.select(
        "id", "transformer_id", "ts", "source", "ingested_at", *NUMERIC, "state",
        thermal_stress_index().alias("thermal_stress_index"),
        classify_state().alias("state_recomputed"),
        winding_margin().alias("winding_margin_c"),
        oil_margin().alias("oil_margin_c"),
        "quality_flag")
