"""Telemetry contract: parse envelopes, give every reject a reason.

The first failing rule wins, in this order: unparsable payload, schema
version, unknown unit, timestamp, ranges (field named), state, topic.
Accepted and rejected rows come out of one pass; rejects keep their payload
so they can be written to a quarantine table.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from .. import schemas as S
from ..functions.text import dedup_key, topic_unit
from ..functions.timefmt import parse_rfc3339

REASON = "reject_reason"


def parse_envelopes(env: DataFrame) -> DataFrame:
    """Parse the JSON payload of ``(topic, payload, received_at)`` rows.

    Adds ``parse_ok``, the topic's unit and the payload fields.  A missing
    numeric field becomes 0 and a missing text field '' (contract rule); a
    wrong JSON type, trailing text, or a non-object makes the row
    unparsable.
    """
    m = F.from_json(F.col("payload"), S.PAYLOAD_SCHEMA_STRICT,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT_COL})
    df = env.withColumn("_m", m)
    parse_ok = (F.col("_m").isNotNull() & F.col("_m." + S.CORRUPT_COL).isNull()
                & F.rtrim(F.col("payload")).endswith("}") & F.ltrim(F.col("payload")).startswith("{"))
    cols = [F.col(c) for c in env.columns]
    fields = []
    for name, dtype in S.PAYLOAD_FIELDS:
        default = F.lit("") if dtype.typeName() == "string" else F.lit(0).cast(dtype)
        fields.append(F.coalesce(F.col("_m." + name), default).alias(name))
    return df.select(*cols, F.coalesce(parse_ok, F.lit(False)).alias("parse_ok"),
                     topic_unit("topic").alias("topic_unit"), *fields)


def _range_reason() -> Column:
    """The limits of ``RANGE_RULES`` in their order, with the two rules that are no plain limits."""
    special = {"winding_temperature_c": F.col("winding_temperature_c") < F.col("oil_temperature_c") - P.WINDING_OIL_TOLERANCE_C,
               "voltage_kv": F.col("voltage_kv") <= 0}
    expr = None
    for name, low, high in P.RANGE_RULES:
        bad = special.get(name, F.lit(False))
        if low is not None:
            bad = bad | (F.col(name) < low)
        if high is not None:
            bad = bad | (F.col(name) > high)
        expr = F.when(bad, F.lit("range:" + name)) if expr is None else expr.when(bad, F.lit("range:" + name))
    return expr


def validate(env: DataFrame, registry_ids: DataFrame, now: Column | None = None,
             max_skew: str = P.DEFAULT_TIMESTAMP_SKEW) -> DataFrame:
    """Envelopes -> parsed rows with ``reject_reason`` (NULL = accepted).

    ``registry_ids`` holds the known ``transformer_id`` values; whether they
    are broadcast is left to Spark's byte limit.
    """
    # the instant is found once, before the join: the rules name it several times, and each would read its text again
    parsed = parse_envelopes(env).withColumn("ts", parse_rfc3339("timestamp"))
    ids = registry_ids.select(F.col("transformer_id").alias("_reg_id")).distinct()
    joined = parsed.join(ids, parsed.transformer_id == ids._reg_id, "left")
    now = now if now is not None else F.current_timestamp()
    ts = F.col("ts")
    reason = (F.when(~F.col("parse_ok"), F.lit("unparsable"))
              .when(F.col("schema_version") != P.SCHEMA_VERSION, F.lit("unsupported_schema"))
              .when(F.col("_reg_id").isNull(), F.lit("unknown_transformer"))
              .when(ts.isNull() | (ts > now + F.expr(f"INTERVAL {max_skew}")), F.lit("bad_timestamp"))
              .otherwise(_range_reason()))
    reason = F.coalesce(reason, F.when(~F.col("state").isin(*P.STATES), F.lit("bad_state")),
                        F.when(F.col("topic_unit").isNull() | (F.col("topic_unit") != F.col("transformer_id")),
                               F.lit("topic")))
    columns = [c for c in parsed.columns if c != "ts"]
    return joined.withColumn(REASON, reason).select(*columns, REASON, "ts")


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col(REASON).isNull())


def rejected(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col(REASON).isNotNull())


def reject_counts(validated: DataFrame) -> DataFrame:
    """Counters per outcome: ``accepted`` or the reject reason, with ``n``."""
    return (validated.groupBy(F.coalesce(F.col(REASON), F.lit("accepted")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n")))


def with_dedup_key(validated: DataFrame) -> DataFrame:
    return validated.withColumn("id", dedup_key("transformer_id", "timestamp"))
