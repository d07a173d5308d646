"""Accepted messages -> bronze raw records and normalized measurements."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import classify_state
from . import contract
from .dedup import KEY_HASH, keep_first, keep_first_hashed

# Total order deciding which redelivery is "first": receive time, then the
# payload values, so equal receive times still resolve deterministically.
FIRST_ORDER = ("received_at", "current_a", "load_percent", "ambient_temperature_c",
               "winding_temperature_c", "voltage_kv", "oil_level_percent", "state",
               "oil_temperature_c", "payload")


def first_accepted(validated: DataFrame) -> DataFrame:
    """Accepted rows, first occurrence of ``<unit>@<timestamp>`` wins."""
    return first_by_message(validated).drop(KEY_HASH)


def first_by_message(validated: DataFrame) -> DataFrame:
    """``first_accepted`` with the hash of (unit, timestamp text) by which its rows are dealt and sorted.

    Grouped by the two parts of the message id, of which neither is null and the second, an RFC3339 text, holds no ``@``;
    the id itself is written behind the shuffle.
    """
    acc = contract.accepted(validated).select(
        "transformer_id", "timestamp", "schema_version", "topic", "payload", "received_at", "ts", "load_percent",
        "ambient_temperature_c", "oil_temperature_c", "winding_temperature_c", "oil_level_percent", "current_a",
        "voltage_kv", "state")
    first = contract.with_dedup_key(keep_first_hashed(acc, ["transformer_id", "timestamp"], FIRST_ORDER))
    return first.select(KEY_HASH, "id", "transformer_id", "schema_version", "topic", "payload", "received_at", "timestamp", "ts",
                        "load_percent", "ambient_temperature_c", "oil_temperature_c", "winding_temperature_c",
                        "oil_level_percent", "current_a", "voltage_kv", "state")


def raw_records(first: DataFrame, source: str = "mqtt", extra=()) -> DataFrame:
    """Bronze rows with provenance and the verbatim payload."""
    return first.select("id", "transformer_id", "schema_version", "topic", F.lit(source).alias("source"),
                        F.col("received_at").alias("ingested_at"), "payload", *extra)


def measurements(rows: DataFrame, extra=()) -> DataFrame:
    """S5 + U2 + P7: first row per (unit, instant), state recomputed.

    ``rows`` are accepted messages or ``first_accepted`` of them, with the same result: a message id names one
    (unit, instant), so the first of the firsts is the first of all.  Only what the table keeps is shuffled; the payload
    breaks no tie here, as rows that differ in nothing else give the same measurement.
    """
    order = [c for c in FIRST_ORDER if c != "payload"]
    return as_measurements(keep_first(rows.select("transformer_id", "ts", *order, *extra), ["transformer_id", "ts"], order),
                           extra)


def as_measurements(rows: DataFrame, extra=()) -> DataFrame:
    """Accepted rows in the columns of the measurement table, state recomputed."""
    return rows.select("transformer_id", "ts", "load_percent", "ambient_temperature_c", "oil_temperature_c",
                       "winding_temperature_c", "oil_level_percent", "current_a", "voltage_kv",
                       classify_state().alias("state"), F.col("received_at").alias("ingested_at"), *extra)
