"""Contract validation: the reference's reject table, topics, dedup."""
import json

import pytest
from pyspark.sql import functions as F

from gridtel import schemas as S
from gridtel.operators import contract, ingest

VALID = {"schema_version": 1, "transformer_id": "TR-001", "timestamp": "2026-08-12T05:16:10Z",
         "load_percent": 72.4, "ambient_temperature_c": 27.3, "oil_temperature_c": 61.8,
         "winding_temperature_c": 74.2, "oil_level_percent": 94.1, "current_a": 812.0, "voltage_kv": 230.0,
         "state": "NORMAL"}
TOPIC = "transformers/TR-001/telemetry"


def mutate(**kw):
    d = dict(VALID)
    d.update(kw)
    return json.dumps(d)


CASES = [
    ("valid", TOPIC, json.dumps(VALID), None),
    ("broken json", TOPIC, "{not json", "unparsable"),
    ("trailing text", TOPIC, json.dumps(VALID) + " x", "unparsable"),
    ("array", TOPIC, "[1,2]", "unparsable"),
    ("string for number", TOPIC, mutate(load_percent="72.4"), "unparsable"),
    ("version 2", TOPIC, mutate(schema_version=2), "unsupported_schema"),
    ("unknown unit", "transformers/TR-999/telemetry", mutate(transformer_id="TR-999"), "unknown_transformer"),
    ("bad timestamp", TOPIC, mutate(timestamp="nope"), "bad_timestamp"),
    ("date only", TOPIC, mutate(timestamp="2026-08-12"), "bad_timestamp"),
    ("no zone", TOPIC, mutate(timestamp="2026-08-12T05:16:10"), "bad_timestamp"),
    ("future", TOPIC, mutate(timestamp="2999-01-01T00:00:00Z"), "bad_timestamp"),
    ("negative load", TOPIC, mutate(load_percent=-1), "range:load_percent"),
    ("oil 999", TOPIC, mutate(oil_temperature_c=999), "range:oil_temperature_c"),
    ("winding below oil", TOPIC, mutate(winding_temperature_c=61.8 - 3), "range:winding_temperature_c"),
    ("winding within tolerance", TOPIC, mutate(winding_temperature_c=61.5), None),
    ("negative current", TOPIC, mutate(current_a=-5), "range:current_a"),
    ("missing voltage -> 0", TOPIC, json.dumps({k: v for k, v in VALID.items() if k != "voltage_kv"}),
     "range:voltage_kv"),
    ("missing load -> 0 passes", TOPIC, json.dumps({k: v for k, v in VALID.items() if k != "load_percent"}), None),
    ("bad state", TOPIC, mutate(state="BROKEN"), "bad_state"),
    ("topic mismatch", "transformers/TR-002/telemetry", json.dumps(VALID), "topic"),
    ("bad topic shape", "transformers/TR-001/telemetry/x", json.dumps(VALID), "topic"),
    ("empty topic id", "transformers//telemetry", json.dumps(VALID), "topic"),
]


def test_reject_reasons(spark):
    rows = [(t, p, None) for _, t, p, _ in CASES]
    env = spark.createDataFrame(rows, S.ENVELOPE_SCHEMA).withColumn("i", F.monotonically_increasing_id())
    reg = spark.createDataFrame([("TR-001",), ("TR-002",)], "transformer_id string")
    out = contract.validate(env, reg).orderBy("i").select("reject_reason").collect()
    got = [r[0] for r in out]
    assert got == [c[3] for c in CASES], list(zip([c[0] for c in CASES], got))


def test_redelivery_first_wins(spark):
    base = json.dumps(VALID)
    later = mutate(load_percent=80.0)
    rows = [(TOPIC, base, None), (TOPIC, later, None), (TOPIC, base, None)]
    import datetime as dt
    t0 = dt.datetime(2026, 8, 12, 5, 16, 11)
    rows = [(t, p, t0 + dt.timedelta(seconds=i)) for i, (t, p, _) in enumerate(rows)]
    env = spark.createDataFrame(rows, S.ENVELOPE_SCHEMA)
    reg = spark.createDataFrame([("TR-001",)], "transformer_id string")
    first = ingest.first_accepted(contract.validate(env, reg))
    raw = ingest.raw_records(first).collect()
    meas = ingest.measurements(first).collect()
    assert len(raw) == 1 and len(meas) == 1
    assert raw[0]["id"] == "TR-001@2026-08-12T05:16:10Z"
    assert meas[0]["load_percent"] == 72.4
    assert meas[0]["state"] == "NORMAL"


@pytest.mark.parametrize("topic,unit", [
    ("transformers/TR-001/telemetry", "TR-001"), ("transformers/TR-001/status", None),
    ("transformers/TR-001", None), ("foo/TR-001/telemetry", None), ("transformers//telemetry", None),
])
def test_topic_parse(spark, topic, unit):
    from gridtel.functions.text import topic_unit
    assert spark.createDataFrame([(topic,)], "t string").select(topic_unit("t")).first()[0] == unit


def test_timestamp_text_is_read_once(spark):
    """The rules and the output name the instant; a plan that repeats it matches every text again for each."""
    from gridtel.operators import contract
    from gridtel.plans.layers import Layers
    plan = contract.accepted(Layers(spark, "/root/testdata/sf0.001").validated)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("^\\d{4}-") == 1
