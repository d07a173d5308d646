"""The lag model on a stream equals the batch result; restart and initial state."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtel.operators import lag
from gridtel.plans.layers import Layers
from gridtel.streaming import lag_stream

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    layers = Layers(spark, SF)
    few = [r.transformer_id for r in layers.registry.orderBy("transformer_id").limit(40).collect()]
    m = layers.measurements.where(F.col("transformer_id").isin(few)).select("transformer_id", "ts", "ambient_temperature_c", "load_percent").cache()
    reg = layers.registry.cache()
    return m, reg, lag.thermal_lag(m, reg, 3).cache()


def landings(m):
    year = F.year("ts")
    return [m.where(year < 1994), m.where((year >= 1994) & (year < 1996)), m.where(year >= 1996)]


def compare(got, want):
    key = ["transformer_id", "ts"]
    a, b = (x.toPandas().sort_values(key).reset_index(drop=True) for x in (got, want))
    assert len(a) == len(b) > 0 and (a[key] == b[key]).all().all()
    for c in ("model_oil_c", "model_winding_c"):
        assert np.allclose(a[c], b[c], atol=1e-5)


def run(spark, scratch, reg, schema, initial=None):
    rows = spark.readStream.schema(schema).parquet(scratch + "/landing/*")
    lag_stream.start(spark, rows, reg, scratch + "/out", scratch + "/ck", initial).awaitTermination()


def test_three_landings_with_restarts_equal_the_batch(spark, scratch, tables):
    m, reg, want = tables
    for i, part in enumerate(landings(m)):
        part.coalesce(1).write.parquet(f"{scratch}/landing/{i}")
        run(spark, scratch, reg, m.schema)      # each run is a restart that finds the state of the one before
    compare(spark.read.parquet(scratch + "/out"), want)


def test_goes_on_from_a_batch_result(spark, scratch, tables):
    m, reg, want = tables
    first, second, third = landings(m)
    done = lag.thermal_lag(first, reg, 3)
    second.unionByName(third).coalesce(1).write.parquet(scratch + "/landing/0")
    run(spark, scratch, reg, m.schema, lag.final_states(done))
    compare(spark.read.parquet(scratch + "/out").unionByName(done), want)


def test_late_readings_move_nothing_back(spark, scratch, tables):
    _, reg, _ = tables
    unit = reg.orderBy("transformer_id").first().transformer_id
    schema = "transformer_id string, ts timestamp, ambient_temperature_c double, load_percent double"
    for i, rows in enumerate(([("2026-01-01 10:00:00", 20.0, 0.0), ("2026-01-01 11:00:00", 20.0, 80.0)],
                              [("2026-01-01 09:00:00", 20.0, 120.0), ("2026-01-01 11:30:00", 20.0, 80.0)])):
        spark.createDataFrame([(unit, *r) for r in rows], "u string, t string, a double, l double") \
            .selectExpr("u AS transformer_id", "cast(t AS timestamp) AS ts", "a AS ambient_temperature_c", "l AS load_percent") \
            .coalesce(1).write.parquet(f"{scratch}/landing/{i}")
        run(spark, scratch, reg, spark.createDataFrame([], schema).schema)
    out = {r.ts.strftime("%H:%M"): r.model_oil_c for r in spark.read.parquet(scratch + "/out").collect()}
    assert out["09:00"] == out["11:00"] < out["11:30"] and len(out) == 4


def test_one_call_per_bucket_models_many_units(spark, scratch, tables):
    """Units share buckets: each task call works on all units of a bucket, and their states do not mix."""
    m, reg, want = tables
    for i, part in enumerate(landings(m)):
        part.repartition(3, "transformer_id").write.parquet(f"{scratch}/landing/{i}")
    rows = spark.readStream.schema(m.schema).option("maxFilesPerTrigger", 3).parquet(scratch + "/landing/*")
    lag_stream.start(spark, rows, reg, scratch + "/out", scratch + "/ck", buckets=2).awaitTermination()
    compare(spark.read.parquet(scratch + "/out"), want)
    state = spark.read.format("statestore").option("path", scratch + "/ck").option("stateVarName", "last").load()
    assert 0 < state.count() <= 2


def test_no_number_stays_in_its_unit():
    got = lag.scan_units(np.array([0.0, 0.5, 0.0, 0.5]), np.array([np.nan, 1.0, 2.0, 1.0]), np.array([True, False, True, False]))
    assert np.isnan(got[:2]).all() and list(got[2:]) == [2.0, 2.0]
