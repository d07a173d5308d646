"""Physics: bucketed transitions and lag model against a sequential brute force."""
import math

import numpy as np
import pandas as pd
import pytest

from gridtel import params as P
from gridtel.operators import thermal
from gridtel.plans.layers import Layers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layers(spark):
    return Layers(spark, SF)


def brute_lag(m: pd.DataFrame, reg: pd.DataFrame) -> pd.DataFrame:
    reg = reg.set_index("transformer_id")
    out = []
    for unit, g in m.sort_values(["transformer_id", "ts", "load_percent", "ambient_temperature_c"]).groupby(
            "transformer_id", sort=False):
        r = reg.loc[unit]
        rise, grad = P.COOLING_RISE.get(r.cooling_type, P.DEFAULT_COOLING_RISE)
        ratio = 8.0 if r.no_load_loss_kw <= 0 else r.load_loss_kw / r.no_load_loss_kw
        y = w = float(g["ambient_temperature_c"].iloc[0])
        prev = None
        for row in g.itertuples(index=False):
            t = row.ts.value / 1e9
            dt = 0.0 if prev is None else max(t - prev, 0.0)
            prev = t
            k = row.load_percent / 100
            tgt = row.ambient_temperature_c if k <= 0 else row.ambient_temperature_c + rise * ((1 + ratio * k * k) / (1 + ratio)) ** 0.8
            y = y + (tgt - y) * (1 - math.exp(-dt / P.OIL_TIME_CONSTANT_S))
            wt = y if k <= 0 else y + grad * k ** 1.6
            w = w + (wt - w) * (1 - math.exp(-dt / P.WINDING_TIME_CONSTANT_S))
            out.append((unit, row.ts, y, w))
    return pd.DataFrame(out, columns=["transformer_id", "ts", "oil", "winding"])


@pytest.mark.parametrize("pieces", [None, 1, 40])
def test_lag_matches_sequential(spark, layers, pieces):
    m = layers.measurements.toPandas()
    reg = layers.registry.toPandas()
    exp = brute_lag(m, reg).set_index(["transformer_id", "ts"]).sort_index()
    got = thermal.thermal_lag(layers.measurements, layers.registry, pieces).toPandas() \
                 .set_index(["transformer_id", "ts"]).sort_index()
    assert len(got) == len(exp)
    assert np.allclose(got["model_oil_c"].to_numpy(), exp["oil"].to_numpy(), atol=1e-4)
    assert np.allclose(got["model_winding_c"].to_numpy(), exp["winding"].to_numpy(), atol=1e-4)


def test_transitions_match_shift(spark, layers):
    m = layers.measurements.select("transformer_id", "ts", "state").toPandas()
    m = m.sort_values(["transformer_id", "ts"])
    m["prev"] = m.groupby("transformer_id")["state"].shift()
    exp = m[m.prev.notna() & (m.prev != m.state)]
    got = thermal.state_transitions(layers.measurements, bucket="month").toPandas()
    assert len(got) == len(exp)
    key = lambda d, c: sorted(zip(d.transformer_id, d.ts, d[c]))
    assert key(got, "previous_state") == key(exp, "prev")


def test_lag_with_tiny_arrow_batches(spark, layers):
    """Pieces cut by Arrow batch boundaries are carried into the next batch."""
    m = layers.measurements.toPandas()
    reg = layers.registry.toPandas()
    exp = brute_lag(m, reg).set_index(["transformer_id", "ts"]).sort_index()
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = thermal.thermal_lag(layers.measurements, layers.registry, 3).toPandas() \
                     .set_index(["transformer_id", "ts"]).sort_index()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert len(got) == len(exp)
    assert np.allclose(got["model_oil_c"].to_numpy(), exp["oil"].to_numpy(), atol=1e-4)
    assert np.allclose(got["model_winding_c"].to_numpy(), exp["winding"].to_numpy(), atol=1e-4)


def test_scan_against_a_loop():
    from gridtel.operators.lag import scan
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 64, 1000):
        a, b = rng.uniform(0, 1, n), rng.normal(0, 50, n)
        a[rng.uniform(size=n) < 0.1] = 0.0
        want, y = [], 0.0
        for i in range(n):
            y = a[i] * y + b[i]
            want.append(y)
        assert np.allclose(scan(a, b), want, rtol=1e-12, atol=1e-9)


def test_a_hot_unit_of_one_day_spreads_over_pieces(spark, layers):
    """A unit whose rows all lie in one day is cut by row count, and the chained pieces equal one sequential run."""
    from gridtel.operators import lag
    unit = layers.registry.first().transformer_id
    hot = spark.range(3000).selectExpr(f"'{unit}' AS transformer_id", "timestamp'2026-01-01' + make_dt_interval(0, 0, 0, id * 20) AS ts",
                                       "10D + id % 17 AS ambient_temperature_c", "double(id % 140) AS load_percent")
    rows = lag.pieces_of(hot, layers.registry, 8)
    sizes = [r["count"] for r in rows.groupBy("piece").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 900
    exp = brute_lag(hot.toPandas(), layers.registry.toPandas())
    got = thermal.thermal_lag(hot, layers.registry, 8).orderBy("ts").toPandas()
    assert np.allclose(got["model_oil_c"], exp["oil"], atol=1e-5) and np.allclose(got["model_winding_c"], exp["winding"], atol=1e-5)


def test_lag_without_rows(spark, layers):
    assert thermal.thermal_lag(layers.measurements.limit(0), layers.registry).count() == 0
