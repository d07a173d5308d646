"""Column functions against the reference's unit-test values."""
import math

import pytest
from pyspark.sql import functions as F

from gridtel.functions import measures as M


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize("w,o,l,expected", [
    (60, 55, 70, "NORMAL"), (100, 80, 90, "WARNING"), (85, 80, 110, "WARNING"),
    (85, 95, 90, "WARNING"), (110, 80, 90, "CRITICAL"), (85, 80, 150, "CRITICAL"),
    (93, 60, 100, "NORMAL"), (96, 60, 100, "WARNING"), (106, 60, 100, "CRITICAL"),
])
def test_classify_state(spark, w, o, l, expected):
    assert one(spark, M.classify_state(F.lit(float(w)), F.lit(float(o)), F.lit(float(l)))) == expected


def test_classify_all_null_is_normal(spark):
    n = F.lit(None).cast("double")
    assert one(spark, M.classify_state(n, n, n)) == "NORMAL"


def test_tsi(spark):
    # 0.5*74.2/105 + 0.3*61.8/100 + 0.2*72.4/140 = 0.6420...
    v = one(spark, M.thermal_stress_index(F.lit(74.2), F.lit(61.8), F.lit(72.4)))
    assert v == round(0.5 * 74.2 / 105 + 0.3 * 61.8 / 100 + 0.2 * 72.4 / 140, 3)
    assert one(spark, M.thermal_stress_index(F.lit(300.0), F.lit(300.0), F.lit(300.0))) == 1.0
    assert one(spark, M.thermal_stress_index(F.lit(-5.0), F.lit(-5.0), F.lit(-5.0))) == 0.0


def test_round_half_up_through_decimal(spark):
    assert one(spark, M.round_half_up(F.lit(1.005), 2)) == 1.01
    assert one(spark, M.round_half_even(F.lit(0.12345), 4)) == 0.1234


def test_physics_values(spark):
    assert one(spark, M.top_oil_steady(F.lit(25.0), F.lit(0.0), F.lit(8.0), F.lit(52.0))) == 25.0
    assert one(spark, M.top_oil_steady(F.lit(25.0), F.lit(1.0), F.lit(8.0), F.lit(52.0))) == pytest.approx(77.0)
    assert one(spark, M.winding_steady(F.lit(70.0), F.lit(1.0), F.lit(18.0))) == pytest.approx(88.0)
    assert one(spark, M.hv_current(F.lit(100.0), F.lit(40.0), F.lit(230.0))) == pytest.approx(100.4, abs=0.5)
    assert one(spark, M.hv_current(F.lit(0.0), F.lit(40.0), F.lit(230.0))) == 0.0
    assert one(spark, M.loaded_voltage(F.lit(230.0), F.lit(0.0))) == 230.0
    v = one(spark, M.loaded_voltage(F.lit(230.0), F.lit(100.0)))
    assert 220 < v < 230


def test_cooling_and_loss_ratio(spark):
    rise, grad = M.cooling_rise(F.lit("ONAF"))
    assert one(spark, rise) == 52.0 and one(spark, grad) == 18.0
    rise, grad = M.cooling_rise(F.lit("ONAN"))
    assert one(spark, rise) == 48.0 and one(spark, grad) == 20.0
    assert one(spark, M.loss_ratio(F.lit(0.0), F.lit(100.0))) == 8.0
    assert one(spark, M.loss_ratio(F.lit(10.0), F.lit(100.0))) == 10.0


def test_exact_avg_is_order_free(spark):
    df = spark.createDataFrame([(float(x) / 10,) for x in range(1, 1001)], "x double").repartition(7)
    v = df.agg(M.exact_avg("x", 1).alias("a")).first()["a"]
    assert math.isclose(v, 50.05, rel_tol=0, abs_tol=1e-12)
