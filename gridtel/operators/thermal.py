"""Physics virtual sensors over telemetry joined with the design registry.

M4/M5 steady top-oil and winding, M7 cooling rises, M8 loss ratio, M9 HV
current, M10 loaded voltage, M11 residuals per unit, M12 state
transitions, M6 first-order thermal lag.

Skew: transitions (M12) and the lag model (M6) are ordered per unit.  A
unit may hold a third of all rows, so neither runs as one window or one
pandas group per unit.  Transitions cut rows into (unit, time bucket) pieces;
the lag model (``lag``) into pieces of about equal row count.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import (cooling_rise, exact_avg, hv_current, loaded_voltage, loss_ratio,
                                  round_half_up, top_oil_steady, winding_steady)
from .lag import thermal_lag  # noqa: F401 - M6 is one of the virtual sensors

DESIGN_COLS = ("transformer_id", "rated_power_mva", "hv_voltage_kv", "cooling_type",
               "no_load_loss_kw", "load_loss_kw")


def with_design(measurements: DataFrame, registry: DataFrame) -> DataFrame:
    """Measurements joined to the design parameters the physics needs (M7, M8)."""
    reg = registry.select(*DESIGN_COLS)
    rise, grad = cooling_rise("cooling_type")
    reg = reg.select("transformer_id", "rated_power_mva", "hv_voltage_kv",
                     loss_ratio().alias("loss_ratio"), rise.alias("oil_rise_c"), grad.alias("winding_grad_c"))
    return measurements.join(reg, "transformer_id")


def expected_temperatures(measurements: DataFrame, registry: DataFrame) -> DataFrame:
    """M4/M5/M7/M8: steady-state top-oil and hot-spot per row, 2 dp."""
    j = with_design(measurements, registry)
    k = F.col("load_percent") / 100.0
    oil = top_oil_steady("ambient_temperature_c", k, "loss_ratio", "oil_rise_c")
    wind = winding_steady("oil_temperature_c", k, "winding_grad_c")
    return j.select("transformer_id", "ts", round_half_up(oil, 2).alias("expected_oil_c"),
                    round_half_up(wind, 2).alias("expected_winding_c"))


def electrical(measurements: DataFrame, registry: DataFrame) -> DataFrame:
    """Expected HV current and loaded voltage per row, 2 dp."""
    j = with_design(measurements, registry)
    cur = hv_current("load_percent", "rated_power_mva", "hv_voltage_kv")
    volt = loaded_voltage("hv_voltage_kv", "load_percent")
    return j.select("transformer_id", "ts", round_half_up(cur, 2).alias("expected_current_a"),
                    round_half_up(volt, 2).alias("expected_voltage_kv"))


def sensor_residuals(measurements: DataFrame, registry: DataFrame) -> DataFrame:
    """Per unit mean of measured - expected (oil, winding, current, voltage), 3 dp.

    Row residuals are rounded to 3 dp and averaged as exact fixed-point sums,
    so the result does not depend on partitioning.
    """
    j = with_design(measurements, registry)
    k = F.col("load_percent") / 100.0
    res = j.select(
        "transformer_id",
        round_half_up(F.col("oil_temperature_c") - top_oil_steady("ambient_temperature_c", k, "loss_ratio",
                                                                  "oil_rise_c"), 3).alias("r_oil"),
        round_half_up(F.col("winding_temperature_c") - winding_steady("oil_temperature_c", k, "winding_grad_c"),
                      3).alias("r_winding"),
        round_half_up(F.col("current_a") - hv_current("load_percent", "rated_power_mva", "hv_voltage_kv"),
                      3).alias("r_current"),
        round_half_up(F.col("voltage_kv") - loaded_voltage("hv_voltage_kv", "load_percent"), 3).alias("r_voltage"))
    g = res.groupBy("transformer_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[exact_avg(c, 3).alias("mean_" + c[2:] + "_residual") for c in ("r_oil", "r_winding", "r_current", "r_voltage")])
    return g.select("transformer_id", "n", *[round_half_up(c, 3).alias(c) for c in g.columns[2:]])


# --- M12 state transitions ---------------------------------------------------------------------

def state_transitions(df: DataFrame, key: str = "transformer_id", ts: str = "ts", value: str = "state",
                      bucket: str = "day") -> DataFrame:
    """Rows where ``value`` differs from the unit's previous reading.

    ``lag`` runs inside (unit, bucket) pieces; each piece's first row takes
    the last value of the unit's previous non-empty bucket, found with a
    window over the per-bucket summaries (one row per bucket).
    Output: key, ts, previous value, value, severity (NORMAL -> INFO).
    """
    b = F.date_trunc(bucket, F.col(ts))
    x = df.select(key, ts, value).withColumn("_b", b)
    w_in = Window.partitionBy(key, "_b").orderBy(ts, value)
    x = x.withColumn("_prev", F.lag(value).over(w_in)).withColumn("_rn", F.row_number().over(w_in))
    last = x.groupBy(key, "_b").agg(F.max_by(F.col(value), F.struct(ts, value)).alias("_last"))
    w_b = Window.partitionBy(key).orderBy("_b")
    carry = last.withColumn("_carry", F.lag("_last").over(w_b)).select(key, "_b", "_carry")
    x = x.join(carry, [key, "_b"], "left")
    prev = F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_prev"))
    out = x.select(key, ts, prev.alias("previous_state"), F.col(value).alias("state"))
    out = out.filter(F.col("previous_state").isNotNull() & (F.col("previous_state") != F.col("state")))
    sev = F.when(F.col("state") == "NORMAL", F.lit("INFO")).otherwise(F.col("state"))
    return out.select(key, ts, "previous_state", "state", sev.alias("severity"))
