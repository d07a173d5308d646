"""Column functions: rounding, thermal stress, state, margins, physics.

All are built-in expressions (JVM side, inside whole-stage codegen).
Arithmetic stays in DOUBLE with a fixed operation order; rounding goes
through DECIMAL so half-way cases round away from zero deterministically.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Decimals kept in exact sums of readings and design values: stored columns declare two, two more are carried.
READING_SCALE = 4


def round_half_up(x, n: int) -> Column:
    """round(x, n) half away from zero on the decimal value, as DOUBLE."""
    return F.round(_c(x).cast("decimal(28,9)"), n).cast("double")


def round_half_even(x, n: int) -> Column:
    """Banker's rounding (Python ``round``) on the decimal value, as DOUBLE."""
    return F.bround(_c(x).cast("decimal(28,9)"), n).cast("double")


def scaled_sum(x, scale: int = 3) -> Column:
    """Exact sum of a column with at most ``scale`` decimals.

    Summed as a LONG of fixed-point units, so the result does not depend on
    row order or partitioning (a DOUBLE sum would) and stays on the fast
    64-bit aggregation path.
    """
    return F.sum(F.round(_c(x) * float(10 ** scale)).cast("long"))


def exact_avg(x, scale: int = 3) -> Column:
    """Order-independent average of a column with at most ``scale`` decimals."""
    n = F.nullif(F.count(_c(x)), F.lit(0)).cast("double")
    return scaled_sum(x, scale).cast("double") / float(10 ** scale) / n


def thermal_stress_index(winding="winding_temperature_c", oil="oil_temperature_c",
                         load="load_percent") -> Column:
    """Weighted blend of winding/oil/load against their critical limits, capped at 1, 3 dp."""
    raw = (F.lit(P.TSI_WEIGHT_WINDING) * F.greatest(_c(winding), F.lit(0.0)) / F.lit(P.CRITICAL_WINDING_C)
           + F.lit(P.TSI_WEIGHT_OIL) * F.greatest(_c(oil), F.lit(0.0)) / F.lit(P.CRITICAL_OIL_C)
           + F.lit(P.TSI_WEIGHT_LOAD) * F.greatest(_c(load), F.lit(0.0)) / F.lit(P.CRITICAL_LOAD_PERCENT))
    return round_half_up(F.least(F.lit(1.0), raw), 3)


def classify_state(winding="winding_temperature_c", oil="oil_temperature_c",
                   load="load_percent") -> Column:
    """CRITICAL / WARNING / NORMAL from the physical thresholds (NULLs -> NORMAL)."""
    w, o, l = _c(winding), _c(oil), _c(load)
    return (F.when((w >= P.CRITICAL_WINDING_C) | (o >= P.CRITICAL_OIL_C) | (l >= P.CRITICAL_LOAD_PERCENT),
                   F.lit("CRITICAL"))
            .when((w >= P.WARNING_WINDING_C) | (o >= P.WARNING_OIL_C) | (l > P.OVERLOAD_PERCENT),
                  F.lit("WARNING"))
            .otherwise(F.lit("NORMAL")))


def winding_margin(winding="winding_temperature_c") -> Column:
    return round_half_up(F.lit(P.CRITICAL_WINDING_C) - _c(winding), 2)


def oil_margin(oil="oil_temperature_c") -> Column:
    return round_half_up(F.lit(P.CRITICAL_OIL_C) - _c(oil), 2)


# --- physics (virtual sensors) ---------------------------------------------

def cooling_rise(cooling="cooling_type") -> tuple[Column, Column]:
    """(rated top-oil rise, winding gradient) for a cooling class."""
    c = _c(cooling)
    rise = F.lit(P.DEFAULT_COOLING_RISE[0])
    grad = F.lit(P.DEFAULT_COOLING_RISE[1])
    for name in reversed(list(P.COOLING_RISE)):
        r, g = P.COOLING_RISE[name]
        rise = F.when(c == name, F.lit(r)).otherwise(rise)
        grad = F.when(c == name, F.lit(g)).otherwise(grad)
    return rise, grad


def loss_ratio(no_load="no_load_loss_kw", load_loss="load_loss_kw") -> Column:
    return F.when(_c(no_load) <= 0, F.lit(P.DEFAULT_LOSS_RATIO)).otherwise(_c(load_loss) / _c(no_load))


def top_oil_steady(ambient, k, ratio, rise) -> Column:
    """ambient + rise * ((1 + R K^2) / (1 + R))^0.8; K <= 0 -> ambient."""
    a, k, r, s = _c(ambient), _c(k), _c(ratio), _c(rise)
    return F.when(k <= 0, a).otherwise(a + s * F.pow((F.lit(1.0) + r * k * k) / (F.lit(1.0) + r), F.lit(0.8)))


def winding_steady(oil, k, grad) -> Column:
    """oil + grad * K^1.6; K <= 0 -> oil."""
    o, k, g = _c(oil), _c(k), _c(grad)
    return F.when(k <= 0, o).otherwise(o + g * F.pow(k, F.lit(1.6)))


def hv_current(load_percent, rated_power_mva, voltage_kv) -> Column:
    """I = S * load / (sqrt(3) * V); V <= 0 -> 0."""
    va = _c(rated_power_mva) * F.lit(1e6) * _c(load_percent) / F.lit(100.0)
    base = F.sqrt(F.lit(3.0)) * _c(voltage_kv) * F.lit(1e3)
    return F.when(base <= 0, F.lit(0.0)).otherwise(va / base)


def loaded_voltage(nominal_kv, load_percent) -> Column:
    """V * (1 - 0.02 * load / 100); load <= 0 -> nominal."""
    droop = F.when(_c(load_percent) > 0,
                   F.lit(P.VOLTAGE_DROOP_AT_FULL_LOAD) * _c(load_percent) / F.lit(100.0)).otherwise(F.lit(0.0))
    return _c(nominal_kv) * (F.lit(1.0) - droop)
