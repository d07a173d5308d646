"""Analytical queries over the silver/gold tables.

Star-schema drill-downs aggregate the fact to one row per unit *before*
joining the dimensions (sums, counts and extrema are decomposable), so the
join sees #units rows instead of #measurements rows and a hot unit is
reduced map-side.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.measures import READING_SCALE, exact_avg, round_half_even, round_half_up, scaled_sum
from .quantiles import exact_quantiles
from .registry import clamp_page


def _per_unit(fact: DataFrame, key: str = "transformer_key", **aggs) -> DataFrame:
    return fact.groupBy(key).agg(*[v.alias(k) for k, v in aggs.items()])


def _avg_from_parts(sum_col: str, n_col: str, scale: int, digits: int):
    return round_half_up(F.col(sum_col).cast("double") / float(10 ** scale) / F.col(n_col).cast("double"), digits)


def region_tsi(fact: DataFrame, dim_transformer: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Average stress index and peak winding per (region, application), best first."""
    unit = _per_unit(fact, tsi_sum=scaled_sum("thermal_stress_index", 3),
                     tsi_n=F.count("thermal_stress_index"), n=F.count(F.lit(1)),
                     max_w=F.max("winding_temperature_c"))
    dt = dim_transformer.select("transformer_key", "application")
    dl = dim_location.select("location_key", "region")
    j = unit.join(dt, "transformer_key").join(dl, unit.transformer_key == dl.location_key)
    g = j.groupBy("region", "application").agg(
        F.sum(F.col("tsi_sum").cast("decimal(38,0)")).alias("s"), F.sum("tsi_n").alias("c"),
        F.max("max_w").alias("max_winding_c"), F.sum("n").alias("n_measurements"))
    return g.select("region", "application", _avg_from_parts("s", "c", 3, 4).alias("avg_tsi"),
                    "max_winding_c", "n_measurements").orderBy(F.desc("avg_tsi"), "region", "application")


def region_oil(fact: DataFrame, dim_transformer: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Average oil temperature and row count per (region, application)."""
    unit = _per_unit(fact, oil_sum=scaled_sum("oil_temperature_c", READING_SCALE), oil_n=F.count("oil_temperature_c"),
                     n=F.count(F.lit(1)))
    dt = dim_transformer.select("transformer_key", "application")
    dl = dim_location.select("location_key", "region")
    j = unit.join(dt, "transformer_key").join(dl, unit.transformer_key == dl.location_key)
    g = j.groupBy("region", "application").agg(F.sum(F.col("oil_sum").cast("decimal(38,0)")).alias("s"), F.sum("oil_n").alias("c"),
                                                F.sum("n").alias("n"))
    return g.select("region", "application", _avg_from_parts("s", "c", READING_SCALE, 2).alias("avg_oil_temp_c"), "n") \
            .orderBy("region", "application")


def unit_oil(fact: DataFrame, dim_transformer: DataFrame, top: int = 6) -> DataFrame:
    """Measurements and average oil per (unit, application), top by count."""
    unit = _per_unit(fact, oil_sum=scaled_sum("oil_temperature_c", READING_SCALE), oil_n=F.count("oil_temperature_c"),
                     n_measurements=F.count(F.lit(1)))
    dt = dim_transformer.select("transformer_key", "application")
    j = unit.join(dt, "transformer_key")
    out = j.select("transformer_key", "application", "n_measurements",
                   _avg_from_parts("oil_sum", "oil_n", READING_SCALE, 2).alias("avg_oil_temp_c"))
    return out.orderBy(F.desc("n_measurements"), "transformer_key").limit(top)


def top_units(measurements: DataFrame, top: int = 5) -> DataFrame:
    """A3/L3: per unit count, first and last instant; the ``top`` busiest units."""
    g = measurements.groupBy("transformer_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return g.orderBy(F.desc("n"), "transformer_id").limit(top)


def state_tsi(int_tel: DataFrame, top: int = 5) -> DataFrame:
    """A4/L3: rows and average stress index per (unit, recomputed state), top by count."""
    g = int_tel.groupBy("transformer_id", "state_recomputed").agg(
        F.count(F.lit(1)).alias("n"), scaled_sum("thermal_stress_index", 3).alias("s"),
        F.count("thermal_stress_index").alias("c"))
    out = g.select("transformer_id", "state_recomputed", "n", _avg_from_parts("s", "c", 3, 4).alias("avg_tsi"))
    return out.orderBy(F.desc("n"), "transformer_id", "state_recomputed").limit(top)


def weekday_peak(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Peak load per weekday through the time dimension.

    The fact is first reduced to one row per instant (max load), so the
    join with the time dimension — which grows with the data and is not
    broadcast — shuffles #instants rows, not #measurements.
    """
    per_instant = fact.groupBy("time_key").agg(F.max("load_percent").alias("peak"))
    j = per_instant.join(dim_time.select("time_key", "weekday"), "time_key")
    return j.groupBy("weekday").agg(F.max("peak").alias("peak_load")).orderBy(F.desc("peak_load"), "weekday")


def unit_statistics(measurements: DataFrame, fact: DataFrame, registry: DataFrame) -> DataFrame:
    """Per registered unit — count, load min/max/avg, oil max, winding max/avg, avg TSI.

    Units without measurements get zeros (the reference's COALESCE(...,0)).
    """
    m = measurements.groupBy("transformer_id").agg(
        F.count(F.lit(1)).alias("count"),
        F.min("load_percent").alias("min_load_percent"), F.max("load_percent").alias("max_load_percent"),
        exact_avg("load_percent", READING_SCALE).alias("avg_load_percent"),
        F.max("oil_temperature_c").alias("max_oil_temperature_c"),
        F.max("winding_temperature_c").alias("max_winding_temperature_c"),
        exact_avg("winding_temperature_c", READING_SCALE).alias("avg_winding_temperature_c"))
    t = fact.groupBy(F.col("transformer_key").alias("transformer_id")).agg(
        exact_avg("thermal_stress_index", 3).alias("avg_thermal_stress_index"))
    out = registry.select("transformer_id").join(m, "transformer_id", "left").join(t, "transformer_id", "left")
    zero = {c: 0.0 for c in ("min_load_percent", "max_load_percent", "avg_load_percent", "max_oil_temperature_c",
                             "max_winding_temperature_c", "avg_winding_temperature_c", "avg_thermal_stress_index")}
    zero["count"] = 0
    return out.fillna(zero)


def telemetry_window(measurements: DataFrame, unit: str, start=None, end=None) -> DataFrame:
    """One unit's rows, optional inclusive bounds (an absent bound is not applied)."""
    cond = F.col("transformer_id") == F.lit(unit)
    if start is not None:
        cond = cond & (F.col("ts") >= F.lit(start).cast("timestamp"))
    if end is not None:
        cond = cond & (F.col("ts") <= F.lit(end).cast("timestamp"))
    return measurements.filter(cond)


def newest_first_page(df: DataFrame, limit=None, offset: int = 0, ts: str = "ts",
                      tie: tuple = ()) -> DataFrame:
    """Newest first with a full tie-breaker, clamped page."""
    n = clamp_page(limit)
    ordered = df.orderBy(F.desc(ts), *[F.col(c) for c in tie])
    return ordered.offset(offset).limit(n) if offset > 0 else ordered.limit(n)


def earliest_sample(measurements: DataFrame, n: int = 200) -> DataFrame:
    """The earliest ``n`` rows as the 5-column telemetry feature matrix (missing -> 0)."""
    feats = [F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in P.TELEMETRY_FEATURES]
    return measurements.orderBy("ts", "transformer_id").limit(n).select(
        "transformer_id", F.col("ts").alias("timestamp"), *feats)


def power_range(registry: DataFrame) -> DataFrame:
    """Fleet rated-power range."""
    return registry.agg(F.min("rated_power_mva").alias("min_power_mva"),
                        F.max("rated_power_mva").alias("max_power_mva"), F.count(F.lit(1)).alias("units"))


def power_describe(registry: DataFrame) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear), max of power per application, 1 dp, half-even."""
    power = F.col("rated_power_mva").cast(f"decimal(18,{READING_SCALE})")
    base = registry.groupBy("application").agg(
        F.count("rated_power_mva").alias("count"),
        exact_avg("rated_power_mva", READING_SCALE).alias("mean"),
        F.sum(power).cast("double").alias("_s1"), F.sum(power * power).cast("double").alias("_s2"),
        F.min("rated_power_mva").alias("min"), F.max("rated_power_mva").alias("max"))
    n = F.col("count").cast("double")
    var = (F.col("_s2") - F.col("_s1") * F.col("_s1") / n) / (n - F.lit(1.0))
    std = F.when(F.col("count") > 1, F.sqrt(F.greatest(var, F.lit(0.0))))
    qs = exact_quantiles(registry, ["application"], "rated_power_mva", [0.25, 0.5, 0.75])
    piv = qs.groupBy("application").agg(
        *[F.max(F.when(F.col("q") == q, F.col("quantile"))).alias(name)
          for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    out = base.join(piv, "application", "left")
    r = lambda c: round_half_even(c, 1)
    return out.select("application", "count", r(F.col("mean")).alias("mean"), r(std).alias("std"),
                      r(F.col("min")).alias("min"), r(F.col("p25")).alias("p25"), r(F.col("p50")).alias("p50"),
                      r(F.col("p75")).alias("p75"), r(F.col("max")).alias("max")).orderBy("application")


def cooling_crosstab(registry: DataFrame) -> DataFrame:
    """Application x cooling class counts, missing combinations = 0."""
    return (registry.groupBy("application").pivot("cooling_type", list(P.COOLING_TYPES))
            .agg(F.count(F.lit(1))).fillna(0, subset=list(P.COOLING_TYPES)).orderBy("application"))


HIST_FEATURES = ("rated_power_mva", "hv_voltage_kv", "commissioning_year")


def histogram(registry: DataFrame, features=HIST_FEATURES, bins: int = 10) -> DataFrame:
    """Equal-width histogram per feature; the maximum falls in the last bin."""
    stack = "stack({n}, {items}) as (feature, x)".format(
        n=len(features), items=", ".join(f"'{f}', cast({f} as double)" for f in features))
    long = registry.selectExpr(stack).filter(F.col("x").isNotNull())
    rng = long.groupBy("feature").agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
    j = long.join(F.broadcast(rng), "feature")  # one row per feature: bounded
    width = F.col("mx") - F.col("mn")
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col("x") - F.col("mn")) * bins / width).cast("int") + 1, F.lit(bins)))
    g = j.groupBy("feature", b.alias("bin"), "mn", "mx").agg(F.count(F.lit(1)).alias("n"))
    lo = F.col("mn") + (F.col("bin") - 1) * (F.col("mx") - F.col("mn")) / F.lit(float(bins))
    hi = F.col("mn") + F.col("bin") * (F.col("mx") - F.col("mn")) / F.lit(float(bins))
    return g.select("feature", "bin", round_half_up(lo, 4).alias("bin_lo"), round_half_up(hi, 4).alias("bin_hi"),
                    "n").orderBy("feature", "bin")


def feature_moments(df: DataFrame, features, scale: int = READING_SCALE) -> DataFrame:
    """Per feature (missing -> 0): n, exact sum and sum of squares."""
    m = 10 ** scale
    stack = "stack({n}, {items}) as (feature, x)".format(
        n=len(features), items=", ".join(f"'{f}', coalesce(cast({f} as double), 0D)" for f in features))
    long = df.selectExpr(stack)
    xs = F.round(F.col("x") * float(m)).cast("decimal(38,0)")
    return long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.sum(xs).alias("s1"), F.sum(xs * xs).alias("s2"))


def scaler_from_moments(moments: DataFrame, scale: int = READING_SCALE) -> DataFrame:
    """Mean and population std from exact moments; std 0 -> 1."""
    m = float(10 ** scale)
    n = F.col("n").cast("double")
    s1 = F.col("s1").cast("double") / m
    s2 = F.col("s2").cast("double") / (m * m)
    mean = s1 / n
    var = F.greatest((s2 - s1 * s1 / n) / n, F.lit(0.0))
    std = F.sqrt(var)
    return moments.select("feature", mean.alias("mean"), F.when(std == 0, F.lit(1.0)).otherwise(std).alias("std"))


def feature_scaler(registry: DataFrame) -> DataFrame:
    """Standard-scaler parameters of the design features, 6 dp."""
    sc = scaler_from_moments(feature_moments(registry, P.DESIGN_FEATURES))
    return sc.select("feature", round_half_up("mean", 6).alias("mean"), round_half_up("std", 6).alias("std"))


def layer_counts(raw: DataFrame, measurements: DataFrame, stg: DataFrame, minimum: int = 15) -> DataFrame:
    """Row count per layer and whether it meets the end-to-end minimum."""
    parts = [raw.agg(F.count(F.lit(1)).alias("n")).select(F.lit("raw_telemetry").alias("layer"), "n"),
             measurements.agg(F.count(F.lit(1)).alias("n")).select(F.lit("measurements").alias("layer"), "n"),
             stg.agg(F.count(F.lit(1)).alias("n")).select(F.lit("stg_telemetry").alias("layer"), "n")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.withColumn("meets_minimum", F.col("n") >= minimum)


def sensor_envelope(fact: DataFrame, dim_sensor: DataFrame) -> DataFrame:
    """G4 + fact: observed min/max per catalogued sensor and rows outside its limits."""
    pairs = [("load", "load_percent"), ("ambient", "ambient_temperature_c"),
             ("oil_temperature", "oil_temperature_c"), ("winding_temperature", "winding_temperature_c"),
             ("oil_level", "oil_level_percent"), ("current", "current_a"), ("voltage", "voltage_kv")]
    stack = "stack({n}, {items}) as (sensor_name, x)".format(
        n=len(pairs), items=", ".join(f"'{s}', {c}" for s, c in pairs))
    long = fact.selectExpr(stack)
    j = long.join(F.broadcast(dim_sensor), "sensor_name")  # static 7-row catalog
    out_of = ((F.col("min_limit").isNotNull() & (F.col("x") < F.col("min_limit")))
              | (F.col("max_limit").isNotNull() & (F.col("x") > F.col("max_limit"))))
    return j.groupBy("sensor_name", "sensor_type", "unit", "min_limit", "max_limit").agg(
        F.min("x").alias("observed_min"), F.max("x").alias("observed_max"),
        F.count_if(out_of).alias("out_of_limits"), F.count("x").alias("n")).orderBy("sensor_name")
