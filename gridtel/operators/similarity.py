"""Design similarity: standard-scaled Euclidean distance, score 1 / (1 + d).

K1 feature projection (missing -> 0), K2 scaler fitted on the candidate set
(population std, 0 -> 1), K3 distance and score (4 dp, half-even), K4
top-k for one target with the target excluded (P12), ties in candidate
order (id ascending).

The scaler comes from exact moments (sum and sum of squares as DECIMAL of
fixed-point units), so it does not depend on partitioning.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.measures import READING_SCALE, round_half_even


def design_features(registry: DataFrame, features: Sequence[str] = P.DESIGN_FEATURES) -> DataFrame:
    """K1: id + the ordered design features as DOUBLE, missing -> 0."""
    return registry.select("transformer_id",
                           *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])


def fixed(c: str, scale: int) -> Column:
    """A column as an exact whole number of ``10 ** -scale`` units."""
    return F.round(F.col(c) * float(10 ** scale)).cast("decimal(38,0)")


def wide_moments(feats: DataFrame, features: Sequence[str], scale: int = READING_SCALE) -> DataFrame:
    """One row: n and exact s1/s2 per feature."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for f in features:
        x = fixed(f, scale)
        aggs += [F.sum(x).alias(f"s1_{f}"), F.sum(x * x).alias(f"s2_{f}")]
    return feats.agg(*aggs)


def mean_std(n: Column, s1: Column, s2: Column, scale: int = READING_SCALE) -> tuple[Column, Column]:
    """Mean and population std (0 -> 1) from fixed-point moments."""
    m = float(10 ** scale)
    nd = n.cast("double")
    s1m = s1.cast("double") / m
    s2m = s2.cast("double") / (m * m)
    mean = s1m / nd
    std = F.sqrt(F.greatest((s2m - s1m * s1m / nd) / nd, F.lit(0.0)))
    return mean, F.when(std == 0, F.lit(1.0)).otherwise(std)


def scaled_distance(t: dict[str, Column], c: dict[str, Column], mean: dict[str, Column],
                    std: dict[str, Column], features: Sequence[str]) -> Column:
    """Euclidean norm of scaled(target) - scaled(candidate), features in fixed order."""
    acc = None
    for f in features:
        d = (t[f] - mean[f]) / std[f] - (c[f] - mean[f]) / std[f]
        acc = d * d if acc is None else acc + d * d
    return F.sqrt(acc)


def score(distance: Column) -> Column:
    """1 / (1 + d), rounded half-even to 4 dp (Python ``round``)."""
    return round_half_even(F.lit(1.0) / (F.lit(1.0) + distance), 4)


def similar_one(registry: DataFrame, target_id: str, k: int | None = 5,
                features: Sequence[str] = P.DESIGN_FEATURES) -> DataFrame:
    """``(transformer_id, score)`` of the best ``k`` candidates (all when k <= 0 / None).

    The scaler is fitted on the candidates (target excluded).  Target and
    scaler form a one-row parameter frame, joined to every candidate on a
    constant key as a broadcast: a single row, so its size is bounded.
    """
    feats = design_features(registry, features)
    target = feats.filter(F.col("transformer_id") == target_id)
    cands = feats.filter(F.col("transformer_id") != target_id)
    mom = wide_moments(cands, features)
    params = _one_row_join(target.select(*[F.col(f).alias(f"t_{f}") for f in features]), mom)
    j = cands.withColumn("_k", F.lit(0)).join(F.broadcast(params.withColumn("_k", F.lit(0))), "_k")
    mean, std = {}, {}
    for f in features:
        mean[f], std[f] = mean_std(F.col("n"), F.col(f"s1_{f}"), F.col(f"s2_{f}"))
    d = scaled_distance({f: F.col(f"t_{f}") for f in features}, {f: F.col(f) for f in features},
                        mean, std, features)
    out = j.select("transformer_id", score(d).alias("score"))
    ordered = out.orderBy(F.desc("score"), "transformer_id")
    return ordered.limit(k) if k and k > 0 else ordered


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Join two frames of at most one row each (constant key)."""
    return a.withColumn("_k1", F.lit(0)).join(b.withColumn("_k1", F.lit(0)), "_k1").drop("_k1")
