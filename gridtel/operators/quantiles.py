"""Exact linear-interpolated quantiles without gathering a group in one task.

``percentile`` keeps every value of a group in one aggregation buffer and a
window over the group sorts it in one task.  Here every wanted rank is
narrowed down by counting:

1. a rank starts with the open interval of all values of its group;
2. a bounded sketch (``percentile_approx`` on a fixed grid of shares) of the
   values inside the interval gives two of them, a <= b, around the rank;
3. one exact count of the values below a, equal to a, between, equal to b
   and above b tells which of these five holds the rank: a or b is the
   answer, or the interval shrinks to one of the three open parts — by about
   ``GRID`` times, as ties can only sit on a or b;
4. until every interval holds at most ``small`` values: those are sorted in
   one array, shared by all ranks of the interval, and give the answers (one
   scan in all for groups that small; one round before it for 10^8 rows, two
   for 2 x 10^11).

Every aggregate combines before the shuffle and yields one row per rank or
at most ``small`` values, so a group with most of the rows is no heavier
than others.  The values at
ranks floor(h) and ceil(h), h = (n - 1) q, are interpolated: lo + (hi - lo)
(h - floor(h)) — the definition of Spark's ``percentile`` and DuckDB's
``quantile_cont``.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

GRID = 2000
ACCURACY = 20_000
SMALL = 50_000  # values of one interval that one array may hold: 400 KB


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str, qs: Sequence[float],
                    grid: int = GRID, accuracy: int = ACCURACY, small: int = SMALL) -> DataFrame:
    """Rows ``(*groups, q, quantile)`` for each group and each q in ``qs``."""
    keys = list(groups)
    x = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if not keys:
        # one group: a key that the optimizer cannot fold, so joins stay equi-joins
        x = x.withColumn("_all", F.pmod(F.xxhash64("_v"), F.lit(1)))
        keys = ["_all"]
    sizes = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    wanted = F.explode(F.array(*[F.lit(float(q)) for q in qs]))
    of_q = sizes.select(*keys, "n", wanted.alias("q")).withColumn("h", (F.col("n") - 1).cast("double") * F.col("q"))
    of_q = cut_lineage(of_q.select(*keys, "q", "h", "n", F.floor("h").alias("r_lo"), F.ceil("h").alias("r_hi")))
    ranks = of_q.select(*keys, "n", F.explode(F.array("r_lo", "r_hi")).alias("r")).distinct()
    state = ranks.select(*keys, "r", F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"),
                         F.lit(0).cast("long").alias("base"), F.col("n").alias("m"), F.lit(None).cast("double").alias("v"))
    widest = state.filter(F.col("v").isNull()).agg(F.max("m"))
    while (widest.first()[0] or 0) > small:
        state = cut_lineage(_narrowed(x, state, keys, grid, accuracy, small))
        widest = state.filter(F.col("v").isNull()).agg(F.max("m"))
    state = cut_lineage(_picked(x, state, keys))
    at = lambda name: state.select(*keys, F.col("r").alias(f"r_{name}"), F.col("v").alias(f"v_{name}"))
    out = of_q.join(at("lo"), [*keys, "r_lo"]).join(at("hi"), [*keys, "r_hi"])
    quantile = F.when(F.col("v_lo") == F.col("v_hi"), F.col("v_lo")).otherwise(
        F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * (F.col("h") - F.floor("h")))
    return out.select(*groups, "q", quantile.alias("quantile"))


def _inside() -> Column:
    """An end that never moved takes infinite values in."""
    return (((F.col("_v") > F.col("lo")) | (F.col("lo") == float("-inf")))
            & ((F.col("_v") < F.col("hi")) | (F.col("hi") == float("inf"))))


def _picked(x: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Every open rank gets its value from the sorted values of its interval."""
    bounds = [*keys, "lo", "hi", "base"]
    spans = state.filter(F.col("v").isNull()).groupBy(*bounds).agg(F.collect_list("r").alias("ranks"))
    values = x.join(spans.drop("ranks"), keys).filter(_inside()).groupBy(*bounds) \
        .agg(F.sort_array(F.collect_list("_v")).alias("s"))
    found = spans.join(values, bounds).select(*bounds, "s", F.explode("ranks").alias("r")).select(
        *keys, "r", F.element_at("s", (F.col("r") - F.col("base") + 1).cast("int")).alias("v"))
    return state.filter(F.col("v").isNotNull()).select(*keys, "r", "v").unionByName(found)


def _narrowed(x: DataFrame, state: DataFrame, keys: list[str], grid: int, accuracy: int, small: int) -> DataFrame:
    """One round: every open rank with a wide interval gets its value or a smaller interval."""
    wide = F.col("v").isNull() & (F.col("m") > small)
    known = state.filter(~wide)
    todo = state.filter(wide).select(*keys, "r", "lo", "hi", "base", "m")
    inside = _inside()
    held = x.join(todo, keys).filter(inside)
    id_cols = [*keys, "r"]
    share = [i / grid for i in range(grid + 1)]
    sketch = held.groupBy(*id_cols).agg(F.percentile_approx("_v", share, accuracy).alias("s"),
                                        F.first("base").alias("base"), F.first("m").alias("m"),
                                        F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    want = (F.col("r") - F.col("base") + F.lit(0.5)) / F.col("m") * F.lit(grid)
    # the grid points around the rank, one further for the sketch's error unless the sketch is exact
    slack = F.when(F.col("m") <= accuracy, F.lit(0)).otherwise(F.lit(1))
    low = F.greatest(F.floor(want) - slack, F.lit(0)).cast("int") + 1
    high = F.least(F.ceil(want) + slack, F.lit(grid)).cast("int") + 1
    bracket = cut_lineage(sketch.select(*id_cols, "base", "m", "lo", "hi", F.element_at("s", low).alias("a"),
                                        F.element_at("s", high).alias("b")))
    v, a, b = F.col("_v"), F.col("a"), F.col("b")
    counts = x.join(bracket.select(*id_cols, "a", "b", "lo", "hi"), keys).filter(inside).groupBy(*id_cols).agg(
        F.count_if(v < a).alias("below"), F.count_if(v == a).alias("on_a"),
        F.count_if((v > a) & (v < b)).alias("between"), F.count_if((v == b) & (a < b)).alias("on_b"))
    t = bracket.join(counts, id_cols)
    k = F.col("r") - F.col("base")
    c1 = F.col("below")
    c2 = c1 + F.col("on_a")
    c3 = c2 + F.col("between")
    c4 = c3 + F.col("on_b")

    def pick(left, on_a, mid, on_b, right):
        return F.when(k < c1, left).when(k < c2, on_a).when(k < c3, mid).when(k < c4, on_b).otherwise(right)

    none = F.lit(None).cast("double")
    moved = t.select(*id_cols, pick(F.col("lo"), a, a, b, b).alias("lo"), pick(a, a, b, b, F.col("hi")).alias("hi"),
                     pick(F.col("base"), F.col("base"), F.col("base") + c2, F.col("base"), F.col("base") + c4).alias("base"),
                     pick(c1, F.lit(0), F.col("between"), F.lit(0), F.col("m") - c4).cast("long").alias("m"),
                     pick(none, a, none, b, none).alias("v"))
    return known.select(*state.columns).unionByName(moved.select(*state.columns))
