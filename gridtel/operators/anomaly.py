"""Isolation-Forest anomaly scoring over telemetry.

Fit: every tree draws its ``sample`` rows without replacement from *all* rows.  A row joins every tree with a chance that
leaves each tree about four times its sample; one hash per row skips straight to the first tree that it joins, and only
the rows that join one are looked at further.  Of those a tree keeps the ``sample`` rows with the smallest hash, by a limited
window that drops most of them before the shuffle, so no task ever holds more than ``sample`` rows of a tree and its
window.  A tree grows from its kept rows, packed into one array (random feature, uniform split between the
node's min and max, height limit ceil(log2 sample)).  The node table (at most
trees x (2 x sample - 1) rows) is the only data brought to the driver; it
goes to the executors as a broadcast variable.

Score: all trees, as complete binary trees, are walked for a whole Arrow batch at once;
score = -2^(-E[h(x)] / c(sample)) in [-1, 0], higher = more normal.  The
anomaly threshold is the exact ``contamination`` quantile of all scores
(distributed, see ``quantiles``); a row is anomalous when its score is
below it.  Output keeps every input row.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions.measures import round_half_even
from ..session import stored
from .quantiles import exact_quantiles

EULER = 0.5772156649015329
NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, "
               "size long, depth int")


def c_factor(n) -> np.ndarray:
    """Average path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def feature_matrix(df: DataFrame, features=P.TELEMETRY_FEATURES) -> DataFrame:
    """K6: the unscaled telemetry features, missing -> 0."""
    return df.select("*", *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"_x{i}")
                            for i, f in enumerate(features)])


def _grow(tree: int, x: np.ndarray, seed: int, max_depth: int) -> list[tuple]:
    rng = np.random.default_rng([seed, tree])
    nodes: list[list] = []

    def build(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([tree, me, -1, 0.0, -1, -1, int(len(idx)), depth])
        if depth >= max_depth or len(idx) <= 1:
            return me
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            return me
        f = int(rng.choice(usable))
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] <= thr
        nodes[me][2], nodes[me][3] = f, thr
        left = build(idx[go_left], depth + 1)
        right = build(idx[~go_left], depth + 1)
        nodes[me][4], nodes[me][5] = left, right
        return me

    build(np.arange(len(x)), 0)
    return [tuple(n) for n in nodes]


def _uniform(h: Column) -> Column:
    """A hash as a number in [0, 1)."""
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(2 ** 53))


def tree_samples(rows: DataFrame, key: Column, cols: Sequence[str], n: int, trees: int, sample: int) -> DataFrame:
    """``tree, _h, *cols``: for every tree ``sample`` of the ``n`` rows (all when there are fewer), uniformly and independently.

    ``key`` is a row's hash; rows with equal keys are drawn together.
    """
    p = min(1.0, 4.0 * sample / max(n, 1))
    drawn = rows.select(key.alias("_own"), *cols)
    t_all = F.sequence(F.lit(0), F.lit(trees - 1))
    if p < 1.0:
        # the number of trees skipped before the first is geometric; later trees are drawn one by one
        skipped = F.floor(F.log1p(-_uniform(F.xxhash64("_own", F.lit(-1)))) / F.lit(math.log1p(-p)))
        drawn = drawn.withColumn("_first", skipped).filter(F.col("_first") < trees)
        t_all = F.filter(t_all, lambda t: (t == F.col("_first")) | (
            (t > F.col("_first")) & (_uniform(F.xxhash64(F.col("_own"), t)) < F.lit(p))))
    drawn = drawn.select("_own", *cols, F.explode(t_all).alias("tree"))
    drawn = drawn.select("tree", F.xxhash64("_own", "tree", F.lit(1)).alias("_h"), *cols)
    smallest = Window.partitionBy("tree").orderBy("_h", *cols)
    return drawn.withColumn("_r", F.row_number().over(smallest)).filter(F.col("_r") <= sample).drop("_r")


def fit(df: DataFrame, key_cols, features=P.TELEMETRY_FEATURES, trees: int = P.IFOREST_TREES,
        sample: int = P.IFOREST_SAMPLE, seed: int = P.IFOREST_SEED) -> tuple[pd.DataFrame, int]:
    """Grow the forest; returns (node table, effective sample size)."""
    x = feature_matrix(df, features)
    xcols = [f"_x{i}" for i in range(len(features))]
    own = F.xxhash64(*[F.col(c) for c in key_cols], F.lit(seed))
    drawn = tree_samples(x, own, xcols, x.count(), trees, sample)
    packed = drawn.groupBy("tree").agg(F.sort_array(F.collect_list(F.struct("_h", *xcols))).alias("s")).select(
        "tree", F.flatten(F.transform("s", lambda r: F.array(*[r[c] for c in xcols]))).alias("x"))
    names = [c.split()[0] for c in NODE_SCHEMA.split(", ")]

    def grow(it):
        for pdf in it:
            nodes = []
            for tree, flat in zip(pdf["tree"], pdf["x"]):
                xs = np.asarray(flat, dtype=float).reshape(-1, len(xcols))
                nodes += _grow(int(tree), xs, seed, int(math.ceil(math.log2(max(len(xs), 2)))))
            yield pd.DataFrame(nodes, columns=names)

    nodes = packed.mapInPandas(grow, NODE_SCHEMA).toPandas()
    psi = int(nodes.loc[nodes["node"] == 0, "size"].max()) if len(nodes) else 0
    return nodes.sort_values(["tree", "node"]).reset_index(drop=True), psi


def _heaps(nodes: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The forest as complete binary trees of equal height: features and thresholds of the inner places (trees x places,
    children of p at 2p + 1 and 2p + 2), path lengths of the bottom places.

    A leaf above the bottom hands its path length to all places below it, so which way a row takes there is no matter.
    """
    trees, height = int(nodes["tree"].nunique()), int(nodes["depth"].max()) if len(nodes) else 0
    inner = 2 ** height - 1
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.zeros((trees, inner))
    length = np.zeros((trees, inner + 1))
    reached = nodes["depth"].to_numpy() + c_factor(nodes["size"].to_numpy())
    for t, (_, own) in enumerate(nodes.assign(_e=reached).groupby("tree", sort=True)):
        own = own.sort_values("node")
        place = np.zeros(len(own), np.int64)
        for n, f, thr, left, right, depth, e in zip(*(own[c].tolist() for c in ("node", "feature", "threshold", "left", "right", "depth", "_e"))):
            p = place[n]
            if f >= 0:
                feature[t, p], threshold[t, p] = f, thr
                place[left], place[right] = 2 * p + 1, 2 * p + 2
            else:
                below = 2 ** (height - depth)
                first = (p + 1) * below - 1 - inner
                length[t, first:first + below] = e
    return feature, threshold, length


def _path_lengths(xs: np.ndarray, heaps) -> np.ndarray:
    """Mean path length of every row over all trees; a value that is no number goes right, as it is below no threshold."""
    feature, threshold, length = heaps
    trees, inner = feature.shape
    height = (inner + 1).bit_length() - 1
    values, first = np.ascontiguousarray(xs).ravel(), np.arange(len(xs), dtype=np.int64) * xs.shape[1]
    total = np.zeros(len(xs))
    for t in range(trees):
        place = np.zeros(len(xs), np.int64)
        for _ in range(height):
            below = values.take(first + feature[t].take(place)) <= threshold[t].take(place)
            place += place
            place += 2
            place -= below
        total += length[t].take(place - inner)
    return total / trees


def score(df: DataFrame, nodes: pd.DataFrame, psi: int, features=P.TELEMETRY_FEATURES) -> DataFrame:
    """K8: adds ``_raw_score`` (unrounded) to every row."""
    trees = int(nodes["tree"].nunique()) if len(nodes) else 0
    cpsi = float(c_factor([psi])[0]) if psi > 1 else 1.0
    bc = df.sparkSession.sparkContext.broadcast(_heaps(nodes))  # about trees x (4 x sample) places
    x = feature_matrix(df, features)
    names = df.columns
    n_kept = len(names)
    out_schema = T.StructType(df.schema.fields + [T.StructField("_raw_score", T.DoubleType(), True)])

    def run(it):
        for batch in it:
            kept = batch.columns[:n_kept]
            if batch.num_rows == 0 or trees == 0:
                scores = pa.nulls(batch.num_rows, pa.float64())
            else:
                xs = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[n_kept:]])
                scores = pa.array(-np.power(2.0, -_path_lengths(xs, bc.value) / cpsi), pa.float64())
            yield pa.RecordBatch.from_arrays([*kept, scores], [*names, "_raw_score"])

    return x.mapInArrow(run, out_schema)


def detect(df: DataFrame, key_cols=("transformer_id", "ts"), contamination: float = P.IFOREST_CONTAMINATION,
           seed: int = P.IFOREST_SEED, trees: int = P.IFOREST_TREES, sample: int = P.IFOREST_SAMPLE,
           features=P.TELEMETRY_FEATURES) -> DataFrame:
    """``transformer_id, timestamp, anomaly, score`` for every input row."""
    key_cols = list(key_cols)
    # counting, drawing and scoring each read the rows, the threshold reads the scores several times: both are stored once
    rows = stored(df.select(*key_cols, *features), "anomaly-rows")
    nodes, psi = fit(rows, key_cols, features, trees, sample, seed)
    scored = stored(score(rows, nodes, psi, features).select(*key_cols, "_raw_score"), "anomaly-scores")
    thr = exact_quantiles(scored, [], "_raw_score", [contamination]).select(F.col("quantile").alias("_thr"))
    j = scored.withColumn("_k", F.lit(0)).join(F.broadcast(thr.withColumn("_k", F.lit(0))), "_k", "left")
    return j.select(F.col(key_cols[0]).alias("transformer_id"), F.col(key_cols[1]).alias("timestamp"),
                    (F.col("_raw_score") < F.col("_thr")).alias("anomaly"),
                    round_half_even("_raw_score", 4).alias("score"))


def summary(result: DataFrame) -> DataFrame:
    """Points analysed and outliers found."""
    return result.agg(F.count(F.lit(1)).alias("points"), F.count_if("anomaly").alias("outliers"))


def label_audit(result: DataFrame) -> DataFrame:
    """K10/A17 per unit: points, scores outside [-1, 0] (or null), and rows on the wrong side of the one threshold.

    A threshold separates the labels, so no anomalous row may score above the lowest normal one (scores are rounded, so
    equal ones may carry either label).
    """
    lowest = result.filter(~F.col("anomaly")).agg(F.min("score").alias("_low"))
    j = result.withColumn("_k", F.lit(0)).join(F.broadcast(lowest.withColumn("_k", F.lit(0))), "_k", "left")
    valid = F.coalesce(F.col("score").between(-1.0, 0.0), F.lit(False))
    wrong = F.col("anomaly").isNull() | (F.col("anomaly") & (F.col("score") > F.col("_low")))
    return j.groupBy("transformer_id").agg(F.count(F.lit(1)).alias("points"), F.count_if(~valid).alias("bad_scores"),
                                           F.count_if(wrong).alias("mislabelled"))
