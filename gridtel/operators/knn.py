"""Exact top-k similar designs for every unit, without all pairs.

Scaled space: the standard scaler fitted on all units (notebook semantics),
score = 1 / (1 + d) rounded half-even to 4 dp, ties by id.  With ``refit``
the scaler is fitted anew for every target on the other units, as
``similarity.similar_one`` does for one: mean and deviation of each target
follow from the total n, sum and sum of squares less its own values, so no
pass per target is needed.  The tree stays in the common space; a target sees
it stretched by (common deviation / own deviation) in every dimension, and
boxes stay boxes, so its distance to a box is exact.

1. Identical designs collapse into one point per distinct feature vector
   with its unit count and its ``k + 1`` smallest ids (a salted two-level
   top-n, so a vector shared by a third of the fleet never lands in one
   task).
2. A k-d partition of the distinct points: level by level, every node
   holding more than ``task_points`` points splits at an approximate median
   of its widest scaled dimension (one aggregate per level); below that a
   node is split down to ``leaf_size`` inside one task, whose size is thereby
   bounded.  Node boxes of every level are kept.
3. Radius: inside its own leaf each point finds the distance covering
   ``k + 1`` units (itself included), widened to the largest distance that
   still rounds to the same 4-dp score, so rounding ties are never lost.  In a
   leaf with fewer units it is the distance to the farthest corner of the
   smallest enclosing box with enough of them.
4. Search: (leaf, node) pairs descend the tree from the root, ``STEP`` levels
   at a time; a node is kept while the distance of the boxes is within the
   largest radius of the leaf's points.  The points of a leaf then keep those
   of its leaves whose box is within their own radius.  They give the only
   candidate pairs; the exact top ``k + 1`` units per point follow from them.
5. Each unit takes its point's list without itself: the first ``k``.

Work is about (#points x visited leaves x leaf_size) instead of #units^2.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions.measures import READING_SCALE, round_half_even
from ..session import cut_lineage, stored
from .similarity import design_features, fixed, mean_std, scaled_distance, wide_moments

EPS = 1e-9
TASK_POINTS = 65_536  # a node of at most so many points is split to its leaves in one task
STEP = 4              # levels of the tree that the search descends at once


def _z(features: Sequence[str]) -> list[str]:
    return [f"z{i}" for i in range(len(features))]


def scaled_points(registry: DataFrame, features: Sequence[str] = P.DESIGN_FEATURES) -> DataFrame:
    """Units with their scaled coordinates ``z0..z{d-1}`` (scaler fitted on all units)."""
    feats = design_features(registry, features)
    mom = wide_moments(feats, features)
    j = feats.withColumn("_k", F.lit(0)).join(F.broadcast(mom.withColumn("_k", F.lit(0))), "_k")
    cols = []
    for i, f in enumerate(features):
        mean, std = mean_std(F.col("n"), F.col(f"s1_{f}"), F.col(f"s2_{f}"))
        cols.append(((F.col(f) - mean) / std).alias(f"z{i}"))
    return j.select("transformer_id", *features, *cols)


def _squares(gaps: Sequence[Column], refit: bool, of: str = "") -> Column:
    """Sum of squared gaps per dimension; with ``refit`` in the scale of the target ``of`` (its ``w{i}``)."""
    acc = None
    for i, g in enumerate(gaps):
        g = g * F.col(f"{of}w{i}") if refit else g
        acc = g * g if acc is None else acc + g * g
    return acc


def _sqdist(a: str, b: str, zs: Sequence[str], refit: bool = False) -> Column:
    return _squares([F.col(f"{a}.{z}") - F.col(f"{b}.{z}") for z in zs], refit, f"{a}.")


def own_scalers(points: DataFrame, moments: DataFrame, features: Sequence[str], scale: int = READING_SCALE) -> DataFrame:
    """``m{i}``, ``s{i}``: the scaler fitted on all units but one with the point's design; ``w{i}``: common / own deviation.

    ``moments`` is one row (``wide_moments`` over all units).  With a single unit there are no others: the scaler is then
    mean 0 and deviation 1, and no pair uses it.
    """
    j = points.withColumn("_k", F.lit(0)).join(F.broadcast(moments.withColumn("_k", F.lit(0))), "_k")
    cols = []
    for i, f in enumerate(features):
        x, s1, s2 = fixed(f, scale), F.col(f"s1_{f}"), F.col(f"s2_{f}")
        mean, std = mean_std(F.greatest(F.col("n") - 1, F.lit(1)), s1 - x, s2 - x * x, scale)
        common = mean_std(F.col("n"), s1, s2, scale)[1]
        cols += [mean.alias(f"m{i}"), std.alias(f"s{i}"), (common / std).alias(f"w{i}")]
    return j.select(*[F.col(c) for c in points.columns], *cols)


def _design_hash(features: Sequence[str]) -> Column:
    """One number per design: rows are dealt and sorted by it, as many designs share their first features (-0.0 is 0.0)."""
    return F.xxhash64(*[F.col(f) + F.lit(0.0) for f in features])


def distinct_points(units: DataFrame, features: Sequence[str], k: int, salt: int = 64) -> DataFrame:
    """One row per distinct design: ``vid``, coordinates, unit count, k+1 smallest ids."""
    zs = _z(features)
    fk = ["_h", *features]
    units = units.withColumn("_h", _design_hash(features))
    s = units.withColumn("_s", F.pmod(F.xxhash64("transformer_id"), F.lit(salt)))
    w1 = Window.partitionBy(*fk, "_s").orderBy("transformer_id")
    lvl1 = s.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= k + 1)
    w2 = Window.partitionBy(*fk).orderBy("transformer_id")
    lvl2 = lvl1.withColumn("_r2", F.row_number().over(w2)).filter(F.col("_r2") <= k + 1)
    ids = lvl2.groupBy(*fk).agg(F.sort_array(F.collect_list("transformer_id")).alias("ids"))
    cnt = units.groupBy(*fk).agg(F.count(F.lit(1)).alias("cnt"), *[F.first(z).alias(z) for z in zs])
    pts = cnt.join(ids, fk).withColumn("vid", F.monotonically_increasing_id())
    return stored(pts.select("vid", *features, *zs, "cnt", "ids"), "knn-points")


def subtree(node: int, x: np.ndarray, leaf_size: int, max_levels: int) -> tuple[np.ndarray, list[tuple]]:
    """Leaf of every row of ``x`` below ``node``, and the boxes ``(node, n, lo, hi, is_leaf)`` of the node and all below it."""
    leaf, boxes, todo = np.zeros(len(x), np.int64), [], [(node, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        lo, hi = x[rows].min(axis=0), x[rows].max(axis=0)
        dim = int((hi - lo).argmax())
        is_leaf = len(rows) <= leaf_size or hi[dim] - lo[dim] <= 0
        boxes.append((node, len(rows), lo.tolist(), hi.tolist(), is_leaf))
        if is_leaf:
            leaf[rows] = node
            continue
        if node.bit_length() > max_levels:
            raise RuntimeError(f"k-d tree deeper than {max_levels} levels: node numbers would overflow")
        v = x[rows, dim]
        med = np.partition(v, (len(v) - 1) // 2)[(len(v) - 1) // 2]
        right = v > med if med < hi[dim] else v >= med
        todo += [(2 * node, rows[~right]), (2 * node + 1, rows[right])]
    return leaf, boxes


def build_tree(points: DataFrame, zs: Sequence[str], leaf_size: int, max_levels: int = 61, task_points: int = TASK_POINTS):
    """Returns (leaf assignment ``vid -> leaf``, node boxes ``node, n, lo_i, hi_i, is_leaf``).

    While nodes hold more than ``task_points`` points, one aggregate per level
    gives every node's box and an approximate median of each dimension; a node
    splits on its widest dimension.  Smaller nodes are split to their leaves by
    ``subtree``, one task for each.  The split
    value only has to leave both sides non-empty (the search is exact for
    any split), so approximate medians suffice: ``x > med`` goes right, or
    ``x >= med`` when the median equals the maximum.
    """
    zs = list(zs)
    most = max(leaf_size, task_points)
    active = points.select("vid", *zs, F.lit(1).cast("long").alias("node"))
    small, boxes = [], []
    for _ in range(max_levels):
        stats = active.groupBy("node").agg(F.count(F.lit(1)).alias("n"),
                                           *[F.min(z).alias(f"lo_{z}") for z in zs],
                                           *[F.max(z).alias(f"hi_{z}") for z in zs],
                                           *[F.percentile_approx(z, 0.5, 1000).alias(f"md_{z}") for z in zs])
        spread = F.array(*[F.col(f"hi_{z}") - F.col(f"lo_{z}") for z in zs])
        stats = (stats.withColumn("_w", F.array_max(spread))
                 .withColumn("dim", (F.array_position(spread, F.col("_w")) - 1).cast("int"))
                 .withColumn("is_leaf", (F.col("n") <= leaf_size) | (F.col("_w") <= 0))
                 .withColumn("is_small", (F.col("n") <= most) & ~F.col("is_leaf"))
                 .withColumn("med", F.element_at(F.array(*[F.col(f"md_{z}") for z in zs]), F.col("dim") + 1))
                 .withColumn("mx", F.element_at(F.array(*[F.col(f"hi_{z}") for z in zs]), F.col("dim") + 1)))
        stats = stored(stats, "knn-nodes")
        boxes.append(stats.filter(~F.col("is_small")).select("node", "n", *[f"lo_{z}" for z in zs], *[f"hi_{z}" for z in zs], "is_leaf"))
        a = active.join(stats.select("node", "dim", "is_leaf", "is_small", "med", "mx"), "node")
        small.append(a.filter("is_leaf OR is_small").select("vid", *zs, "node", "is_small"))
        if stats.filter(~F.col("is_leaf") & ~F.col("is_small")).limit(1).count() == 0:
            break
        x = F.element_at(F.array(*zs), F.col("dim") + 1)
        right = F.when(F.col("med") < F.col("mx"), x > F.col("med")).otherwise(x >= F.col("med"))
        active = cut_lineage(a.filter(~F.col("is_leaf") & ~F.col("is_small"))
                             .select("vid", *zs, (F.col("node") * 2 + right.cast("long")).alias("node")))
    else:
        raise RuntimeError(f"k-d tree deeper than {max_levels} levels: node numbers would overflow")

    schema = pa.schema([("vid", pa.int64()), ("leaf", pa.int64()), ("node", pa.int64()), ("n", pa.int64()),
                        ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())), ("is_leaf", pa.bool_())])

    def split(rows: pa.Table) -> pa.Table:
        x = np.column_stack([rows[z].to_numpy() for z in zs])
        leaf, below = subtree(rows["node"][0].as_py(), x, leaf_size, max_levels)
        none, blank = [None] * len(below), [None] * len(leaf)
        columns = [rows["vid"].to_pylist() + none, leaf.tolist() + none, *[blank + list(c) for c in zip(*below)]]
        return pa.table([pa.array(c, t.type) for c, t in zip(columns, schema)], schema)

    leaf_df, split_df = None, None
    for part in small:
        done = part.filter(~F.col("is_small")).select("vid", F.col("node").alias("leaf"))
        todo = part.filter("is_small").drop("is_small")
        leaf_df, split_df = (done, todo) if leaf_df is None else (leaf_df.unionByName(done), split_df.unionByName(todo))
    split_df = stored(split_df.groupBy("node").applyInArrow(
        split, "vid long, leaf long, node long, n long, lo array<double>, hi array<double>, is_leaf boolean"), "knn-subtrees")
    leaf_df = leaf_df.unionByName(split_df.filter("vid IS NOT NULL").select("vid", "leaf"))
    box_df = split_df.filter("node IS NOT NULL").select(
        "node", "n", *[F.col("lo")[i].alias(f"lo_{z}") for i, z in enumerate(zs)],
        *[F.col("hi")[i].alias(f"hi_{z}") for i, z in enumerate(zs)], "is_leaf")
    for b in boxes:
        box_df = box_df.unionByName(b)
    return stored(leaf_df, "knn-leaves"), stored(box_df, "knn-boxes")


def covering_distance(x: np.ndarray, w: np.ndarray | None, cnt: np.ndarray, k: int, block: int = 1024) -> np.ndarray:
    """Per row the distance (with its weights ``w``) that covers ``k + 1`` units of ``x``, NaN when there are fewer."""
    out, most = np.full(len(x), np.nan), min(k + 1, len(x))
    for at in range(0, len(x), block):
        d = np.zeros((len(x[at:at + block]), len(x)))
        for i in range(x.shape[1]):
            gap = x[at:at + block, i, None] - x[None, :, i]
            if w is not None:
                gap *= w[at:at + block, i, None]
            d += gap * gap
        near = np.argpartition(d, most - 1, axis=1)[:, :most]
        near_d = np.take_along_axis(d, near, axis=1)
        order = near_d.argsort(axis=1)
        enough = np.take_along_axis(cnt[near], order, axis=1).cumsum(axis=1) >= k + 1
        r = np.sqrt(np.take_along_axis(near_d, order, axis=1)[np.arange(len(d)), enough.argmax(axis=1)])
        out[at:at + block] = np.where(enough.any(axis=1), r, np.nan)
    return out


def search_radius(p: DataFrame, boxes: DataFrame, zs: Sequence[str], k: int, refit: bool = False) -> DataFrame:
    """``vid, rad``: a distance within which every point (``p``: vid, leaf, coordinates, cnt) has ``k + 1`` units, itself included.

    Infinite only when all points together are fewer than ``k + 1``.
    """
    ws = [f"w{i}" for i in range(len(zs))] if refit else []

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None  # the last leaf of a batch may go on in the next
        for batch in batches:
            rows = batch if kept is None else pd.concat([kept, batch])
            last = int(np.searchsorted(rows["leaf"].to_numpy(), rows["leaf"].iloc[-1])) if len(rows) else 0
            kept = rows.iloc[last:]
            if last:
                yield covered(rows.iloc[:last])
        if kept is not None and len(kept):
            yield covered(kept)

    def covered(rows: pd.DataFrame) -> pd.DataFrame:
        leaf, x, cnt = rows["leaf"].to_numpy(), rows[zs].to_numpy(), rows["cnt"].to_numpy()
        w, r = rows[ws].to_numpy() if refit else None, np.empty(len(rows))
        ends = [0, *(np.flatnonzero(np.diff(leaf)) + 1).tolist(), len(leaf)]
        for m, n in zip(ends, ends[1:]):
            r[m:n] = covering_distance(x[m:n], w[m:n] if refit else None, cnt[m:n], k)
        return pd.DataFrame({"vid": rows["vid"].to_numpy(), "r": r})

    zs = list(zs)
    r = p.select("vid", "leaf", *zs, "cnt", *ws).repartition("leaf").sortWithinPartitions("leaf").mapInPandas(
        leaves, "vid long, r double")
    r = stored(r.filter(~F.isnan("r")), "knn-radius")
    sparse = p.join(r, "vid", "left_anti")
    # nodes are numbered 1, 2-3, 4-7, ...: the ancestors of a leaf are its number shifted right
    up = sparse.withColumn("node", F.explode(F.transform(F.sequence(F.lit(0), F.lit(62)), lambda i: F.call_function(
        "shiftright", F.col("leaf"), i)))).filter(F.col("node") > 0)
    far = _squares([F.greatest(F.abs(F.col(z) - F.col(f"lo_{z}")), F.abs(F.col(f"hi_{z}") - F.col(z))) for z in zs], refit)
    corner = up.join(boxes.filter(F.col("n") >= k + 1), "node").groupBy("vid").agg(F.min(F.sqrt(far)).alias("r"))
    r = r.unionByName(corner)
    s_k = round_half_even(F.lit(1.0) / (F.lit(1.0) + F.col("r")), 4)
    lo_score = s_k - F.lit(0.00005)
    wide = F.when(lo_score <= 0, F.lit(float("inf"))).otherwise(F.lit(1.0) / lo_score - F.lit(1.0))
    return p.select("vid").join(r, "vid", "left").select(
        "vid", F.coalesce(F.greatest(wide, F.col("r")) * (1 + EPS) + EPS, F.lit(float("inf"))).alias("rad"))


def leaf_pairs(radius: DataFrame, boxes: DataFrame, zs: Sequence[str], refit: bool = False) -> DataFrame:
    """``leaf, to``: for every leaf the leaves whose box may hold a point within the radius of one of its points.

    ``radius``: leaf, coordinates, rad (and the weights).  The boxes' distance, in the smallest weight of the leaf's points,
    is at most that of any of its points, so no pair is lost.
    """
    ws = [f"w{i}" for i in range(len(zs))] if refit else []
    own = stored(radius.groupBy("leaf").agg(F.max("rad").alias("rad"), *[F.min(w).alias(w) for w in ws],
                                            *[F.min(z).alias(f"a_{z}") for z in zs], *[F.max(z).alias(f"b_{z}") for z in zs]),
                 "knn-reach")
    # the search goes from a node at a depth divisible by STEP to its descendants STEP levels below, and to leaves before
    depth = F.length(F.bin("node")) - 1
    above = (F.floor((depth - 1) / STEP) * STEP).cast("int")
    steps = boxes.filter((depth % STEP == 0) | F.col("is_leaf")).withColumn("depth", depth).withColumn(
        "up", F.call_function("shiftright", "node", F.col("depth") - above)).withColumn("above", above)
    steps = stored(steps.drop("n"), "knn-steps")
    gap = _squares([F.greatest(F.lit(0.0), F.col(f"lo_{z}") - F.col(f"b_{z}"), F.col(f"a_{z}") - F.col(f"hi_{z}")) for z in zs],
                   refit)
    one = boxes.filter("node = 1").select(F.col("node").alias("to"), "is_leaf")
    f, found, at = stored(own.select("leaf").crossJoin(F.broadcast(one)), "knn-pairs"), [], 0
    while True:
        found.append(f.filter("is_leaf").select("leaf", "to"))
        inner = f.filter(~F.col("is_leaf")).select("leaf", F.col("to").alias("up"))
        if inner.limit(1).count() == 0:
            break
        below = steps.filter((F.col("above") == at) & (F.col("depth") > 0))
        f = inner.join(below, "up").join(own, "leaf").filter(F.sqrt(gap) <= F.col("rad")).select(
            "leaf", F.col("node").alias("to"), "is_leaf")
        f, at = stored(f, "knn-pairs"), at + STEP
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def similar_all(registry: DataFrame, k: int = 5, features: Sequence[str] = P.DESIGN_FEATURES,
                leaf_size: int = 128, refit: bool = False, task_points: int = TASK_POINTS) -> DataFrame:
    """``target_id, rank, transformer_id, score`` — the exact top-k for every unit.

    ``refit``: the scaler of every target is fitted on the other units (as ``similar_one``), else once on all.
    """
    zs = _z(features)
    # read once; a small file is one task, whose rows are dealt to all
    parts = int(registry.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    registry = stored(design_features(registry, features).repartition(parts), "knn-registry")
    units = stored(scaled_points(registry, features), "knn-units")
    pts = distinct_points(units, features, k)
    leaf_of, boxes = build_tree(pts, zs, max(leaf_size, 2 * (k + 1)), task_points=task_points)
    own = [f"{c}{i}" for i in range(len(features)) for c in "msw"] if refit else []
    raw = list(features) if refit else []
    p = own_scalers(pts, wide_moments(design_features(registry, features), features), features) if refit else pts
    p = p.join(leaf_of, "vid").select("vid", "leaf", *zs, "cnt", "ids", *raw, *own)
    p = stored(p, "knn-designs")
    # 3. radius covering k+1 units
    radius = stored(p.select("vid", "leaf", *zs, *raw, *own).join(search_radius(p, boxes, zs, k, refit), "vid"), "knn-radii")
    # 4. descend the tree, then keep the points within reach of a leaf
    visit = leaf_pairs(radius, boxes, zs, refit).join(boxes.drop("n", "is_leaf").withColumnRenamed("node", "to"), "to")
    gap = _squares([F.greatest(F.lit(0.0), F.col(f"lo_{z}") - F.col(z), F.col(z) - F.col(f"hi_{z}")) for z in zs], refit)
    visit = radius.join(visit, "leaf").filter(F.sqrt(gap) <= F.col("rad")).select(
        "vid", F.col("to").alias("leaf"), *zs, *raw, *own, "rad")
    # candidates: points of the visited leaves within the radius
    t = visit.alias("t")
    c = p.alias("c")
    if refit:
        def per(prefix):
            return {f: F.col(f"t.{prefix}{i}") for i, f in enumerate(features)}
        dist = scaled_distance({f: F.col(f"t.{f}") for f in features}, {f: F.col(f"c.{f}") for f in features},
                               per("m"), per("s"), features)
    else:
        dist = F.sqrt(_sqdist("t", "c", zs))
    cand = t.join(c, F.col("t.leaf") == F.col("c.leaf")).select(
        F.col("t.vid").alias("vid"), F.col("c.vid").alias("cvid"), F.col("c.ids").alias("ids"),
        dist.alias("d"), F.col("t.rad").alias("rad"))
    cand = cand.filter(F.col("d") <= F.col("rad"))
    per_unit = cand.select("vid", "d", F.explode("ids").alias("transformer_id"))
    per_unit = per_unit.withColumn("score", round_half_even(F.lit(1.0) / (F.lit(1.0) + F.col("d")), 4))
    wt = Window.partitionBy("vid").orderBy(F.desc("score"), "transformer_id")
    top = per_unit.withColumn("_r", F.row_number().over(wt)).filter(F.col("_r") <= k + 1) \
                  .select("vid", "transformer_id", "score", "_r")
    top = stored(top, "knn-top")
    # 5. expand to units: each unit drops itself from its point's list
    fk, h = list(features), _design_hash(features).alias("_h")
    u = units.select("transformer_id", *fk, h).join(pts.select("vid", *fk, h), ["_h", *fk]).select(
        F.col("transformer_id").alias("target_id"), "vid")
    lst = top.groupBy("vid").agg(F.sort_array(F.collect_list(F.struct("_r", "transformer_id", "score")))
                                 .alias("lst"))
    j = u.join(lst, "vid")
    kept = F.filter("lst", lambda e: e["transformer_id"] != F.col("target_id"))
    out = j.select("target_id", F.slice(kept, 1, k).alias("lst"))
    out = out.select("target_id", F.posexplode("lst").alias("pos", "e"))
    return out.select("target_id", (F.col("pos") + 1).alias("rank"), F.col("e.transformer_id").alias("transformer_id"),
                      F.col("e.score").alias("score"))

