"""All-targets similarity: the pruned k-d search equals an all-pairs brute force."""
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

import numpy as np
import pytest

from gridtel import params as P
from gridtel.operators import knn
from gridtel.plans.layers import Layers

SF = "/root/testdata/sf0.001"


def _score(d: float) -> float:
    x = Decimal(repr(float(1.0 / (1.0 + d)))).quantize(Decimal("1e-9"), ROUND_HALF_UP)
    return float(x.quantize(Decimal("1e-4"), ROUND_HALF_EVEN))


def brute(pdf, k):
    feats = list(P.DESIGN_FEATURES)
    x = pdf[feats].fillna(0.0).to_numpy(dtype=float)
    n = float(len(x))
    fx = np.round(x * 100.0)
    s1 = fx.sum(axis=0) / 100.0
    s2 = (fx * fx).sum(axis=0) / 10000.0
    mean = s1 / n
    std = np.sqrt(np.maximum((s2 - s1 * s1 / n) / n, 0.0))
    std[std == 0] = 1.0
    z = (x - mean) / std
    ids = pdf["transformer_id"].to_numpy()
    out = {}
    for i in range(len(z)):
        acc = np.zeros(len(z))
        for j in range(z.shape[1]):
            dj = z[i, j] - z[:, j]
            acc = acc + dj * dj
        d = np.sqrt(acc)
        cand = sorted(((-_score(d[j]), ids[j]) for j in range(len(z)) if j != i))
        out[ids[i]] = [(c[1], -c[0]) for c in cand[:k]]
    return out


@pytest.mark.parametrize("leaf", [16, 128])
def test_matches_brute_force(spark, leaf):
    reg = Layers(spark, SF).registry
    exp = brute(reg.toPandas(), 5)
    got = {}
    for r in knn.similar_all(reg, 5, leaf_size=leaf).orderBy("target_id", "rank").collect():
        got.setdefault(r.target_id, []).append((r.transformer_id, r.score))
    assert got == exp


def test_hot_duplicate_design(spark):
    """A third of the fleet shares one design: neighbours are the smallest other ids at score 1."""
    from pyspark.sql import functions as F
    reg = Layers(spark, SF).registry
    twin = reg.filter(F.col("transformer_id") == "TR-00002")
    many = twin.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(99)))).withColumn(
        "transformer_id", F.format_string("TR-9%04d", F.col("_i"))).drop("_i")
    res = knn.similar_all(reg.unionByName(many), 5, leaf_size=16)
    rows = res.filter(F.col("target_id") == "TR-90050").orderBy("rank").collect()
    assert [r.transformer_id for r in rows] == ["TR-00002", "TR-90000", "TR-90001", "TR-90002", "TR-90003"]
    assert all(r.score == 1.0 for r in rows)
    assert res.count() == (reg.count() + 100) * 5


def brute_refit(pdf, k, feats):
    """Per target: fit on the others, score, sort — one plain pass for each."""
    x = pdf[feats].fillna(0.0).to_numpy(dtype=float)
    ids, out = pdf["transformer_id"].to_numpy(), {}
    for i in range(len(x)):
        rest = np.delete(x, i, axis=0)
        mean, std = rest.mean(axis=0), rest.std(axis=0)
        std[std < 1e-9] = 1.0
        d = np.sqrt((((x[i] - mean) / std - (x - mean) / std) ** 2).sum(axis=1))
        cand = sorted((-_score(d[j]), ids[j]) for j in range(len(x)) if j != i)
        out[ids[i]] = [(c[1], -c[0]) for c in cand[:k]]
    return out


def _lists(df):
    got = {}
    for r in df.orderBy("target_id", "rank").collect():
        got.setdefault(r.target_id, []).append((r.transformer_id, r.score))
    return got


@pytest.mark.parametrize("leaf", [16, 128])
def test_refit_matches_brute_force(spark, leaf):
    reg = Layers(spark, SF).registry
    assert _lists(knn.similar_all(reg, 5, leaf_size=leaf, refit=True)) == brute_refit(reg.toPandas(), 5, list(P.DESIGN_FEATURES))


def test_refit_agrees_with_one_target(spark):
    from gridtel.operators.similarity import similar_one
    reg = Layers(spark, SF).registry.cache()
    got = _lists(knn.similar_all(reg, 5, leaf_size=16, refit=True))
    for target in sorted(got)[::60]:
        assert got[target] == [tuple(r) for r in similar_one(reg, target, 5).collect()]


def test_refit_outlier_and_constant_feature(spark):
    """One unit alone differs in a feature: without it the feature is constant (deviation 1); a feature all share too."""
    feats = ["a", "b", "c"]
    rows = [(f"TR-{i:03d}", float(i % 7), 10.0, 50.0) for i in range(60)] + [("TR-900", 3.0, 10.0, 52.0)]
    df = spark.createDataFrame(rows, "transformer_id string, a double, b double, c double")
    got = _lists(knn.similar_all(df, 4, feats, leaf_size=8, refit=True))
    assert got == brute_refit(df.toPandas(), 4, feats)
    assert got["TR-900"][0] == ("TR-003", 0.3333)
    one = df.limit(1)
    assert knn.similar_all(one, 4, feats, refit=True).count() == 0
    assert knn.similar_all(df.limit(0), 4, feats, refit=True).count() == 0


@pytest.mark.parametrize("refit", [False, True])
def test_radii_are_finite(spark, refit):
    """Points in leaves with fewer than k + 1 units take the smallest enclosing box that has enough."""
    from pyspark.sql import functions as F
    feats = ["a", "b"]
    rows = [(f"TR-{i:04d}", 0.0, float(i) / 10) for i in range(200)] + [("TR-9000", 500.0, 0.0), ("TR-9001", 501.0, 7.0)]
    df = spark.createDataFrame(rows, "transformer_id string, a double, b double")
    units = knn.scaled_points(df, feats)
    pts = knn.distinct_points(units, feats, 5)
    leaf_of, boxes = knn.build_tree(pts, ["z0", "z1"], 12)
    full = knn.own_scalers(pts, knn.wide_moments(knn.design_features(df, feats), feats), feats).join(leaf_of, "vid")
    small = full.groupBy("leaf").agg(F.sum("cnt").alias("n")).filter("n < 6").count()
    rad = knn.search_radius(full, boxes, ["z0", "z1"], 5, refit)
    assert small > 0 and rad.count() == 202
    x = full.join(rad, "vid").toPandas()
    z = x[["z0", "z1"]].to_numpy()
    w = x[["w0", "w1"]].to_numpy() if refit else np.ones_like(z)
    for i in range(len(z)):
        d = np.sqrt((((z[i] - z) * w[i]) ** 2).sum(axis=1))
        assert (d <= x["rad"][i]).sum() >= 6
    assert _lists(knn.similar_all(df, 5, feats, leaf_size=12, refit=True)) == brute_refit(df.toPandas(), 5, feats)


def _scattered(spark, n):
    rng = np.random.default_rng(5)
    rows = [(f"TR-{i:05d}", float(rng.integers(0, 9)), round(float(rng.normal(40, 9)), 2), float(i % 3)) for i in range(n)]
    rows += [(f"TR-8{i:04d}", *rows[i][1:]) for i in range(0, n, 10)] + [("TR-99999", 900.0, 1.0, 7.0)]
    return spark.createDataFrame(rows, "transformer_id string, a double, b double, c double")


@pytest.mark.parametrize("task_points", [12, 100])
def test_nodes_of_few_points_are_split_in_one_task(spark, task_points):
    """Levels made by aggregates, levels made in a task, and both: one tree whose boxes and counts fit its points."""
    feats, zs = ["a", "b", "c"], ["z0", "z1", "z2"]
    pts = knn.distinct_points(knn.scaled_points(_scattered(spark, 400), feats), feats, 5)
    leaf_of, boxes = knn.build_tree(pts, zs, 12, task_points=task_points)
    p = pts.join(leaf_of, "vid").toPandas()
    nodes = {r["node"]: r for r in boxes.collect()}
    assert len(p) == pts.count() and len(nodes) == boxes.count()
    for node, r in nodes.items():
        inside = p[[leaf >> max(int(leaf).bit_length() - int(node).bit_length(), 0) == node for leaf in p["leaf"]]]
        assert len(inside) == r["n"] and r["is_leaf"] == (2 * node not in nodes) == (r["n"] <= 12)
        assert [r[f"lo_{z}"] for z in zs] == inside[zs].min().tolist() and [r[f"hi_{z}"] for z in zs] == inside[zs].max().tolist()


@pytest.mark.parametrize("refit", [False, True])
def test_leaves_search_the_tree_together(spark, refit):
    """Every point's neighbours lie in the leaves that its leaf is paired with; the lists equal the all-pairs ones."""
    feats, zs = ["a", "b", "c"], ["z0", "z1", "z2"]
    df = _scattered(spark, 400)
    pts = knn.distinct_points(knn.scaled_points(df, feats), feats, 5)
    leaf_of, boxes = knn.build_tree(pts, zs, 12, task_points=50)
    full = knn.own_scalers(pts, knn.wide_moments(knn.design_features(df, feats), feats), feats).join(leaf_of, "vid")
    radius = full.join(knn.search_radius(full, boxes, zs, 5, refit), "vid")
    pairs = {tuple(r) for r in knn.leaf_pairs(radius, boxes, zs, refit).collect()}
    x = radius.toPandas()
    z, w = x[zs].to_numpy(), x[["w0", "w1", "w2"]].to_numpy() if refit else np.ones((len(x), 3))
    for i in range(len(x)):
        near = np.sqrt((((z[i] - z) * w[i]) ** 2).sum(axis=1)) <= x["rad"][i]
        assert {(x["leaf"][i], to) for to in x["leaf"][near]} <= pairs
    assert len(pairs) < x["leaf"].nunique() ** 2
    if refit:
        assert _lists(knn.similar_all(df, 5, feats, leaf_size=12, refit=True, task_points=50)) == brute_refit(df.toPandas(), 5, feats)
