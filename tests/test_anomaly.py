"""Isolation Forest properties on a seeded fixture with one injected outlier."""
import datetime as dt

import numpy as np

from gridtel.operators import anomaly


def fixture(spark, n=200, seed=1):
    rng = np.random.default_rng(seed)
    t0 = dt.datetime(2026, 1, 1)
    rows = []
    for i in range(n):
        load = float(np.clip(rng.normal(65, 8), 40, 90))
        w = float(rng.normal(72, 5))
        if i == 150:
            w, load = 150.0, 98.0
        rows.append(("TR-001", t0 + dt.timedelta(minutes=5 * i), load, float(rng.normal(25, 3)),
                     float(rng.normal(58, 4)), w, float(rng.normal(95, 2))))
    return spark.createDataFrame(rows, "transformer_id string, ts timestamp, load_percent double, "
                                       "ambient_temperature_c double, oil_temperature_c double, "
                                       "winding_temperature_c double, oil_level_percent double")


def test_outlier_flagged(spark):
    df = fixture(spark)
    out = anomaly.detect(df, contamination=0.05).toPandas().sort_values("timestamp").reset_index(drop=True)
    assert len(out) == 200
    assert out["score"].between(-1, 0).all()
    assert bool(out.loc[150, "anomaly"])
    assert out.loc[150, "score"] == out["score"].min()
    assert 8 <= out["anomaly"].sum() <= 12
    s = anomaly.summary(anomaly.detect(df, contamination=0.05)).first()
    assert s.points == 200


def test_deterministic_and_empty(spark):
    df = fixture(spark, 120, seed=4)
    a = anomaly.detect(df).toPandas().sort_values("timestamp")["score"].to_numpy()
    b = anomaly.detect(df.repartition(3)).toPandas().sort_values("timestamp")["score"].to_numpy()
    assert np.array_equal(a, b)
    assert anomaly.detect(df.limit(0)).count() == 0


def test_tree_samples_are_uniform(spark):
    """Every tree has its whole sample; rows are drawn evenly; trees are independent of each other."""
    from pyspark.sql import functions as F
    n, trees, sample = 20_000, 100, 64
    rows = spark.range(n).withColumn("v", F.col("id").cast("double"))
    got = anomaly.tree_samples(rows, F.xxhash64("id", F.lit(7)), ["v"], n, trees, sample).toPandas()
    assert (got.groupby("tree")["v"].nunique() == sample).all() and got["tree"].nunique() == trees
    bins = np.bincount((got["v"].to_numpy() // 1000).astype(int), minlength=20)
    expected = trees * sample / 20
    assert ((bins - expected) ** 2 / expected).sum() < 43.8  # chi-square, 19 degrees, 0.999
    by_tree = {t: set(g["v"]) for t, g in got.groupby("tree")}
    shared = [len(by_tree[a] & by_tree[b]) for a in range(trees) for b in range(a)]
    assert abs(np.mean(shared) - sample ** 2 / n) < 0.03  # standard error 0.0064


def test_tree_samples_take_all_of_few_rows(spark):
    from pyspark.sql import functions as F
    rows = spark.range(10).withColumn("v", F.col("id").cast("double"))
    got = anomaly.tree_samples(rows, F.xxhash64("id"), ["v"], 10, 5, 64)
    assert sorted((r.tree, r["n"]) for r in got.groupBy("tree").agg(F.countDistinct("v").alias("n")).collect()) == [(t, 10) for t in range(5)]


def test_tree_samples_are_limited_before_the_shuffle(spark):
    """A hot tree never reaches one task whole: the window keeps ``sample`` rows per tree on both sides of the exchange."""
    import contextlib
    import io

    from pyspark.sql import functions as F
    buf = io.StringIO()
    rows = spark.range(5000).withColumn("v", F.col("id").cast("double"))
    with contextlib.redirect_stdout(buf):
        anomaly.tree_samples(rows, F.xxhash64("id"), ["v"], 5000, 10, 64).explain()
    assert buf.getvalue().count("WindowGroupLimit") == 2


def test_label_audit_counts_contradictions(spark):
    rows = [("a", -0.7, True), ("a", -0.4, False), ("a", -0.3, True), ("b", -0.4, True), ("b", 0.5, False), ("b", None, False),
            ("c", -0.2, None)]
    got = anomaly.label_audit(spark.createDataFrame(rows, "transformer_id string, score double, anomaly boolean"))
    assert sorted(map(tuple, got.collect())) == [("a", 3, 0, 1), ("b", 3, 2, 0), ("c", 1, 0, 1)]
    assert anomaly.label_audit(anomaly.detect(fixture(spark), contamination=0.05)).collect() == [("TR-001", 200, 0, 0)]


def test_complete_trees_give_the_path_lengths_of_the_node_table():
    import pandas as pd
    rng = np.random.default_rng(3)
    names = [c.split()[0] for c in anomaly.NODE_SCHEMA.split(", ")]
    nodes = pd.DataFrame([n for t in range(12) for n in anomaly._grow(t, rng.normal(size=(64 if t else 3, 4)).round(1), 5, 6)], columns=names)
    xs = rng.normal(size=(300, 4)).round(1)
    xs[7, 2] = np.nan

    def walk(x):
        total = 0.0
        for _, own in nodes.groupby("tree"):
            own = own.set_index("node")
            at = 0
            while own.feature[at] >= 0:
                at = own.left[at] if x[own.feature[at]] <= own.threshold[at] else own.right[at]
            total += own.depth[at] + anomaly.c_factor([own["size"][at]])[0]
        return total / 12

    assert np.array_equal(anomaly._path_lengths(xs, anomaly._heaps(nodes)), [walk(x) for x in xs])


def test_rows_are_computed_once(spark):
    """Counting, drawing and scoring read stored rows; what is behind the input runs once."""
    df = fixture(spark)
    seen = spark.sparkContext.accumulator(0)

    def count(it):
        for pdf in it:
            seen.add(len(pdf))
            yield pdf

    assert anomaly.detect(df.mapInPandas(count, df.schema)).count() == 200
    assert seen.value == 200
