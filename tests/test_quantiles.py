"""Exact distributed quantiles against numpy (linear interpolation)."""
import numpy as np
import pytest

from gridtel.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("grid,accuracy", [(2000, 20_000), (16, 200)])
def test_matches_numpy(spark, grid, accuracy):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(50, 10, 3000).round(2), np.full(2000, 42.0), rng.integers(0, 5, 500)])
    groups = np.where(np.arange(len(vals)) % 3 == 0, "a", "b")
    rows = [(str(g), float(v)) for g, v in zip(groups, vals)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r.g, r.q): r.quantile for r in exact_quantiles(df, ["g"], "v", qs, grid=grid, accuracy=accuracy).collect()}
    for g in ("a", "b"):
        sub = vals[groups == g]
        for q in qs:
            assert got[(g, q)] == pytest.approx(np.percentile(sub, 100 * q), abs=1e-9), (g, q)
    allq = exact_quantiles(df, [], "v", [0.05], grid=grid, accuracy=accuracy).collect()
    assert allq[0].quantile == pytest.approx(np.percentile(vals, 5), abs=1e-9)


def test_infinities_ties_and_empty(spark):
    df = spark.createDataFrame([(v,) for v in [float("-inf"), 1.0, 1.0, 1.0, float("inf"), float("nan"), None]], "v double")
    got = {r.q: r.quantile for r in exact_quantiles(df, [], "v", [0.0, 0.5, 1.0]).collect()}
    assert got == {0.0: float("-inf"), 0.5: 1.0, 1.0: float("inf")}
    assert exact_quantiles(df.limit(0), [], "v", [0.5]).count() == 0


def test_large_range_has_no_product_and_no_window(spark):
    import contextlib
    import io
    from gridtel.operators import quantiles
    seen = []
    real = quantiles.cut_lineage

    def spy(df):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        seen.append(buf.getvalue())
        return real(df)

    quantiles.cut_lineage = spy
    try:
        df = spark.range(2_000_000).selectExpr("cast(id as double) as v")
        assert exact_quantiles(df, [], "v", [0.25]).collect()[0].quantile == 499_999.75
    finally:
        quantiles.cut_lineage = real
    assert not any(word in plan for plan in seen for word in ("CartesianProduct", "NestedLoop", "Window"))


@pytest.mark.parametrize("small", [0, 1, 40, 1500, 100_000])
def test_narrowing_and_picking_agree(spark, small):
    """From narrowing to the last value up to one array for everything: the same quantiles, for groups of unequal size."""
    rng = np.random.default_rng(3)
    vals = {"wide": rng.normal(0, 5, 4000), "tied": np.repeat([1.0, 2.0, 3.0], 900), "few": np.array([5.0, 7.0]), "one": np.array([9.0])}
    df = spark.createDataFrame([(g, float(v)) for g, x in vals.items() for v in x], "g string, v double").repartition(4)
    qs = [0.0, 0.05, 0.5, 0.95, 1.0]
    rows = exact_quantiles(df, ["g"], "v", qs, grid=16, accuracy=200, small=small).collect()
    assert len(rows) == len(vals) * len(qs)
    for r in rows:
        assert r["quantile"] == pytest.approx(np.percentile(vals[r["g"]], 100 * r["q"]), abs=1e-9), (r["g"], r["q"])
