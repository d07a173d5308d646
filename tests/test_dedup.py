"""Keyed first/latest selection against pandas."""
import numpy as np
import pandas as pd

from gridtel.operators.dedup import duplicate_keys, keep_first, keep_latest


def test_first_latest(spark):
    rng = np.random.default_rng(3)
    n = 2000
    pdf = pd.DataFrame({"k": rng.integers(0, 50, n), "t": rng.integers(0, 30, n), "v": rng.normal(size=n)})
    pdf.loc[pdf.k == 7, "k"] = 0  # a hot key
    df = spark.createDataFrame(pdf).repartition(6)
    first = keep_first(df, ["k"], ["t", "v"]).toPandas().set_index("k").sort_index()
    latest = keep_latest(df, ["k"], ["t", "v"]).toPandas().set_index("k").sort_index()
    ef = pdf.sort_values(["t", "v"]).groupby("k").head(1).set_index("k").sort_index()
    el = pdf.sort_values(["t", "v"]).groupby("k").tail(1).set_index("k").sort_index()
    assert np.allclose(first["v"], ef["v"]) and (first["t"] == ef["t"]).all()
    assert np.allclose(latest["v"], el["v"]) and (latest["t"] == el["t"]).all()
    dups = duplicate_keys(df, ["k"]).count()
    assert dups == (pdf.groupby("k").size() > 1).sum()


def test_nulls_never_win(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 9, 3), ("b", None, 4)], "k string, t int, v int")
    first = {r.k: r.v for r in keep_first(df, ["k"], ["t"]).collect()}
    latest = {r.k: r.v for r in keep_latest(df, ["k"], ["t"]).collect()}
    assert first == {"a": 2, "b": 4} and latest == {"a": 3, "b": 4}


def test_measurements_shuffle_no_payload(spark):
    """Measurements come from the accepted messages in one shuffle of their own columns, with the rows of the two steps."""
    import contextlib
    import io

    from gridtel.operators import contract, ingest
    from gridtel.plans.layers import Layers
    L = Layers(spark, "/root/testdata/sf0.001")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        L.measurements.explain()
    partial = [line for line in buf.getvalue().splitlines() if "partial_min(struct(" in line]
    assert len(partial) == 1 and "payload" not in partial[0]
    twice = spark.createDataFrame([("a", i, v) for i in range(3) for v in (None, 2.0, 1.0)], "k string, t int, v double")
    assert keep_latest(twice, ["k"], ["t", "v"]).collect() == [("a", 2, 2.0)]
    assert keep_first(twice, ["k"], ["t", "v"]).collect() == [("a", 0, 1.0)]
    two_steps = ingest.measurements(ingest.first_accepted(L.validated))
    assert sorted(map(str, L.measurements.collect())) == sorted(map(str, two_steps.collect()))
    assert contract.accepted(L.validated).count() >= two_steps.count()
