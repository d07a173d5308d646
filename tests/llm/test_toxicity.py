"""Toxicity: held-out accuracy on the labelled documents, and the edge cases."""
import zlib
from collections import Counter

import numpy as np

from gridtel.llm import toxicity as T


def test_held_out_accuracy(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = E.queries()["op10_toxicity"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    truth, score = np.array([r["toxic"] for r in rows]), np.array([r["score"] for r in rows])
    assert ((score >= 0.5) == truth).mean() > 0.98 and (score[truth == 1] >= 0.5).mean() > 0.9
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    pos = truth == 1
    auc = (rank[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())
    assert auc > 0.97


def test_fold(spark):
    ids = [(i,) for i in (0, 1, 5, 17, 123456, -3, None)]
    got = {r[0]: r[1] for r in spark.createDataFrame(ids, "doc_id long").select("doc_id", T.held_out()).collect()}
    assert got == {i: i is None or zlib.crc32(str(i).encode()) % 5 == 0 for (i,) in ids}


def test_counts_and_scores_against_brute_force(spark):
    docs, labels = corpus()
    docs += [(3, "short"), (1, None), (900, "unlabelled worthless"), (None, "no id")]
    docs = [(i, t, "x") for i, t, *_ in docs]
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    toxic_of = {}
    for i, _, t in labels:
        if i is not None and t is not None and zlib.crc32(str(i).encode()) % 5:
            toxic_of[i] = max(toxic_of.get(i, 0), t)
    n, toxic, texts = Counter(), Counter(), Counter()
    for i, t in toxic_of.items():
        text = max(x or "" for j, x, _ in docs if j == i)
        texts["all"] += 1
        texts["toxic"] += t
        low = "".join(c.lower() if c.isascii() else c for c in text)
        cells = {int(T.grams(low[k:k + m])[0]) for m in T.ORDERS for k in range(len(low) - m + 1) if len(T.grams(low[k:k + m])) == 1}
        cells |= {int(c) for c in T.grams(low)}
        n.update(cells)
        toxic.update(cells if t else ())
    judged = T.stored(T.judged_ids(lab), "judged")
    got_n, got_toxic = Counter(), Counter()
    for r in T.cell_counts(d, judged).collect():
        a, b = T._counts(r["n"]), T._counts(r["toxic"])
        if r["block"] < 0:
            assert (a[0], b[0]) == (texts["all"], texts["toxic"])
            continue
        got_n.update({r["block"] * T.BLOCK + k: int(a[k]) for k in np.flatnonzero(a)})
        got_toxic.update({r["block"] * T.BLOCK + k: int(b[k]) for k in np.flatnonzero(b)})
    assert got_n == n and got_toxic == toxic
    model = T.train(d, lab)
    dense = model.dense()
    for r in T.score(d, model).collect():
        z = [model.bias + sum(float(dense[c]) for c in {int(c) for c in T.grams(t or "")}) for i, t, _ in docs if i == r["doc_id"]]
        assert any(abs(r["score"] - 1 / (1 + np.exp(-x))) < 1e-9 for x in z)


def test_scales():
    got = T.scales(np.array([0, 10, 10, 40, 2]), np.array([0, 1, 10, 0, 1]), 100, 10)
    assert got[0] == 0 and got[1] == 0 and got[2] > 2 and got[3] < 0 and got[4] == 0
    g = 2 * 10 * np.log(10)
    assert np.isclose(got[2], (np.log(10.1 / 10) - np.log(0.9 / 90)) * (1 - 4 / g))
    assert np.isclose(T.scales(np.array([10]), np.array([10]), 10**6, 10**5)[0], (np.log(10.1 / 10**5) - np.log(0.9 / 900_000)) * (1 - np.log(10**6) / 2 / g))


def test_unlabelled_texts_stay_out_of_the_shuffle(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = T.stored(T.judged_ids(spark.read.parquet("/root/testdata/sf0.01/labels.parquet")), "judged")
    with T.runtime_filter(spark, 1000):
        plan = T.labelled_texts(d, judged)._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("might_contain")
    assert plan.rindex("Exchange", 0, scan) < scan   # below the shuffle of the texts


def corpus():
    bad, good = "you worthless clown go away", "the committee met again on monday"
    docs = [(i, (bad if i % 3 == 0 else good) + f" note {i}", "clash") for i in range(120)]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(120)] + [(0, 1, 0), (None, 1, 1), (7, 1, None)]
    return docs, labels


def test_learns_and_filters(spark):
    docs, labels = corpus()
    docs += [(500, None, "x"), (501, "", "x"), (501, "", "x"), (None, "worthless clown", None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = T.train(d, lab)
    out = T.score(d, model).collect()
    assert len(out) == len(docs) and all(0 <= r["score"] <= 1 for r in out)
    for r in out:
        if r["doc_id"] is not None and r["doc_id"] < 120:
            assert (r["score"] >= 0.5) == (r["doc_id"] % 3 == 0)
    kept = T.drop_toxic(d, lab)
    assert kept.columns == d.columns and {r["doc_id"] for r in kept.collect()} >= {i for i in range(120) if i % 3}


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    flipped = [(i, q, t if i is None or t is None or zlib.crc32(str(i).encode()) % 5 else 1 - t) for i, q, t in labels]
    a, b = (T.train(d, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped))
    assert np.array_equal(a.dense(), b.dense()) and a.bias == b.bias


def test_wording_outside_the_sample_counts(spark):
    docs, labels = corpus()
    first = 10_000
    docs += [(i, f"pathetic vermin number {i}", "x") for i in range(first, first + 60)]
    labels += [(i, 1, 1) for i in range(first, first + 60)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    sampled = lab.where("toxic = 1").where(~T.held_out()).orderBy(T.F.xxhash64("doc_id"), "doc_id").limit(200)
    chosen = [r["doc_id"] for r in sampled.collect()]
    n = next(i for i, x in enumerate(chosen) if x >= first)  # the sample ends before the first of the new wording
    model = T.train(d, lab, toxic_rows=max(n, 1) if n else 3)
    assert (model.dense()[T.grams("pathetic vermin")] > 0).all()
    out = {r["doc_id"]: r["score"] for r in T.score(d, model).collect()}
    assert all(out[i] >= 0.5 for i in range(first, first + 60))
    assert all((out[i] >= 0.5) == (i % 3 == 0) for i in range(120))


def test_repeated_rows_of_a_document_train_once(spark):
    docs, labels = corpus()
    once, many = (spark.createDataFrame(x, "doc_id long, text string, score string")
                  for x in (docs, docs + [docs[1]] * 300 + [(1, None, "x")]))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    judged = T.judged_ids(lab)
    assert T.training_rows(many, judged, 3000, 6000).count() == T.training_rows(once, judged, 3000, 6000).count()
    a, b = T.train(once, lab), T.train(many, lab)
    assert np.allclose(a.dense(), b.dense()) and np.isclose(a.bias, b.bias)


def test_one_label_only_and_empty(spark):
    d = spark.createDataFrame([(1, "a b c d"), (2, "e f g h")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in T.score(d, T.train(d, none)).collect()} == {0.0}
    toxic = spark.createDataFrame([(i, 1, 1) for i in range(1, 3)], "doc_id long, quality int, toxic int")
    assert T.score(d.limit(0), T.train(d, toxic)).count() == 0
