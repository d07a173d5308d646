"""Quality ranking: held-out accuracy, the pairwise fit and the quantile against plain versions, and the edge cases."""
import zlib

import numpy as np

from gridtel.llm import quality_ranking as Q

DOCS = "doc_id long, text string, score string"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.1"
    out = E.queries()["op11_quality"](spark, sf).cache()
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == 10_000
    rows = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    truth, score = np.array([r["quality"] for r in rows]), np.array([r["score"] for r in rows])
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert ((score >= 0.3) == truth).mean() > 0.98
    assert (score[truth == 1][:, None] > score[truth == 0][None]).mean() > 0.995


def corpus():
    docs = [(i, ("The committee met again on day %d. It rose." if i % 4 else "BUY!!! $$$ %d ### BUY!!!") % i, "clash") for i in range(200)]
    return docs, [(i, int(i % 4 > 0), 0) for i in range(200)]


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def test_ranks_and_cases(spark):
    docs, labels = corpus()
    docs += [(900, None, "x"), (901, "", "x"), (901, "", "x"), (None, "$$$", None), (902, "word " * 60_000, "x")]
    labels += [(None, 0, 0), (3, None, 0), (1, 0, 0)]  # 1 has both labels: bad
    out = Q.rank(*frames(spark, docs, labels)).collect()
    assert len(out) == len(docs) and all(0 <= r["score"] <= 1 for r in out)
    for r in out:
        if r["doc_id"] is None:
            assert r["held_out"] and r["predicted"] == 0
        else:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
            if r["doc_id"] < 200:
                assert r["predicted"] == int(r["doc_id"] % 4 > 0)
    assert len({r["score"] for r in out if r["doc_id"] in (900, 901)}) == 1


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = corpus()
    flipped = [(i, q if zlib.crc32(str(i).encode()) % 5 else 1 - q, t) for i, q, t in labels]
    a, b = ({r["doc_id"]: r["score"] for r in Q.rank(*frames(spark, docs, x)).collect()} for x in (labels, flipped))
    assert a == b


def test_pairs_beat_a_plain_descent():
    rng = np.random.default_rng(5)
    good, bad = rng.normal(0.4, 1, (60, 4)), rng.normal(-0.4, 1, (25, 4))
    w = Q.bradley_terry(good, bad, pairs=8)

    def loss(v):
        total = 0.0
        for k in range(8):
            for i in range(60):
                total += np.log1p(np.exp(-(good[i] - bad[(i + k * (60 // 8 + 1)) % 25]) @ v))
        return total / 480 + Q.PENALTY / 2 * v @ v

    assert all(loss(w) <= loss(w + step) for step in rng.normal(0, 0.05, (50, 4)))
    assert ((good @ w)[:, None] > (bad @ w)[None]).mean() > 0.8


def test_quantile_of_counts():
    assert Q.quantile([(0, 5), (10, 5)], 0.5) == 10 * Q.BIN
    assert Q.quantile([(3, 1), (1, 1), (2, 2)], 0.25) == 2 * Q.BIN
    assert Q.quantile([(7, 4)], 1.0) == 8 * Q.BIN


def test_threshold_covers_rows_outside_the_sample(spark):
    docs, labels = corpus()
    d, lab = frames(spark, docs, labels)
    model = Q.train(Q.feature_rows(d), lab, good_rows=20, bad_rows=5)
    got = {r["doc_id"]: r["score"] for r in Q.score(Q.feature_rows(d), model).collect()}
    kept = [i for i in got if zlib.crc32(str(i).encode()) % 5]
    assert sum(got[i] < 0.3 for i in kept) == sum(i % 4 == 0 for i in kept)


def test_repeated_rows_train_once(spark):
    docs, labels = corpus()
    a, b = (Q.train(Q.feature_rows(spark.createDataFrame(x, DOCS)), spark.createDataFrame(labels, LABELS))
            for x in (docs, docs + [docs[3]] * 200))
    assert np.allclose(a.weight, b.weight) and a.cut == b.cut


def test_one_label_only_and_empty(spark):
    d, _ = frames(spark, *corpus())
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in Q.rank(d, none).collect()} == {0.0}
    good = spark.createDataFrame([(i, 1, 0) for i in range(20)], LABELS)
    assert {r["score"] for r in Q.rank(d, good).collect()} == {1.0}
    assert Q.rank(d.limit(0), good).count() == 0
