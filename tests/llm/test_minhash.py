"""Near duplicates: signatures estimate weighted Jaccard, classes equal a brute force over all pairs."""
import random
from collections import Counter

import numpy as np

from gridtel.llm import minhash as M
from gridtel.llm.common import words_of
from gridtel.llm.components import components


def bag(text):
    w = words_of(text)
    return Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else Counter()


def jaccard(a, b):
    total = sum(a.values()) + sum(b.values())
    shared = sum((a & b).values())
    return shared / (total - shared) if total else 0.0


def brute(docs):
    texts = sorted({t or "" for _, t in docs})
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    bags = {t: bag(t) for t in texts}
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if jaccard(bags[a], bags[b]) >= 0.8:
                parent[find(a)] = find(b)
    low, size = {}, Counter()
    for i, t in docs:
        c = find(t or "")
        low[c] = min(low.get(c, i), i)
        size[c] += 1
    return {(i, low[find(t or "")], size[find(t or "")]) for i, t in docs}


def corpus(seed=1):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocab) for _ in range(60)]
    docs = []
    for g in range(30):
        words = [rnd.choice(vocab) for _ in range(rnd.choice([3, 8, 40, 120]))]
        if g % 3 == 0:
            words += passage
        for _ in range(rnd.choice([1, 2, 5, 25])):
            copy = list(words)
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            docs.append(" ".join(copy))
    docs += ["", None, "!!", "one two", "one two", "ONE two.", "a b " * 40, "a b " * 48, "a b " * 70]
    return list(enumerate(docs))


def test_signature_estimates_weighted_jaccard():
    rng = np.random.default_rng(0)
    hashes = M.mix(np.arange(1, 400, dtype=np.uint64))
    a = (hashes[:300], rng.integers(1, 9, 300))
    b = (hashes[60:360], np.concatenate([a[1][60:] + rng.integers(-0, 3, 240), rng.integers(1, 9, 60)]))
    sig = M.signatures([a, b], 4000)
    assert abs((sig[0] == sig[1]).mean() - M.overlap(a, b)) < 0.03


def test_signature_does_not_depend_on_the_batch():
    bags = [M.shingles(t) for _, t in corpus()]
    together = M.signatures(bags, 96)
    for i in (0, 7, 40, len(bags) - 1):
        assert np.array_equal(M.signatures([bags[i]], 96)[0], together[i])


def test_overlap():
    texts = [t for _, t in corpus()][:40]
    for a in texts[:12]:
        for b in texts:
            assert abs(M.overlap(M.shingles(a), M.shingles(b)) - jaccard(bag(a), bag(b))) < 1e-12


def test_classes_against_brute_force(spark):
    for seed in (1, 2):
        docs = corpus(seed)
        df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, node string, class int")
        out = M.classes(df).collect()
        assert {(r["doc_id"], r["class_id"], r["class_size"]) for r in out} == brute(docs)
        assert sum(r["kept"] for r in out) == len({r["class_id"] for r in out})


def test_star_misses_are_found(spark):
    """A chain whose ends are far apart: only neighbours are similar."""
    words = [f"v{i}" for i in range(200)]
    docs, cur = [], list(words)
    for i in range(12):
        docs.append((i, " ".join(cur)))
        for k in range(3):
            cur[(i * 17 + k) % 200] = f"n{i}_{k}"
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {(r["doc_id"], r["class_id"], r["class_size"]) for r in M.classes(df).collect()} == brute(docs)


def test_keep_one(spark):
    docs = corpus(3)
    df = spark.createDataFrame([(*d, "en") for d in docs], "doc_id long, text string, lang string")
    out = M.keep_one(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted({c for _, c, _ in brute(docs)})


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (None, None)], "doc_id long, text string")
    out = {(r["doc_id"], r["class_id"], r["class_size"]) for r in M.classes(df).collect()}
    assert out == {(None, 4, 3), (4, 4, 3), (None, None, 1)}
    assert M.classes(df.limit(0)).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["class"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_links_are_written_in_few_files(spark):
    text = " ".join(f"w{i}" for i in range(30))
    texts = spark.createDataFrame([(i, text if i % 2 else text + " more") for i in range(20)], "node long, text string")
    pairs = spark.createDataFrame([(i, 0) for i in range(1, 20)], "a long, b long").repartition(40, "a")
    links = M._verify(pairs, texts, 0.8)
    assert links.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(links.collect()) == [(i, 0) for i in range(1, 20)]
