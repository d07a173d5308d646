"""Runs of words against all pairs of start and period, the grammar's own properties, and whole rows."""
import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gridtel.llm import word_runs as R


def brute_runs(w):
    """For every period all maximal stretches; the smallest period of a stretch keeps it."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(w)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + m for s, m, q in runs)]
    return (doc_id, n, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            "".join(f"{s},{m},{q}\n" for s, m, q in runs), " ".join(kept))


words = st.one_of(
    st.lists(st.integers(0, 1), max_size=90), st.lists(st.integers(0, 3), max_size=120),
    st.builds(lambda unit, k, tail, head: head + unit * k + tail, st.lists(st.integers(0, 2), min_size=1, max_size=9),
              st.integers(1, 20), st.lists(st.integers(0, 2), max_size=15), st.lists(st.integers(0, 2), max_size=15)),
    st.builds(lambda unit, k, m: (unit * k + [9]) * m, st.lists(st.integers(0, 2), min_size=1, max_size=5), st.integers(1, 8),
              st.integers(1, 5)))


@settings(max_examples=500, deadline=None)
@given(st.lists(words, max_size=4))
def test_against_brute_force(texts):
    got = R.runs_of([np.array(t, np.int64) for t in texts])
    assert got == [sorted(brute_runs(t), key=lambda r: (r[0], r[2])) for t in texts]


def test_known_sequences():
    fib = ["a", "ab"]
    while len(fib[-1]) < 500:
        fib.append(fib[-1] + fib[-2])
    thue = "a"
    while len(thue) < 500:
        thue += thue.translate(str.maketrans("ab", "ba"))
    rnd = random.Random(3)
    prose = [rnd.randrange(40) for _ in range(300)]
    texts = [[ord(c) for c in fib[-1]], [ord(c) for c in thue], [1] * 700, prose + prose + prose[:50], prose * 2 + [99] + prose,
             list(range(400)), [1, 2] * 6, [1, 2] * 5 + [1], [7] * 11]
    got = R.runs_of([np.array(t, np.int64) for t in texts])
    assert got == [sorted(brute_runs(t), key=lambda r: (r[0], r[2])) for t in texts]
    assert got[2] == [(0, 700, 1)] and got[6] == [(0, 12, 2)] and not got[5] and not got[7] and not got[8]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=60), min_size=1, max_size=4))
def test_grammar(texts):
    ids = np.array(sum(([*t, -1] for t in texts), []), np.int64)
    g = R.Grammar(ids)
    rule, at = (np.concatenate(x) if x else np.zeros(0, int) for x in (g._rule, g._at))
    expansion = {}
    for r, a in zip(rule.tolist(), at.tolist()):
        text = tuple(ids[a:a + g.size[r]])
        assert -1 not in text and expansion.setdefault(r, text) == text and 0 < g.left[r] < g.size[r]
    begin = 0
    for t in texts:   # a whole text is the expansion of one symbol
        assert len(t) == 1 or any(a == begin and g.size[r] == len(t) for r, a in zip(rule.tolist(), at.tolist()))
        begin += len(t) + 1


def test_a_repetitive_text_has_a_small_grammar():
    g = R.Grammar(np.array(list(range(50)) * 400 + [-1], np.int64))
    assert len(g.size) < 150


def test_rows(spark):
    rnd = random.Random(8)
    vocabulary = ["ab", "cd", "é", "東京", "x y", "z", "."]

    def prose(n):
        return " ".join(rnd.choice(vocabulary) for _ in range(n))

    texts = [None, "", " \n\t\x0b\x0c\r", "one", "one two " * 7, prose(90), prose(3) + "\n" + "la " * 40 + prose(9), (prose(20) + "\n") * 4,
             prose(30), "w " * 300]
    docs = [(100 * k + i, t) for k in range(6) for i, t in enumerate(texts)] + [(5, "ha " * 30), (5, "ha " * 30), (None, "ho " * 30)]
    df = spark.createDataFrame([(*d, 1, "clash") for d in docs], "doc_id long, text string, start int, collapsed string")
    got = [tuple(r) for r in R.detect(df).collect()]
    assert sorted(got, key=str) == sorted((brute_row(*d) for d in docs), key=str)
    assert R.detect(df.limit(0)).count() == 0


def test_a_very_long_text(spark):
    unit = [f"w{i}" for i in range(700)]
    text = " ".join(unit * 250)   # 175,000 words
    row = R.detect(spark.createDataFrame([(1, text), (2, "q " * 200_000)], "doc_id long, text string"), loops=False).collect()
    assert tuple(row[0])[1:7] == (175_000, 1, 0, 175_000, 700, 250_000) and row[0].collapsed == " ".join(unit)
    assert tuple(row[1])[1:7] == (200_000, 1, 0, 200_000, 1, 200_000_000) and row[1].collapsed == "q"


def test_query_on_the_documents(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    out = {r["doc_id"]: r for r in E.queries()["op13_word_runs"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(out) == len(docs)
    for r in docs:
        if len(r["text"]) < 6000:
            want, got = brute_row(r["doc_id"], r["text"]), out[r["doc_id"]]
            assert (got.n_runs, got.start, got.length, got.period, got.exponent_milli) == want[2:7]
            assert got.runs_sha256 == hashlib.sha256(want[7].encode()).hexdigest()
            assert got.collapsed_sha256 == hashlib.sha256(want[8].encode()).hexdigest()
