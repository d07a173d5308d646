"""Fill-in-middle: skip list against prefix sums, rows against a plain restatement of the rule, exact round trip."""
import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridtel.llm import fill_in_middle as M


def brute(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    if text == "" or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:i], units[i:j], units[j:]))
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=400))
def test_every_rank(widths):
    units = M.SkipList(np.array(widths, np.int64))
    assert [units.offset(r) for r in range(len(widths) + 1)] == [0, *np.cumsum(widths).tolist()]
    with pytest.raises(IndexError):
        units.offset(len(widths) + 1)


def test_descent_is_short():
    units = M.SkipList(np.ones(200_000, np.int64))
    assert len(units.lanes) < 16
    gaps = [np.diff(below).max() for _, _, below in units.lanes[1:] if len(below) > 1]
    assert max(gaps) < 100 and units.offset(123_457) == 123_457


@settings(max_examples=200, deadline=None)
@given(st.integers(-5, 500), st.text(alphabet="aZ é\n<>PSM9😀", max_size=30))
def test_one_text(doc_id, text):
    assert (doc_id, *M.transform_one(doc_id, text)) == brute(doc_id, text)


def test_rows_and_round_trip(spark):
    texts = ["", None, "a", " ", "<", "<<P", "x<P>y", "<S", "<M>", "naïve Straße 東京 a1b2", "😀" * 7, "word " * 30_000,
             "z" * 200_000, "\n\t\x00", "P>ab<S<M"]
    docs = [(i * 37 + k, t) for i, t in enumerate(texts) for k in range(12)] + [(5, "same row"), (5, "same row"), (None, "no id")]
    df = spark.createDataFrame([(*d, "clash", 3) for d in docs], "doc_id long, text string, output string, n int")
    out = M.transform(df)
    got = [tuple(r) for r in out.collect()]
    assert sorted(got, key=str) == sorted((brute(*d) for d in docs), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    back = out.select("doc_id", M.restored(out.output, out.form)).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((i, t or "") for i, t in docs), key=str)
    assert M.transform(df.limit(0)).count() == 0
