"""Decontamination against a brute force over all word windows."""
import hashlib
import random
import re

import pytest

from gridtel.llm import decontam as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, size=13):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        x = words(t)
        if not x:
            continue
        k = min(size, len(x))
        for wnd in {tuple(x[i:i + k]) for i in range(len(x) - k + 1)}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) == wnd:
                    hit.update(range(i, i + k))
                    if item is not None:
                        found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    at = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
    ends = [i for i in sorted(hit) if i + 1 not in hit]
    passages = ",".join(f"{at[a][0]}:{at[b][1]}" for a, b in zip([i for i in sorted(hit) if i - 1 not in hit], ends))
    return len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w), passages


def case(seed=7):
    rnd = random.Random(seed)
    vocab = ["a", "b", "C", "É", "d1", "x-y", "日本", "the"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 12, 13, 14, 20])))) for i in range(25)]
    items += [(3, "the THE the"), (50, None), (51, "!!"), (None, "a b"), (10, "a")]
    docs = []
    for i in range(60):
        parts = [rnd.choice(vocab) for _ in range(rnd.randrange(60))]
        if i % 2:
            parts[5:5] = [rnd.choice(items[:25])[1]]
        docs.append((i, rnd.choice([" ", ", ", "\n"]).join(parts)))
    return docs + [(100, None), (101, ""), (102, "   "), (1, docs[1][1]), (None, "the the the")], items


@pytest.mark.parametrize("block_windows", [20_000, 7])
def test_against_brute_force(spark, block_windows):
    docs, items = case()
    d = spark.createDataFrame([(*r, "clash", 1) for r in docs], "doc_id long, text string, n_words string, items int")
    b = spark.createDataFrame(items, "item_id long, text string")
    out = [tuple(r) for r in D.contamination(d, b, block_windows=block_windows).collect()]
    assert sorted(out, key=str) == sorted([(i, *brute(t, items)) for i, t in docs], key=str)


def test_items_without_an_id_hit_words(spark):
    d = spark.createDataFrame([(1, "alpha beta gamma delta")], "doc_id long, text string")
    b = spark.createDataFrame([(None, "beta gamma"), (7, "nowhere")], "item_id long, text string")
    got = D.contamination(d, b).collect()[0]
    assert (got.n_hit, got.n_items, got.contaminated, got.passages) == (2, 0, True, "6:16")


def test_a_very_long_text(spark):
    b = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    text = "gamma " * 200_000 + "alpha beta"
    got = D.contamination(spark.createDataFrame([(1, text)], "doc_id long, text string"), b).collect()[0]
    assert (got.n_words, got.n_hit, got.contaminated, got.passages) == (200_002, 2, False, "1200000:1200010")


def test_offsets_map_to_the_original(spark):
    b = spark.createDataFrame([(1, "alpha BETA gamma")], "item_id long, text string")
    text = "É! Alpha, beta\ngamma; rest"
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    hit = D.annotate(d, b, ["doc_id"]).collect()[0][D.HITS][0]
    assert text[hit["start"]:hit["end"]] == "Alpha, beta\ngamma"


def test_removal_keeps_columns_and_clean_rows(spark):
    b = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    d = spark.createDataFrame([(1, "alpha beta", "en"), (2, "clean", "de"), (2, "clean", "de"), (3, None, None)],
                              "doc_id long, text string, lang string")
    out = D.remove_contaminated(d, b)
    assert out.columns == d.columns and sorted(r["doc_id"] for r in out.collect()) == [2, 2, 3]


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "alpha")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(d, b).collect()[0]["contaminated"] is False
    assert D.contamination(d.limit(0), b).count() == 0
