"""Licence scan: base places by brute force, notices by example; SQL compares the whole result."""
import re

from gridtel.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    w = WORD.findall((text or "").translate(LOWER))
    places = [(i, label) for label, phrase in L.BASE_PHRASES for p in [phrase.split()]
              for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    at = [i for i, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({b for _, b in places}))


TEXTS = ["This work is licensed under the GNU General Public License, version 3.", "MIT License. MIT license", "mit Lizenz",
         "Licensed under CC BY-NC 4.0.", "cc by cc by", "apache-license apache\nLICENSE", "license", "gnu general public", "",
         None, "mit lİcense", "mit licenſe apache-license", "Kind mit license", "x " * 50 + "released under the mit license"]


def test_base_places(spark):
    rows = [(i, t, "clash", 3) for i, t in enumerate(TEXTS)] + [(1, TEXTS[1], "clash", 3), (None, "cc by", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string, score int")
    out = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in L.scan(docs).collect()]
    assert sorted(out, key=str) == sorted([(i, *base(t)) for i, t, _, _ in rows], key=str)


def test_notices(spark):
    texts = [n.upper() if i % 2 else n for i, (_, n, _) in enumerate(L.NOTICES)] + ["plain prose of any kind"] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r for r in L.scan(docs).collect()}
    for i, (label, _, _) in enumerate(L.NOTICES):
        assert label in out[i]["labels"].split(",") and out[i]["score"] > 0.99
    assert out[len(texts) - 1]["labels"] == "" and out[len(texts) - 1]["score"] == 0


def test_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, "MIT licence " * 100_000 + "MIT License"), (2, "mit license " * 20_000)], "doc_id long, text string")
    out = {r["doc_id"]: r for r in L.scan(docs).collect()}
    assert (out[1]["n_base"], out[1]["first_word"]) == (1, 200_000) and (out[2]["n_base"], out[2]["last_word"]) == (20_000, 39_998)


def test_no_python_in_the_plan_and_empty_table(spark, capsys):
    docs = spark.sql("SELECT 1L AS doc_id, 'cc by' AS text")
    L.scan(docs).explain("formatted")
    L.index(docs).explain("formatted")
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
    assert L.scan(docs.limit(0)).count() == 0
