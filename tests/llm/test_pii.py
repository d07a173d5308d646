"""Personal data: the rules against the plain patterns, bootstrapping on planted contexts."""
import hashlib
import random
import re

from gridtel.llm import pii as P

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def valid(kind, s):
    digits = [int(c) for c in s if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        odd = digits[::-1]
        return 12 <= len(digits) <= 19 and (sum(odd[::2]) + sum(sum(divmod(2 * d, 10)) for d in odd[1::2])) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    out = [(m.start(), i, kind, m.end()) for i, (kind, p) in enumerate(PLAIN.items()) for m in p.finditer(text) if valid(kind, m.group())]
    return sorted(out)


def test_rules_on_random_texts():
    rnd = random.Random(2)
    bits = ["a", "b.c", "@", "@x", ".com", "1", "255", "256", ".", "-", " ", "+", "(", ")", "4111 1111 1111 1111", "+1 (555) 010-9999",
            "é", "%", "_", "9" * 13, "1.2.3.4", "a@b.c"]
    for _ in range(4000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randrange(14)))
        got = sorted((a, P.RANK[k], k, b) for k, a, b in P.rule_spans(text))
        assert got == plain(text), text


def test_long_runs_stay_linear():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "a@" * 50_000, "+1" + "(" * 100_000, "1 " * 100_000):
        P.rule_spans(text)
        P.identifier_tokens(text[:20_000], [])


def test_query_against_plain_rules(spark):
    import __spark_entry__ as E
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    got = {r["doc_id"]: r for r in E.queries()["op6_pii"](spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(docs)
    for d in docs:
        base, r = plain(d["text"] or ""), got[d["doc_id"]]
        joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(x[2] == k for x in base) for k in PLAIN]
        assert set(joined.split(",")) <= set(r["spans"].split(",")) | {""}


def test_bootstrapping_discovers_unseen_identifiers(spark):
    rows = [(i, f"please mail person{i}@host{i}.example.org soon") for i in range(20)]
    rows += [(100, "please mail person99@localhost soon"), (101, "build 12345-b was fine"), (102, None), (102, None), (None, "")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, tokens string")
    out = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in P.scan(docs).collect()}
    assert out[100] == [("context", 12, 30)]
    assert out[101] == [] and out[102] == [] and out[None] == []
    assert P.scan(docs).count() == len(rows)


def test_scores_by_hand(spark):
    edges = [("good", f"s{i}", 1) for i in range(18)] + [("good", "new", 0), ("weak", "new", 0), ("weak", "s1", 1), ("few", "s2", 1)]
    got = {r["pattern"]: r["confidence"] for r in P.pattern_scores(
        spark.createDataFrame(edges, "pattern string, instance string, seed int"), rounds=2).collect()}
    first = 18 / (19 + P.SMOOTHING)
    assert set(got) == {"good"} and abs(got["good"] - (18 + first) / (19 + P.SMOOTHING)) < 1e-9


def test_discovered_instances_support_other_patterns(spark):
    edges = [("good", f"s{i}", 1) for i in range(60)] + [("good", f"n{i}", 0) for i in range(10)]
    edges += [("next", f"n{i}", 0) for i in range(10)] + [("next", f"s{i}", 1) for i in range(4)] + [("next", "last", 0)]
    got = {r["pattern"] for r in P.pattern_scores(
        spark.createDataFrame(edges, "pattern string, instance string, seed int"), confidence=0.75).collect()}
    assert got == {"good", "next"}


def test_long_shapes_and_words_stay_apart():
    a, b = "1a" * 20 + "-x", "1a" * 20 + "_x"
    assert P.shape(a) != P.shape(b) and P.shape(a) == P.shape("22bb" * 20 + "-yy")
    end = "k" * 60
    words = [P._WordBefore(f"{start}{end}: 12345")(len(start) + 62) for start in ("one", "two", "(ONE")]
    assert words[0] == words[2] != words[1] and words[0][1] == 0
    text = "x " + "ab1," * 40 + " z"
    carried, ends = P._WordBefore(text), range(60, 160, 7)
    assert [carried(e) for e in ends] == [P._WordBefore(text)(e) for e in ends] and carried(150)[1] == 2


def test_many_places_in_one_word_stay_linear():
    text = "a@b.c," * 30_000
    assert len(P.identifier_tokens(text, P.rule_spans(text))) >= 30_000


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert P.digests(P.scan(docs)).count() == 0
