"""Personal data: exact rules for four kinds, and identifiers found by bootstrapped lexical patterns.

``findings`` reads every whole text once: the rule spans, and every other identifier-like token (holding a digit or an
at sign) with the words around it.  Rule spans are the seeds.  A pattern is a word to the left of an identifier
together with the identifier's shape, or the two words to its left alone.  Spark scores the graph of patterns and
instances in rounds: a pattern is worth the smoothed mean of its instances' scores, an instance the noisy-or of
its patterns (seeds stay at 1).  Patterns that reach ``CONFIDENCE`` on at least ``SUPPORT`` different instances, seeds
or discovered with ``CONFIDENCE`` in the round before, discover the tokens beside them, as kind ``context``.

Cases: a null text counts as empty; repeated rows are read each on their own; with no seeds nothing is discovered;
an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, small_batches, spans_text, stored, touches, united

KINDS = ("email", "ip", "card", "phone", "context")
RANK = {k: i for i, k in enumerate(KINDS)}
SPAN = "struct<kind:string,start:long,end:long>"
FINDINGS = (f"doc_id long, base array<{SPAN}>, "
            "tokens array<struct<start:long,end:long,instance:string,seed:int,patterns:array<string>>>")
ROUNDS = 3
CONFIDENCE = 0.8
SUPPORT = 5       # different instances, seeds or discovered with CONFIDENCE, that a pattern needs
SMOOTHING = 2.0   # instances of no worth that every pattern starts with

# The rules' patterns.  A run of digits is tried from its start only, which is where a match must begin.
LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]*\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

TOKEN = re.compile(r"\S+")
MARK = re.compile(r"[0-9@]")
EDGES = ".,;:!?()[]{}<>\"'"
LONG_SHAPE, LONG_WORD = 24, 40  # from here on a hash of the whole stands behind a shape's start, a word's end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def email_spans(text: str) -> list[tuple[int, int]]:
    """Leftmost matches found from their at signs: the local part is the run of its characters before the sign."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    return out


def rule_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four rules: leftmost, non-overlapping within a kind, failing matches dropped."""
    out = [("email", a, b) for a, b in email_spans(text)]
    if MARK.search(text) is None:
        return out
    for m in IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


def shape(token: str) -> str:
    """Digits as 9, letters as a, runs squeezed; everything else as it is; a long one as its start and a hash of all."""
    out = []
    for c in token:
        s = "9" if c.isdigit() else "a" if c.isalpha() else c
        if not out or out[-1] != s:
            out.append(s)
    if len(out) <= LONG_SHAPE:
        return "".join(out)
    return "".join(out[:LONG_SHAPE]) + "#" + hashlib.blake2b("".join(out).encode(), digest_size=12).hexdigest()


class _WordBefore:
    """The whitespace-delimited word that ends before a place, lower-cased without edge marks, and its start.

    A long word is its end and a hash of all of it, carried on from the last place, so that ascending places in one
    very long word stay linear.
    """

    def __init__(self, text: str):
        self.text, self.start, self.done, self.hash = text, 0, -1, None

    def __call__(self, end: int) -> tuple[str, int]:
        text = self.text
        while end > 0 and text[end - 1].isspace():
            end -= 1
        start = end
        while start > 0 and end - start < LONG_WORD and not text[start - 1].isspace():
            start -= 1
        if start == 0 or text[start - 1].isspace():
            return text[start:end].strip(EDGES).lower(), start
        tail = end
        while end > start and text[end - 1] in EDGES:
            end -= 1
        known = self.done if 0 <= self.done <= end else 0
        place = min(start, end)
        while place > known and not text[place - 1].isspace():
            place -= 1
        if place > known or known == 0 or text[known - 1].isspace():
            self.start = self.done = place
            while self.done < end and text[self.done] in EDGES:
                self.done += 1
            self.hash = hashlib.blake2b(digest_size=12)
        self.hash.update(text[self.done:end].casefold().encode("utf-8", "surrogatepass"))
        self.done = max(end, self.done)
        return f"{text[start:tail].strip(EDGES).lower()}#{self.hash.hexdigest()}", self.start


def lexical_patterns(left_of: _WordBefore, before_of: _WordBefore, start: int, instance: str) -> list[str]:
    left, at = left_of(start)
    if not left:
        return []
    before, _ = before_of(at)
    out = [f"w|{left}|{shape(instance)}"]
    if before:
        out.append(f"ww|{before}|{left}")
    return out


def identifier_tokens(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    """Rule spans as seeds, and other tokens of 5 or more characters with a digit or an at sign as candidates."""
    out = []
    words = _WordBefore(text), _WordBefore(text)
    for _, a, b in spans:
        instance = text[a:b].lower()
        out.append({"start": a, "end": b, "instance": instance, "seed": 1, "patterns": lexical_patterns(*words, a, instance)})
    taken = united([(a, b) for _, a, b in spans])
    done = 0
    for mark in MARK.finditer(text):
        if mark.start() < done:
            continue
        a = mark.start()
        while a > done and not text[a - 1].isspace():
            a -= 1
        b = TOKEN.match(text, a).end()
        done = b
        while a < b and text[a] in EDGES:
            a += 1
        while b > a and text[b - 1] in EDGES:
            b -= 1
        if b - a >= 5 and not touches(taken, a, b):
            instance = text[a:b].lower()
            patterns = lexical_patterns(*words, a, instance)
            if patterns:
                out.append({"start": a, "end": b, "instance": instance, "seed": 0, "patterns": patterns})
    return out


def findings(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    token_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("instance", pa.string()),
                                     ("seed", pa.int32()), ("patterns", pa.list_(pa.string()))]))

    def run(batches):
        for batch in batches:
            base, tokens = [], []
            for text in batch["text"].to_pylist():
                spans = rule_spans(text)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                tokens.append(identifier_tokens(text, spans))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(base, span_type), pa.array(tokens, token_type)],
                                             ["doc_id", "base", "tokens"])

    return documents(docs).mapInArrow(run, FINDINGS)


def pattern_scores(edges: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT) -> DataFrame:
    """(pattern, confidence) of the trusted patterns after ``rounds`` rounds on the graph (pattern, instance, seed).

    Scores are summed before the shuffle, so a pattern or instance with very many edges stays cheap.
    """
    graph = stored(edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-graph")
    scores = graph.groupBy("instance").agg(F.max("seed").cast("double").alias("score"))
    trusted = None
    for _ in range(rounds):
        on_pattern = graph.join(scores, "instance").groupBy("pattern").agg(
            F.sum("score").alias("worth"), F.count("*").alias("n"),
            F.sum((F.col("score") >= confidence).cast("long")).alias("support"))
        trusted = stored(on_pattern.select("pattern", "support", (F.col("worth") / (F.col("n") + SMOOTHING)).alias("confidence"))
                         .where((F.col("support") >= support) & (F.col("confidence") >= confidence)), "pii-patterns")
        scores = graph.join(trusted, "pattern", "left").groupBy("instance").agg(
            F.when(F.max("seed") > 0, F.lit(1.0)).otherwise(
                1 - F.exp(F.sum(F.log1p(-F.least(F.coalesce("confidence", F.lit(0.0)), F.lit(0.999999)))))).alias("score"))
    return trusted.select("pattern", "confidence")


def scan(docs: DataFrame, **scoring) -> DataFrame:
    """Per document all spans (kind, start, end): the rules' and the discovered ones."""
    found = stored(findings(docs).withColumn("row", F.monotonically_increasing_id()), "pii-findings")
    places = found.select("row", F.posexplode("tokens").alias("at", "t"))
    edges = places.select(F.explode("t.patterns").alias("pattern"), F.col("t.instance").alias("instance"),
                          F.col("t.seed").alias("seed"))
    trusted = pattern_scores(edges, **scoring)
    open_places = places.where("t.seed = 0").select("row", "at", "t.start", "t.end", F.explode("t.patterns").alias("pattern"))
    new = open_places.join(trusted, "pattern").groupBy("row", "at").agg(F.first("start").alias("start"), F.first("end").alias("end")) \
        .groupBy("row").agg(F.collect_list(F.struct(F.lit("context").alias("kind"), "start", "end")).alias("more"))
    return found.select("row", "doc_id", "base").join(new, "row", "left").select(
        "doc_id", F.concat("base", F.coalesce("more", F.array().cast(f"array<{SPAN}>"))).alias("spans"))


def digests(scanned: DataFrame) -> DataFrame:
    """The per-document summary of ``scan``: counts per rule kind, a digest of the rule spans, all spans as text."""
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_context"]
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, spans in zip(batch["doc_id"].to_pylist(), batch["spans"].to_pylist()):
                found = [(s["start"], RANK[s["kind"]], s["kind"], s["end"]) for s in spans]
                count = [sum(s[2] == k for s in found) for k in KINDS]
                base = spans_text([s for s in found if s[2] != "context"])
                rows.append((doc_id, *count[:4], hashlib.sha256(base.encode()).hexdigest(), spans_text(found), count[4]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 8, types)], names)

    return scanned.select("doc_id", "spans").mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_context long")
