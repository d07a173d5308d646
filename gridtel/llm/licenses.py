"""Licence scan by a positional index of rare licence words, in DataFrame functions only.

One pass over the texts keeps, per document, the positions of licence words (the index).  Their document
frequencies over the whole corpus give each word's IDF.  The highest-IDF words of a template are its anchors, and only
a file's anchor words are looked up in the postings.  Every (word position - template position) is an alignment of
the file with a template; alignments on which at least two anchors agree are candidates.  Only these are verified
against the places of all licence words in their file: the template's key phrase must stand there word for word, and the score
is the IDF-weighted share of the template's words found in place.

Base phrases are templates whose every word is mandatory.  Their places are counted; a label of the other templates
needs a score of ``ACCEPT`` as well.  A document's score is the best one over its candidates whose key phrase stands.

Cases: a null text counts as empty; repeated rows are scanned each on their own; a document without licence words
has no labels and score 0; a text of any length is one row with the places of its licence words; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import math
import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_PATTERN, documents, stored

# Phrases whose every place counts, with their labels.
BASE_PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

# Usual wording of licence notices (label, notice, key phrase in it).
NOTICES = (
    ("agpl", "licensed under the gnu affero general public license version 3", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", "without modification are permitted"),
    ("cc-by", "licensed under cc by 4 0", "cc by"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("epl", "made available under the terms of the eclipse public license 2 0", "eclipse public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("isc", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby "
            "granted", "without fee"),
    ("lgpl", "licensed under the gnu lesser general public license version 3", "gnu lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files", "hereby granted free"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
     "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released"),
)

# Words too common to index; they carry no weight in a template.
STOP = ("a", "and", "for", "in", "into", "is", "of", "or", "that", "the", "this", "to", "with", "0", "2", "3", "4", "v")

ANCHORS = 3
ACCEPT = 0.5
DIGITS = 6


def templates() -> list[dict]:
    """Templates with their indexed words: (position, word, whether the key phrase holds it)."""
    out = []
    for label, phrase in BASE_PHRASES:
        out.append({"label": label, "base": True, "words": [(q, w, True) for q, w in enumerate(phrase.split())]})
    for label, notice, key in NOTICES:
        words, phrase = notice.split(), key.split()
        at = next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)
        inside = range(at, at + len(phrase))
        out.append({"label": label, "base": False,
                    "words": [(q, w, q in inside) for q, w in enumerate(words) if q in inside or w not in STOP]})
    return out


def vocabulary() -> list[str]:
    return sorted({w for t in templates() for _, w, _ in t["words"]})


def index(docs: DataFrame) -> DataFrame:
    """Per document a row number, its words and the places of licence words in it."""
    # lower() would also change letters beyond ASCII, U+212A even into an ASCII one
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    words = documents(docs).select("doc_id", F.regexp_extract_all(lowered, F.lit(WORD_PATTERN), F.lit(0)).alias("words"))
    placed = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
                      lambda h: h["word"].isin(vocabulary()))
    return words.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                        F.size("words").cast("long").alias("n_words"), placed.alias("places"))


def idf(indexed: DataFrame) -> dict[str, float]:
    """IDF of every licence word over all documents; as many numbers as the templates have words."""
    n = indexed.count()
    seen = (indexed.select(F.explode(F.array_distinct(F.transform("places", lambda h: h["word"]))).alias("word"))
            .groupBy("word").count().collect())
    df = {r["word"]: r["count"] for r in seen}
    return {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for w in vocabulary()}


def weighted_templates(weight: dict[str, float]) -> list[dict]:
    """Templates with each word's share of the weight and whether it is an anchor."""
    out = []
    for t, template in enumerate(templates()):
        words = template["words"]
        rare = set(sorted({w for _, w, _ in words}, key=lambda w: (-weight[w], w))[:ANCHORS])
        total = sum(weight[w] for _, w, _ in words)
        out.append({**template, "template": t, "head": words[0][0], "needed": min(2, sum(w in rare for _, w, _ in words)),
                    "words": [(q, w, k, w in rare, weight[w] / total) for q, w, k in words]})
    return out


def postings(spark: SparkSession, weighted: list[dict]) -> DataFrame:
    """The index of the templates: anchor word -> template and position."""
    values = ", ".join(f"('{w}', {t['template']}, {q}, {t['needed']})"
                       for t in weighted for q, w, _, anchor, _ in t["words"] if anchor)
    return spark.sql(f"SELECT * FROM VALUES {values} AS p(word, template, position, needed)")


def template_table(spark: SparkSession, weighted: list[dict]) -> DataFrame:
    """Per template its label, role and words by position, for the verification."""
    values = ", ".join(
        f"({t['template']}, '{t['label']}', {str(t['base']).lower()}, {t['head']}, array(" +
        ", ".join(f"named_struct('position', {q}, 'word', '{w}', 'share', {share!r}D, 'key', {str(key).lower()})"
                  for q, w, key, _, share in t["words"]) + "))" for t in weighted)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(template, label, base, head, wording)")


def candidates(indexed: DataFrame, weighted: list[dict]) -> DataFrame:
    """(row, origins): per document the (template, origin) alignments on which enough anchor words agree."""
    rare = sorted({w for t in weighted for _, w, _, anchor, _ in t["words"] if anchor})
    places = indexed.select("row", F.explode(F.filter("places", lambda h: h["word"].isin(rare))).alias("p")) \
        .select("row", F.col("p.word").alias("word"), F.col("p.at").alias("at"))
    # the postings are as many rows as the templates have anchors: a fixed size
    return places.join(F.broadcast(postings(indexed.sparkSession, weighted)), "word") \
        .groupBy("row", "template", (F.col("at") - F.col("position")).alias("origin")) \
        .agg(F.count(F.lit(1)).alias("anchors"), F.first("needed").alias("needed")) \
        .where(F.col("anchors") >= F.col("needed")).select("row", "template", "origin")


def alignments(indexed: DataFrame, weight: dict[str, float]) -> DataFrame:
    """Verified places of templates: row, template, label, first word, score; the key phrase stands in all of them."""
    weighted = weighted_templates(weight)
    spark = indexed.sparkSession
    found = F.filter("wording", lambda w: F.element_at("at", w["position"] + F.col("origin")) == w["word"])
    keys = F.size(F.filter("wording", lambda w: w["key"]))
    # places as a map: one lookup per template word; the templates are a fixed number of rows
    where = indexed.select("row", F.map_from_entries(F.transform("places", lambda h: F.struct(h["at"], h["word"]))).alias("at"))
    return candidates(indexed, weighted).join(where, "row").join(F.broadcast(template_table(spark, weighted)), "template") \
        .select("row", "template", "label", "base", "origin", "head", keys.alias("keys"), found.alias("found")) \
        .where(F.size(F.filter("found", lambda w: w["key"])) == F.col("keys")) \
        .select("row", "template", "label", "base", (F.col("origin") + F.col("head")).alias("first_word"),
                F.aggregate("found", F.lit(0.0), lambda total, w: total + w["share"]).alias("score"))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    indexed = stored(index(docs), "licence-index")
    found = alignments(indexed, idf(indexed))
    base = F.col("base")
    accepted = base | (F.col("score") >= ACCEPT)
    per_row = found.groupBy("row").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(accepted, F.col("label")))), ",").alias("labels"),
        F.max(F.when(~base, F.col("score"))).alias("score"))
    return indexed.select("row", "doc_id", "n_words").join(per_row, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.least(F.round(F.coalesce("score", F.lit(0.0)), DIGITS), F.lit(1.0)).alias("score"))
