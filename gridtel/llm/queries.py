"""Registered queries of the training-data operators, and their SQL where DuckDB can express it."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, decontam, exact_dedup, fill_in_middle, licenses, minhash, pii, quality_ranking, secret_scan, token_counts,
               toxicity, warc, word_runs)
from .common import table


def byte_bpe_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def stand_in_edits(docs: DataFrame) -> DataFrame:
    """Documents with two edits each, taken from hashes of the id: a cut with words of the document's own text put in its place."""
    length = F.length(F.coalesce("text", F.lit("")))

    def place(seed):
        return F.pmod(F.xxhash64("doc_id", F.lit(seed)), length + 1)

    def edit(seed):
        return F.struct(place(seed).cast("long").alias("pos"),
                        F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(12)).cast("long").alias("n_del"),
                        F.substring(F.coalesce("text", F.lit("")), (place(seed + 2) + 1).cast("int"), F.lit(16)).alias("ins"))

    return docs.select("doc_id", "text", F.array(edit(1), edit(11)).alias("edits"))


def op1_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after its edits, re-encoding only what the edits touch."""
    path = byte_bpe_path()
    trees = token_counts.token_trees(stand_in_edits(table(spark, sf_dir, "documents")), path)
    done = token_counts.apply_edits(trees, path)
    return done.select("doc_id", "n_tokens_before", "n_tokens", "n_edits", "n_pretokens", "n_reencoded",
                       F.sha2("text", 256).alias("text_sha256"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: exact rules, and a character network over the other candidates."""
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document, found by one automaton over all benchmark items."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in every document, by a positional rare-word index."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document, by BagMinHash signatures and verified multiset overlap."""
    return minhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: exact rules, and identifiers found by bootstrapped patterns."""
    return pii.digests(pii.scan(table(spark, sf_dir, "documents")))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents, by a content sort."""
    return exact_dedup.copies(table(spark, sf_dir, "documents"))


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives with revisits for repeated payloads, and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and the text decoded from them."""
    both = bpe.round_trip(table(spark, sf_dir, "documents"), byte_bpe_path())
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by a classifier trained on the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, ranked by preference pairs of the labels outside the held-out fold."""
    return quality_ranking.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two ranks of its units and reordered, with the text rebuilt from the output."""
    out = fill_in_middle.transform(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, by a grammar of its repeated stretches."""
    return word_runs.detect(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", F.sha2("runs", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_edit_token_counts, op2_secret_scan, op3_decontamination, op4_license_scan, op5_near_duplicates, op6_pii,
    op7_exact_dedup, op8_warc_revisits, op9_bpe, op10_toxicity,
    op11_quality, op12_fill_in_middle, op13_word_runs)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD_CLASS = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"  # any case: a word keeps its place when A-Z are lower-cased
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _decontamination_sql() -> str:
    return f"""
WITH d AS (SELECT doc_id, text, row_number() OVER () AS r, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 13) AS k, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i, w FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g FROM bw),
sizes AS (SELECT DISTINCT k FROM win),
starts AS (SELECT r, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM d, sizes WHERE len(w) >= k),
grams AS (SELECT r, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g FROM starts),
hits AS (SELECT grams.r, grams.k, grams.i, win.item_id FROM grams JOIN win USING (k, g)),
places AS (SELECT DISTINCT r, unnest(range(i, i + k)) AS p FROM hits),
covered AS (SELECT r, count(*) AS n_hit FROM places GROUP BY r),
pieces AS (SELECT r, unnest(z) AS piece, unnest(range(1, len(z) + 1)) AS o FROM (
    SELECT r, regexp_extract_all(text, '{_WORD_CLASS}+|[^{_WORD_CLASS[1:-1]}]+') AS z FROM d SEMI JOIN covered USING (r))),
spots AS (SELECT r, sum(length(piece)) OVER w - length(piece) AS a, sum(length(piece)) OVER w AS b,
                 regexp_matches(piece, '^{_WORD_CLASS}') AS is_word, count(*) FILTER (is_word) OVER w AS p
          FROM pieces WINDOW w AS (PARTITION BY r ORDER BY o)),
joined AS (SELECT r, min(a) AS a, max(b) AS b FROM (
    SELECT r, a, b, p - row_number() OVER (PARTITION BY r ORDER BY p) AS island FROM spots JOIN places USING (r, p) WHERE is_word)
    GROUP BY r, island),
passages AS (SELECT r, string_agg(a || ':' || b, ',' ORDER BY a) AS passages FROM joined GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, coalesce(passages, '') AS passages
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r) LEFT JOIN passages USING (r)"""


def _license_sql() -> str:
    """The scan as joins of all words with all template words, from the same fixed lists."""
    def text(s):
        return "'" + s + "'"
    base = ", ".join(f"({i}, {text(label)}, true, {text(p)}, {text(p)})" for i, (label, p) in enumerate(licenses.BASE_PHRASES))
    notices = ", ".join(f"({100 + i}, {text(label)}, false, {text(n)}, {text(k)})"
                        for i, (label, n, k) in enumerate(licenses.NOTICES))
    stop = ", ".join(map(text, licenses.STOP))
    return f"""
WITH t0(t, label, base, notice, key) AS (VALUES {base}, {notices}),
t1 AS (SELECT *, string_split(notice, ' ') AS nw, string_split(key, ' ') AS kw FROM t0),
t2 AS (SELECT *, len(string_split(notice[1:instr(notice, key) - 1], ' ')) - 1 AS k0 FROM t1),
tw0 AS (SELECT t, label, base, unnest(nw) AS word, unnest(range(0, len(nw))) AS q, k0, len(kw) AS kn FROM t2),
tw AS (SELECT *, q >= k0 AND q < k0 + kn AS is_key FROM tw0
       WHERE (q >= k0 AND q < k0 + kn) OR word NOT IN ({stop})),
d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
u AS (SELECT r, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM d),
p AS (SELECT * FROM u WHERE word IN (SELECT word FROM tw)),
idf AS (SELECT word, ln((1 + (SELECT count(*) FROM d)) / (1 + coalesce(df, 0))) + 1 AS idf
        FROM (SELECT DISTINCT word FROM tw) LEFT JOIN (SELECT word, count(DISTINCT r) AS df FROM p GROUP BY word) USING (word)),
rare AS (SELECT t, word FROM (SELECT t, word, row_number() OVER (PARTITION BY t ORDER BY idf DESC, word) AS n
                              FROM (SELECT DISTINCT t, word FROM tw) JOIN idf USING (word)) WHERE n <= 3),
post AS (SELECT tw.*, idf.idf, rare.word IS NOT NULL AS anchor FROM tw JOIN idf USING (word)
         LEFT JOIN rare ON rare.t = tw.t AND rare.word = tw.word),
tot AS (SELECT t, sum(idf) AS total, min(q) AS head, least(2, count(*) FILTER (anchor)) AS needed FROM post GROUP BY t),
al AS (SELECT r, post.t, any_value(label) AS label, any_value(base) AS base, i - q AS origin, sum(idf) AS got,
              count(*) FILTER (anchor) AS anchors, count(*) FILTER (is_key) AS keys, any_value(kn) AS kn
       FROM p JOIN post USING (word) GROUP BY r, post.t, i - q),
ok AS (SELECT r, label, base, origin + head AS first, got / total AS score FROM al JOIN tot USING (t)
       WHERE keys = kn AND anchors >= needed),
s AS (SELECT r, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR score >= {licenses.ACCEPT}) AS labels,
             max(score) FILTER (NOT base) AS score FROM ok GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       least(round(coalesce(score, 0.0), {licenses.DIGITS}), 1.0) AS score
FROM d LEFT JOIN s USING (r)"""


ORACLE = {
    "op3_decontamination": _decontamination_sql(),
    "op4_license_scan": _license_sql(),
    "op7_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op8_warc_revisits": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
             min(page_id) OVER (PARTITION BY html) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> original THEN original END AS refers_to
FROM q""",
    "op12_fill_in_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS units, CAST('0x' || h[1:8] AS BIGINT) AS h1,
             CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3,
             CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS i, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS j,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(units[1:i], ''), '') AS pre, coalesce(array_to_string(units[i + 1:j], ''), '') AS mid,
             coalesce(array_to_string(units[j + 1:], ''), '') AS suf FROM c)
SELECT doc_id, CAST(len(units) AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p""",
}
