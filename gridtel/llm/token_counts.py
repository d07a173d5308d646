"""Edit-aware token counts: a segment tree over each document's pre-tokens.

``token_trees`` cuts every document into pre-tokens once and keeps their lengths and token counts.  ``apply_edits``
rebuilds the tree from these stored arrays (no text is encoded again), and for each edit re-reads only the touched
region: it starts at the pre-token three characters before the edit, because a pre-token's end depends on at most
two characters behind it, and stops at the first cut behind the edit that was a cut before.  From there the old
pre-tokens hold, and the sums on the path to the root are updated.

Edits of one document apply in order: ``pos`` counts characters of the text as the edits before it left it,
``n_del`` characters go, ``ins`` comes in their place.  A position beyond an end means that end; a null position
means the end of the text, a null count none, a null string the empty one; a null edit does nothing.

Cases: a null text counts as empty (no tokens, edits still apply); repeated rows are counted each on their own;
an empty table gives an empty result; the string of a special token is ordinary text; other columns are ignored.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import PieceSplitter, vocabulary
from .common import small_batches

TREES = "doc_id long, text string, lens binary, counts binary, n_tokens long"
EDITED = TREES + ", n_tokens_before long, n_edits long, n_pretokens long, n_reencoded long"
EDIT_TYPE = "array<struct<pos:long,n_del:long,ins:string>>"
BUCKET = 64             # pre-tokens in a leaf of the tree
CONTEXT = 3             # characters before an edit that may change their pre-token
CACHE_PIECES = 300_000  # counted pre-tokens kept per generation of a worker's cache


class PieceCounts(dict):
    """pre-token -> number of tokens; two generations bound the memory."""

    def __init__(self, vocab_json: str, limit: int = CACHE_PIECES):
        super().__init__()
        from tokenizers import Tokenizer
        self.split = PieceSplitter(vocab_json)
        self._model = Tokenizer.from_str(vocab_json)
        self._model.encode_special_tokens = True
        self._limit, self._older = limit, {}

    def __missing__(self, piece: str) -> int:
        n = self._older.get(piece)
        if n is None:
            n = len(self._model.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= 64:
            if len(self) >= self._limit:
                self._older = dict(self)
                self.clear()
            self[piece] = n
        return n


_COUNTERS: dict[str, PieceCounts] = {}


def counter_for(vocab_json: str) -> PieceCounts:
    key = hashlib.sha256(vocab_json.encode("utf-8")).hexdigest()
    if key not in _COUNTERS:
        _COUNTERS[key] = PieceCounts(vocab_json)
    return _COUNTERS[key]


class TokenTree:
    """Buckets of pre-tokens as leaves; each inner node sums the characters and tokens below it."""

    def __init__(self, text: str, lens: np.ndarray, counts: np.ndarray, counter: PieceCounts):
        self.counter = counter
        self._load(text, lens, counts)

    def _load(self, text: str, lens: np.ndarray, counts: np.ndarray) -> None:
        self._text, self._lens, self._counts = text, np.asarray(lens, "<u4"), np.asarray(counts, "<u4")
        edges = np.arange(0, max(len(self._lens), 1), BUCKET)
        chars = np.add.reduceat(self._lens, edges, dtype=np.int64) if len(lens) else np.zeros(1, np.int64)
        tokens = np.add.reduceat(self._counts, edges, dtype=np.int64) if len(lens) else np.zeros(1, np.int64)
        self.buckets = len(edges)
        self._starts = [0, *np.cumsum(chars).tolist()]
        self._own: dict[int, tuple[str, list[int], list[int]]] = {}  # buckets that edits have changed
        self.width = 1 << (self.buckets - 1).bit_length()
        room = [0] * (self.width - self.buckets)
        self.chars, self.tokens = [0] * self.width + chars.tolist() + room, [0] * self.width + tokens.tolist() + room
        for node in range(self.width - 1, 0, -1):
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def _bucket(self, b: int) -> tuple[str, list[int], list[int]]:
        own = self._own.get(b)
        if own is None:
            part = slice(b * BUCKET, (b + 1) * BUCKET)
            own = self._text[self._starts[b]:self._starts[b + 1]], self._lens[part].tolist(), self._counts[part].tolist()
        return own

    def _set(self, bucket: int, text: str, lens: list[int], counts: list[int]) -> None:
        self._own[bucket] = text, lens, counts
        node = self.width + bucket
        d_chars, d_tokens = len(text) - self.chars[node], sum(counts) - self.tokens[node]
        while node:
            self.chars[node] += d_chars
            self.tokens[node] += d_tokens
            node >>= 1

    def _find(self, pos: int) -> tuple[int, int]:
        """Bucket that holds character ``pos`` (the last one for the end of the text) and the bucket's start."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if pos - start >= self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self.width, start

    def edit(self, pos: int, n_del: int, ins: str) -> int:
        """Apply one edit; returns how many pre-tokens were encoded again."""
        total = self.chars[1]
        pos = min(max(pos, 0), total)
        stop = min(pos + max(n_del, 0), total)
        near = max(pos - CONTEXT, 0)
        first, base = self._find(near)
        text, lens, counts = self._bucket(first)
        kept, start = 0, base
        for n in lens:
            if start + n > near:
                break
            start += n
            kept += 1
        last, end = first, base + len(text)
        old_text, olds, old_counts = text[start - base:], lens[kept:], counts[kept:]
        delta, edit_end = len(ins) - (stop - pos), pos - start + len(ins)
        while True:
            at_end = end >= total
            if end >= stop:
                window = old_text[:pos - start] + ins + old_text[stop - start:]
                pieces = self.counter.split(window)
                cuts, at = {0}, 0
                for n in olds:
                    at += n
                    cuts.add(at)
                at, used, found = 0, 0, not pieces and at_end
                for piece in pieces:
                    at += len(piece)
                    used += 1
                    if at >= edit_end and (at - delta) in cuts and (at_end or at <= len(window) - CONTEXT):
                        found = True
                        break
                if found:
                    break
            last += 1
            more = self._bucket(last)
            old_text, olds, old_counts = old_text + more[0], olds + more[1], old_counts + more[2]
            end += len(more[0])
        pieces = pieces[:used]
        old_at, gone = at - delta, 0
        while gone < len(olds) and old_at > 0:
            old_at -= olds[gone]
            gone += 1
        lens = lens[:kept] + list(map(len, pieces)) + olds[gone:]
        counts = counts[:kept] + list(map(self.counter.__getitem__, pieces)) + old_counts[gone:]
        for b in range(first + 1, last + 1):
            self._set(b, "", [], [])
        self._set(first, text[:start - base] + window, lens, counts)
        if len(lens) > 8 * BUCKET:
            self._load(*self.state())
        return len(pieces)

    def state(self) -> tuple[str, np.ndarray, np.ndarray]:
        """The text and, per pre-token, length and token count."""
        texts, lens, counts, done = [], [], [], 0
        for b in [*sorted(self._own), self.buckets]:
            texts.append(self._text[self._starts[done]:self._starts[b]])
            lens.append(self._lens[done * BUCKET:b * BUCKET])
            counts.append(self._counts[done * BUCKET:b * BUCKET])
            if b < self.buckets:
                text, own_lens, own_counts = self._own[b]
                texts.append(text)
                lens.append(np.array(own_lens, "<u4"))
                counts.append(np.array(own_counts, "<u4"))
            done = b + 1
        return "".join(texts), np.concatenate(lens), np.concatenate(counts)


def token_trees(docs: DataFrame, vocab_path: str) -> DataFrame:
    """Per document its text and, as packed unsigned 32-bit integers, the lengths and token counts of its pre-tokens.

    Columns other than doc_id, text and edits are left out; ``edits``, if there, is passed on.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary(vocab_path))
    edited = "edits" in docs.columns
    extra = [F.col("edits").cast(EDIT_TYPE).alias("edits")] if edited else []

    def run(batches):
        counter = counter_for(shared.value)
        for batch in batches:
            lens, counts, totals = [], [], []
            for text in batch["text"].to_pylist():
                pieces = counter.split(text)
                n = np.fromiter(map(counter.__getitem__, pieces), "<u4", len(pieces))
                lens.append(np.fromiter(map(len, pieces), "<u4", len(pieces)).tobytes())
                counts.append(n.tobytes())
                totals.append(int(n.sum()))
            arrays = [batch["doc_id"], batch["text"], pa.array(lens, pa.binary()), pa.array(counts, pa.binary()),
                      pa.array(totals, pa.int64())]
            names = ["doc_id", "text", "lens", "counts", "n_tokens"]
            if edited:
                arrays.append(batch["edits"])
                names.append("edits")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       *extra).mapInArrow(run, TREES + (f", edits {EDIT_TYPE}" if edited else ""))


def apply_edits(trees: DataFrame, vocab_path: str) -> DataFrame:
    """``token_trees`` rows with an ``edits`` column -> the trees after the edits, with counts before and after."""
    spark = trees.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary(vocab_path))
    names = [c.split()[0] for c in EDITED.split(", ")]

    def run(batches):
        counter = counter_for(shared.value)
        for batch in batches:
            rows = []
            for doc_id, text, lens, counts, edits in zip(*(batch[c].to_pylist() for c in
                                                           ("doc_id", "text", "lens", "counts", "edits"))):
                tree = TokenTree(text, np.frombuffer(lens, "<u4"), np.frombuffer(counts, "<u4"), counter)
                before, again, done = tree.n_tokens, 0, 0
                for e in edits or ():
                    if e is not None:
                        pos = tree.chars[1] if e["pos"] is None else e["pos"]
                        again += tree.edit(pos, e["n_del"] or 0, e["ins"] or "")
                        done += 1
                new_text, new_lens, new_counts = tree.state()
                rows.append((doc_id, new_text, new_lens.tobytes(), new_counts.tobytes(), tree.n_tokens, before, done,
                             len(new_lens), again))
            types = [pa.int64(), pa.string(), pa.binary(), pa.binary()] + [pa.int64()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(zip(*rows) if rows else [[]] * 9, types)],
                                             names)

    return trees.select("doc_id", "text", "lens", "counts", "edits").mapInArrow(run, EDITED)


def attach_edits(docs: DataFrame, log: DataFrame) -> DataFrame:
    """Documents with their edits in ``seq`` order, from a log (doc_id, seq, pos, n_del, ins).

    An edit list is kept with its document, as its text is: one row holds both.
    """
    per_doc = (log.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
               .agg(F.array_sort(F.collect_list(F.struct("seq", "pos", "n_del", "ins"))).alias("log"))
               .select("doc_id", F.expr("transform(log, e -> struct(cast(e.pos as long) as pos, "
                                        "cast(e.n_del as long) as n_del, e.ins as ins))").alias("edits")))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .join(per_doc, "doc_id", "left"))
