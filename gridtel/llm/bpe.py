"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a pre-token the last token of its BPE encoding is unique.  An automaton over the vocabulary
(a trie with suffix links) yields at each position all tokens that are suffixes of the prefix; the one whose
predecessor (the stored last token of the remaining prefix) is pair-compatible is stored, and following the
back-pointers from the end emits the ids.  Time and memory are linear in the pre-token's length.

Two tokens are compatible when merging their concatenation never joins a symbol of the left one with a symbol of
the right one.  Only the right edge of the left token's merge tree and the left edge of the right one's can meet,
so the test walks these two edges.

Cases: a null text counts as empty and has no tokens; repeated rows are encoded each on their own; the added
token's string inside a text is that token, as the tokenizers library reads it; extra columns are ignored.
"""
from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, small_batches

# Fixed value: the byte-level pre-token pattern of the vocabulary.
PIECE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ENCODED = "doc_id long, n_tokens long, ids binary"
DECODED = "doc_id long, n_tokens long, ids binary, text string"
CACHE_PIECES = 150_000  # pieces kept per generation of a worker's cache
CACHE_PAIRS = 250_000   # tested token pairs kept
NEVER = 1 << 40


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte: visible Latin-1 stays, the others follow from U+0100 in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PieceSplitter:
    """Pre-tokens exactly as the vocabulary's own pre-tokenizer cuts them.

    The ``regex`` module and the library can know different Unicode versions.  Texts with characters that the two
    class differently go through the library; the set of these is found by asking it, once, when a text first
    leaves the scripts below U+0530, in which they agree.
    """

    def __init__(self, vocab_json: str):
        import regex
        self._json = vocab_json
        self._find = regex.compile(PIECE_PATTERN).findall
        self._beyond = regex.compile("[԰-\U0010ffff]").search
        self._disputed = None
        self._library = None

    def _probe(self):
        import regex
        from tokenizers import Tokenizer
        self._library = Tokenizer.from_str(self._json).pre_tokenizer.pre_tokenize_str
        one = [(0, 2)]
        classes = [(regex.compile(p).match, lead) for p, lead in ((r"\p{L}", "a"), (r"\p{N}", "1"), (r"\s", " "))]
        odd = []
        for cp in (*range(0x530, 0xD800), *range(0xE000, 0x110000)):
            ch = chr(cp)
            lead = next((lead for match, lead in classes if match(ch)), "!")
            if lead == " ":
                same = [o for _, o in self._library("!" + ch)] != one
            else:
                same = [o for _, o in self._library(lead + ch)] == one
            if not same:
                odd.append(cp)
        self._disputed = regex.compile("[" + "".join(f"\\U{cp:08x}" for cp in odd) + "]").search if odd \
            else (lambda text: None)

    def __call__(self, text: str) -> list[str]:
        if self._beyond(text) is not None:
            if self._disputed is None:
                self._probe()
            if self._disputed(text) is not None:
                return [text[a:b] for _, (a, b) in self._library(text)]
        return self._find(text)


class PrefixEncoder:
    """One vocabulary: its merge trees, the automaton over its tokens and a bounded cache of encoded pre-tokens."""

    def __init__(self, vocab_json: str, cache_pieces: int = CACHE_PIECES):
        import ahocorasick
        spec = json.loads(vocab_json)
        model = spec["model"]
        alphabet = byte_alphabet()
        vocab = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(alphabet[c] for c in token)
        for token, i in self.specials.items():
            self.token_bytes[i] = token.encode("utf-8")
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.rank = {(vocab[a] << 20) | vocab[b]: r for r, (a, b) in enumerate(merges)}
        self.birth = [-1] * size
        self.parts: list[tuple[int, int] | None] = [None] * size
        for r, (a, b) in enumerate(merges):
            t = vocab[a + b]
            if self.parts[t] is None:
                self.birth[t], self.parts[t] = r, (vocab[a], vocab[b])
        # token -> (symbol, rank of the merge that absorbs it) from the token down to a byte, by side
        self._edges: tuple[dict[int, list], dict[int, list]] = ({}, {})
        self._pairs: dict[int, bool] = {}
        trie = ahocorasick.Automaton()
        self._whole: dict[str, int] = {}
        special_ids = set(self.specials.values())
        for t in sorted(vocab.values(), key=lambda t: self.birth[t]):
            if t not in special_ids and self._reachable(t):
                key = self.token_bytes[t].decode("latin-1")
                trie.add_word(key, (t, len(key)))
        trie.make_automaton()
        for side in self._edges:  # filled for every token by now; the pairs in use come back
            side.clear()
        self._suffixes = trie.iter
        self._splitter = PieceSplitter(vocab_json)
        self.cache = _PieceCache(self, cache_pieces)
        self._special_split = None
        if self.specials:
            import regex
            longest = sorted(self.specials, key=len, reverse=True)
            self._special_split = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")")

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        known = self._edges[side].get(token)
        if known is None:
            known, symbol, absorbed = [], token, NEVER
            while True:
                known.append((symbol, absorbed))
                if self.parts[symbol] is None:
                    break
                absorbed = self.birth[symbol]
                symbol = self.parts[symbol][side]
            self._edges[side][token] = known
        return known

    def _reachable(self, token: int) -> bool:
        """Whether the token's own bytes encode to it: its two halves meet, and nothing crosses before they do."""
        if self.parts[token] is None:
            return True
        left, right = self.parts[token]
        return not self._crosses(left, right, self.birth[token])

    def _crosses(self, left: int, right: int, before: int) -> bool:
        rank = self.rank
        right_edge = self._edge(right, 0)
        for s, s_end in self._edge(left, 1):
            for u, u_end in right_edge:
                r = rank.get((s << 20) | u)
                # equal ranks: merges run from the left, so the left token's own merge comes first
                if r is not None and r < before and r < s_end and r <= u_end:
                    return True
        return False

    def compatible(self, left: int, right: int) -> bool:
        key = (left << 20) | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= CACHE_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = not self._crosses(left, right, NEVER)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: one stored last token per prefix, then back-pointers."""
        n = len(piece)
        last = [-1] * (n + 1)
        size = [0] * (n + 1)
        pairs, compatible = self._pairs, self.compatible
        for end, (token, length) in self._suffixes(piece.decode("latin-1")):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                known = pairs.get((before << 20) | token)
                if not (compatible(before, token) if known is None else known):
                    continue
            last[end], size[end] = token, length
        out = []
        while n:
            out.append(last[n])
            n -= size[n]
        out.reverse()
        return out

    def pieces(self, text: str) -> list[str]:
        return self._splitter(text)

    def encode_packed(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        lookup = self.cache.__getitem__
        if self._special_split is None or not any(s in text for s in self.specials):
            return b"".join(map(lookup, self._splitter(text)))
        out = []
        for part in self._special_split.split(text):
            if part in self.specials:
                out.append(self.specials[part].to_bytes(4, "little"))
            elif part:
                out.extend(map(lookup, self._splitter(part)))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<u4").tolist()

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


class _PieceCache(dict):
    """pre-token -> packed ids; two generations bound the memory and keep what is in use."""

    def __init__(self, encoder: PrefixEncoder, limit: int):
        super().__init__()
        self._encode, self._limit, self._older = encoder.encode_piece, limit, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self._older.get(piece)
        if packed is None:
            packed = np.array(self._encode(piece.encode("utf-8")), "<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= self._limit:
                self._older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


_ENCODERS: dict[str, PrefixEncoder] = {}


def encoder_for(vocab_json: str) -> PrefixEncoder:
    """The worker's encoder of a vocabulary, built once per Python process."""
    key = hashlib.sha256(vocab_json.encode("utf-8")).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = PrefixEncoder(vocab_json)
    return _ENCODERS[key]


def vocabulary(path: str) -> str:
    """The vocabulary file's text; a few megabytes, whatever the corpus holds."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, vocab_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every whole text; ids packed as little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary(vocab_path))

    def run(batches):
        enc = encoder_for(shared.value)
        for batch in batches:
            packed = [enc.encode_packed(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary())],
                ["doc_id", "n_tokens", "ids"])

    return documents(docs).mapInArrow(run, ENCODED)


def round_trip(docs: DataFrame, vocab_path: str) -> DataFrame:
    """``encode`` and ``decode`` of every whole text in one pass: (doc_id, n_tokens, ids, text decoded from the ids)."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary(vocab_path))

    def run(batches):
        enc = encoder_for(shared.value)
        for batch in batches:
            packed = [enc.encode_packed(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary()),
                 pa.array([enc.decode(p) for p in packed], pa.string())], ["doc_id", "n_tokens", "ids", "text"])

    return documents(docs).mapInArrow(run, DECODED)


def decode(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """``encode``'s rows with the text their ids stand for."""
    spark = encoded.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary(vocab_path))

    def run(batches):
        spec = json.loads(shared.value)
        alphabet = byte_alphabet()
        table = {i: bytes(alphabet[c] for c in t) for t, i in spec["model"]["vocab"].items()}
        table |= {t["id"]: t["content"].encode("utf-8") for t in spec.get("added_tokens") or []}
        for batch in batches:
            texts = [b"".join(map(table.__getitem__, np.frombuffer(p or b"", "<u4").tolist())).decode("utf-8", "replace")
                     for p in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_tokens"], batch["ids"], pa.array(texts, pa.string())],
                                             ["doc_id", "n_tokens", "ids", "text"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, DECODED)
