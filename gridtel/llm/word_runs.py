"""Periodic run detection over words, on a Re-Pair grammar of the word ids.

A run is a maximal stretch of consecutive words with smallest period q and at least max(12, 2q) words.

1. Every word of a run lies in a six-word sequence that its document holds twice, because at least six words of the run
   recur q words later.  Stretches of such words are found by hashes (a collision only makes them longer); all other
   words are in no run and stay out of the grammar.
2. Re-Pair replaces repeated pairs of neighbouring symbols by nonterminals until none repeats.  One round replaces all
   pairs that are more frequent than their neighbours, so the number of rounds stays small; the
   stretches of one Arrow batch share a grammar, so what documents repeat is worked on once.  What remains of a stretch
   is paired level by level.
3. A run that lies in the expansion of a nonterminal and crosses the boundary between its two parts is found there,
   once for all places that the nonterminal derives: a period p joins the words on both sides of the boundary, and the
   common extensions of the two positions p apart give the stretch.
4. The stretches go to all derivation positions; of those with one period in a document the ones inside another are
   parts of it, cut short by the end of a nonterminal, and the rest are the runs.

Cases: a null or empty text, or one of separators only, has no words and no runs; runs may overlap and nest with other
periods; ties for the longest run go to the smallest start, then period; repeated rows are worked on each on their own;
a null doc_id hashes as an empty number; a text of any length is one row with a few integers a word; an empty table gives
an empty result; other columns are ignored.
"""
from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, small_batches

MIN_WORDS = 12
SPAN = 6          # words that recur in every run of at least MIN_WORDS words
SCHEMA = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs string, collapsed string")

_MULTIPLIERS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63,
                0xD6E8FEB86659FD93]


def _grams(ids: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of an id array."""
    h = np.zeros(max(len(ids) - n + 1, 0), np.uint64)
    for k in range(n):
        h = (h ^ ids[k:len(h) + k].astype(np.uint64)) * np.uint64(_MULTIPLIERS[k])
        h ^= h >> np.uint64(29)
    return h


def candidate_words(ids: np.ndarray) -> np.ndarray:
    """Which words of one document lie in a repeated sequence of SPAN words."""
    mask = np.zeros(len(ids), bool)
    if len(ids) < MIN_WORDS:
        return mask
    h = _grams(ids, SPAN)
    ordered = np.sort(h)
    same = ordered[1:] == ordered[:-1]
    if same.any():
        twice = ordered[1:][same]
        slot = np.searchsorted(twice, h)
        at = np.flatnonzero(twice[np.minimum(slot, len(twice) - 1)] == h)
        for k in range(SPAN):
            mask[at + k] = True
    return mask


def _replaceable(pair: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Positions to replace in one round: pairs that occur twice without overlap, more often than neighbouring pairs."""
    n = len(pair)
    at = np.arange(n)
    first = np.ones(n, bool)
    first[1:] = (pair[1:] != pair[:-1]) | ~valid[:-1]
    # within x x x ... only every second pair may be replaced
    free = valid & ((at - np.maximum.accumulate(np.where(first, at, 0))) % 2 == 0)
    kinds, which = np.unique(pair, return_inverse=True)
    often = np.bincount(which[free], minlength=len(kinds))
    rank = np.zeros(len(kinds), np.int64)
    rank[np.lexsort((-np.arange(len(kinds)), often))] = np.arange(1, len(kinds) + 1)
    priority = np.where(valid & (often[which] >= 2), rank[which], 0)
    left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    left[1:], right[:-1] = priority[:-1], priority[1:]
    chosen = free & (priority > 0) & (priority >= left) & (priority >= right)
    used = np.bincount(which[chosen], minlength=len(kinds))
    return np.flatnonzero(chosen & (used[which] >= 2))


class Grammar:
    """Re-Pair over id sequences, ``-1`` between them: every nonterminal's sizes and all its places in the derivation."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        self.rules: dict[int, int] = {}      # pair of symbols -> rule
        self.left: list[int] = []            # words of a rule's first part
        self.size: list[int] = []            # words of a rule
        self._rule, self._at = [], []
        symbol, start = ids.astype(np.int64), np.arange(len(ids))
        size = np.ones(len(ids), np.int64)
        base = int(ids.max(initial=0)) + 1
        paired = False
        while len(symbol) > 1:
            valid = (symbol[1:] >= 0) & (symbol[:-1] >= 0)
            pair = np.where(valid, (symbol[:-1] << 32) | np.maximum(symbol[1:], 0), -1)
            at = np.zeros(0, np.int64) if paired else _replaceable(pair, valid)
            if not len(at):   # no pair repeats: join neighbours two by two
                paired = True
                place = np.arange(len(pair))
                begin = np.maximum.accumulate(np.where(symbol[:-1] < 0, place + 1, 0))
                at = np.flatnonzero(valid & ((place - begin) % 2 == 0))
                if not len(at):
                    break
            kinds, place, which = np.unique(pair[at], return_index=True, return_inverse=True)
            numbers = np.empty(len(kinds), np.int64)
            for k, (code, one) in enumerate(zip(kinds.tolist(), at[place].tolist())):
                rule = self.rules.get(code)
                if rule is None:
                    rule = self.rules[code] = len(self.size)
                    self.left.append(int(size[one]))
                    self.size.append(int(size[one] + size[one + 1]))
                numbers[k] = rule
            self._rule.append(numbers[which])
            self._at.append(start[at])
            symbol[at] = base + numbers[which]
            size[at] += size[at + 1]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, start, size = symbol[keep], start[keep], size[keep]

    def places(self):
        """(rule, all its places in order) of the rules that are long enough to hold a run."""
        if not self._rule:
            return
        rule, at = np.concatenate(self._rule), np.concatenate(self._at)
        order = np.lexsort((at, rule))
        rule, at = rule[order], at[order]
        edge = np.flatnonzero(np.diff(rule, prepend=-1))
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(rule)]):
            if self.size[rule[a]] >= MIN_WORDS:
                yield int(rule[a]), at[a:b]


def _same(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the common prefix of two arrays."""
    n, done, step = min(len(x), len(y)), 0, 16
    while done < n:
        end = min(done + step, n)
        differ = x[done:end] != y[done:end]
        if differ.any():
            return done + int(differ.argmax())
        done, step = end, step * 4
    return n


def crossing_runs(word: np.ndarray, triple: np.ndarray, b: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs in ``word`` that hold the words on both sides of ``b``.

    ``triple`` holds a hash of the three words from each position: a run repeats at least six words, so three of them on
    one side of the boundary recur a period away.
    """
    m, near = len(word), []
    for anchor in (b, b - 3):
        if 0 <= anchor <= m - 3:
            p = np.flatnonzero(triple[:m - 2] == triple[anchor]) - anchor
            near.append(p[(p != 0) & (p <= m - b) & (p >= -b)])
    if not near:
        return []
    offsets = np.unique(np.concatenate(near))
    offsets = offsets[np.argsort(np.abs(offsets), kind="stable")]
    found: dict[tuple[int, int], int] = {}
    while len(offsets):
        o, offsets = int(offsets[0]), offsets[1:]
        p = abs(o)
        before = _same(word[:b][::-1], word[:b + o][::-1])
        after = _same(word[b:], word[b + o:])
        s, e = min(b, b + o) - before, max(b, b + o) + after
        if e - s >= 2 * p:
            if e - s >= MIN_WORDS:
                found.setdefault((s, e), p)
            # a multiple of the period that stays inside the stretch gives the same stretch again
            offsets = offsets[(offsets % p != 0) | (b + offsets > e) | (b + offsets < s)]
    return [(s, e, p) for (s, e), p in found.items()]


def _longest_by_period(rows: np.ndarray) -> np.ndarray:
    """Of (document, period, start, end) rows those that no other row of their document and period contains."""
    rows = rows[np.lexsort((-rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    group = np.zeros(len(rows), np.int64)
    group[1:] = np.cumsum((rows[1:, :2] != rows[:-1, :2]).any(1))
    reach = group * (rows[:, 3].max() + 1) + rows[:, 3]
    keep = np.ones(len(rows), bool)
    keep[1:] = reach[1:] > np.maximum.accumulate(reach)[:-1]
    return rows[keep]


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each id array, by start, then period."""
    pieces, owner, offset = [], [], []
    for d, ids in enumerate(texts):
        mask = candidate_words(ids)
        edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).tolist()
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a >= MIN_WORDS:
                pieces.append(ids[a:b])
                owner.append(d)
                offset.append(a)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not pieces:
        return out
    sizes = np.array([len(p) for p in pieces])
    begin = np.cumsum(sizes + 1) - sizes - 1
    ids = np.full(int((sizes + 1).sum()), -1, np.int64)
    for a, p in zip(begin.tolist(), pieces):
        ids[a:a + len(p)] = p
    triple = np.concatenate([_grams(ids, 3), np.zeros(2, np.uint64)])
    owner, offset = np.array(owner), np.array(offset)
    grammar, found = Grammar(ids), []
    for rule, at in grammar.places():
        a, n = int(at[0]), grammar.size[rule]
        for s, e, p in crossing_runs(ids[a:a + n], triple[a:a + n], grammar.left[rule]):
            piece = np.searchsorted(begin, at, "right") - 1
            place = at - begin[piece] + offset[piece]
            found.append(np.stack([owner[piece], np.full(len(at), p), place + s, place + e], 1))
    if found:
        rows = _longest_by_period(np.concatenate(found))
        for d, p, s, e in rows[np.lexsort((rows[:, 1], rows[:, 2], rows[:, 0]))].tolist():
            out[d].append((s, e - s, p))
    return out


def looped(words: list, doc_id: int | None) -> list:
    """The words of a document; of every tenth by a hash of its id a tail goes round in circles."""
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def _row(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """Values of one document after doc_id."""
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    if not runs:
        return len(words), 0, None, None, None, None, listed, b" ".join(words).decode()
    drop = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        drop[s + q] += 1
        drop[s + n] -= 1
    kept = np.cumsum(drop[:-1]) == 0
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]))
    collapsed = b" ".join(w for w, k in zip(words, kept.tolist()) if k).decode()
    return len(words), len(runs), s, n, q, 1000 * n // q, listed, collapsed


def detect(docs: DataFrame, loops: bool = True) -> DataFrame:
    """Runs of every row: their number, the longest one, the list of all, and the text without the repeated words.

    ``loops`` first makes the tail of some documents periodic (``looped``).
    """
    small_batches(docs.sparkSession)
    types = [pa.int64()] * 6 + [pa.string()] * 2
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            number: defaultdict = defaultdict(count().__next__)
            words = [t.encode().split() for t in batch["text"].to_pylist()]
            if loops:
                words = [looped(w, i) for w, i in zip(words, batch["doc_id"].to_pylist())]
            runs = runs_of([np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in words])
            rows = [_row(w, r) for w, r in zip(words, runs)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"]] + [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(types)], names)

    return documents(docs).mapInArrow(run, SCHEMA)
