"""Fill-in-middle transformation: two cut ranks of every text found in an indexable skip list of its units.

A text is cut into units (a run of ASCII letters, or one other code point).  The skip list's bottom lane holds one node
a unit; every higher lane holds a random part of the nodes below and, for each, how many units and how many code points
lie before its next node.  Descending by accumulated widths reaches a unit rank and its code-point offset in a
logarithmic number of steps.  Hashes of doc_id choose the ranks, the share of texts left plain and the order of the
pieces, so a rerun after a lost executor writes the same rows.

Cases: a null text counts as empty; an empty text, and one that holds a marker, stays plain; a null doc_id hashes as
an empty number; ranks may tie (an empty middle) and lie at either end (an empty prefix or suffix); repeated rows are
transformed each on their own; a text of any length is one row with a few integers a unit; an empty table gives an
empty result; other columns are ignored.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
SEED = 1
TRANSFORMED = 90      # percent of texts that are transformed
SUFFIX_FIRST = 20     # percent of those whose suffix comes first
SPREAD = 4            # about every fourth node of a lane is also in the next

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def unit_widths(text: str) -> np.ndarray:
    """Code points of every unit, left to right."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(c):
        return np.zeros(0, np.int64)
    letter = ((c | 32) >= 97) & ((c | 32) <= 122)
    first = np.ones(len(c), bool)
    first[1:] = ~(letter[1:] & letter[:-1])
    return np.diff(np.flatnonzero(first), append=len(c))


class SkipList:
    """Units of one text with express lanes; ``offset`` turns a unit rank into a code-point offset."""

    def __init__(self, widths: np.ndarray):
        self.lanes = [(np.ones(len(widths), np.int64), widths.astype(np.int64), None)]
        while len(self.lanes[-1][0]) > SPREAD:
            units, chars, _ = self.lanes[-1]
            coin = (np.arange(len(units), dtype=np.uint64) + np.uint64(len(self.lanes))) * np.uint64(0x9E3779B97F4A7C15)
            tall = (coin >> np.uint64(33)) % np.uint64(SPREAD) == 0
            tall[0] = True
            below = np.flatnonzero(tall)
            self.lanes.append((np.add.reduceat(units, below), np.add.reduceat(chars, below), below))

    def offset(self, rank: int) -> int:
        """Code points before unit ``rank``; the number of units stands for the end."""
        passed = at = node = 0
        for level in range(len(self.lanes) - 1, -1, -1):
            units, chars, below = self.lanes[level]
            while node < len(units) and passed + units[node] <= rank:
                passed += int(units[node])
                at += int(chars[node])
                node += 1
            if level:
                node = int(below[node]) if node < len(below) else len(self.lanes[level - 1][0])
        if passed != rank:
            raise IndexError(f"rank {rank} of {passed} units")
        return at


def numbers(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def transform_one(doc_id: int | None, text: str, seed: int = SEED, transformed: int = TRANSFORMED,
                  suffix_first: int = SUFFIX_FIRST) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    widths = unit_widths(text)
    h1, h2, h3, h4 = numbers(doc_id, seed)
    n = len(widths)
    if not text or h3 % 100 >= transformed or any(m in text for m in MARKERS):
        return n, "plain", None, None, text
    units = SkipList(widths)
    a, b = (units.offset(rank) for rank in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < suffix_first:
        return n, "spm", a, b - a, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", a, b - a, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def transform(docs: DataFrame, seed: int = SEED, transformed: int = TRANSFORMED,
              suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row; widths are null for plain texts."""
    small_batches(docs.sparkSession)
    types = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
             ("output", pa.string())]

    def run(batches):
        for batch in batches:
            rows = [transform_one(i, t, seed, transformed, suffix_first)
                    for i, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"]] + [pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(types)],
                ["doc_id"] + [name for name, _ in types])

    return documents(docs).mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from: pieces lie between markers that no transformed text holds."""
    def pieces(second: str):
        body = F.substring(output, F.lit(len(PREFIX) + 1), F.length(output))
        one = F.substring_index(body, second, 1)
        rest = F.substring(body, F.length(one) + len(second) + 1, F.length(body))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substring(rest, F.length(two) + len(MIDDLE) + 1, F.length(rest))

    prefix, suffix, middle = pieces(SUFFIX)
    last, first, between = pieces(PREFIX)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(first, between, last)) \
        .otherwise(output)
