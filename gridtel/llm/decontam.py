"""Benchmark decontamination: one Aho-Corasick automaton over the test items, each document read once.

Text and items are cut into the same words.  A window is 13 consecutive words of an item, or the whole item when it
has fewer.  Every distinct benchmark word becomes one character, so a window is a short string and a document one
character per word (words outside the benchmark all share one); the automaton over all windows reads that string
once.  Word positions map back to character offsets of the original text.

The benchmark is sent to the executors in blocks of at most ``block_windows`` windows: its size is checked, and a
larger one is scanned in several passes whose hits are united per document.

Cases: null texts have no words; items without words have no windows; words inside the windows of an item with a null
id are hit, but there is no id to count or list; rows repeating an item id count as one item; repeated documents are
judged each on their own; a text of any length is one row, read once; an empty benchmark leaves every document clean;
empty tables give an empty result; other columns are ignored.
"""
from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, small_batches, stored, united, words_of

WINDOW = 13
BLOCK_WINDOWS = 20_000  # windows in one automaton (at most 13 nodes each)
# Reserved names of the state columns, apart from any input's own.
N_WORDS, HITS, ITEMS = "__decontam_words", "__decontam_hits", "__decontam_items"
STATE = f"{N_WORDS} long, {HITS} array<struct<first:long,last:long,start:long,end:long>>, {ITEMS} array<string>"
OTHER = "\x00"
ORIGINAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def windows(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    if len(words) < size:
        return [tuple(words)]
    return [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]


def blocks(benchmark: DataFrame, size: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> Iterator[list]:
    """Blocks of (item id as text, windows), each with at most ``block_windows`` windows; one block in memory at a time."""
    items = benchmark.where(F.col("text").isNotNull()) \
        .select(F.col("item_id").cast("string").alias("item_id"), "text")
    block, held = [], 0
    for row in items.toLocalIterator():
        todo = windows(words_of(row["text"]), size)
        while todo:
            part, todo = todo[:block_windows - held], todo[block_windows - held:]
            block.append((row["item_id"], part))
            held += len(part)
            if held >= block_windows:
                yield block
                block, held = [], 0
    if block:
        yield block


class Automaton:
    """The windows of one block over word characters; values name the items a window belongs to."""

    def __init__(self, block: list):
        import ahocorasick
        self.chars: dict[bytes, str] = {}
        owners: dict[str, list[str | None]] = {}
        for item, item_windows in block:
            for w in item_windows:
                key = "".join(self._char(word) for word in w)
                owners.setdefault(key, []).append(item)
        trie = ahocorasick.Automaton()
        for key, items in owners.items():
            trie.add_word(key, (len(key), tuple(dict.fromkeys(items))))
        if owners:
            trie.make_automaton()
        self.matches = trie.iter if owners else lambda coded: ()  # without windows nothing matches

    def _char(self, word: bytes) -> str:
        if word not in self.chars:
            n = len(self.chars) + 1
            self.chars[word] = chr(n if n < 0xD800 else n + 0x800)
        return self.chars[word]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """Word ranges (first, last + 1) covered by windows, united, and the items that occur."""
        get = self.chars.get
        coded = "".join([get(w, OTHER) for w in words])
        ranges: list[tuple[int, int]] = []
        items: set[str | None] = set()
        for end, (length, owners) in self.matches(coded):
            ranges.append((end + 1 - length, end + 1))
            items.update(owners)
        return united(ranges), sorted(items - {None})


_AUTOMATA: dict[str, Automaton] = {}


def _automaton(key: str, block: list) -> Automaton:
    """The worker's automaton of the block in use, built once per Python process."""
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[key] = Automaton(block)
    return _AUTOMATA[key]


def _scan_block(rows: DataFrame, block: list, keep: list[str], offsets: bool) -> DataFrame:
    """One pass over the texts: adds what the block's windows hit to the state columns and keeps ``keep`` beside them."""
    shared = rows.sparkSession.sparkContext.broadcast(block)
    key = uuid.uuid4().hex
    before = HITS in rows.columns
    span_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        automaton = _automaton(key, shared.value)
        for batch in batches:
            n_words, hits, items = [], [], []
            old = zip(batch[HITS].to_pylist(), batch[ITEMS].to_pylist()) if before else None
            for text in batch["text"].to_pylist():
                words = words_of(text)
                found, owners = automaton.scan(words)
                if old is not None:
                    old_hits, old_items = next(old)
                    found = united(found + [(h["first"], h["last"]) for h in old_hits])
                    owners = sorted({*owners, *old_items})
                places = [m.span() for m in ORIGINAL_WORD.finditer(text)] if found and offsets else None
                n_words.append(len(words))
                hits.append([{"first": a, "last": b, "start": places[a][0] if places else None,
                              "end": places[b - 1][1] if places else None} for a, b in found])
                items.append(owners)
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in keep] + [pa.array(n_words, pa.int64()), pa.array(hits, span_type),
                                            pa.array(items, pa.list_(pa.string()))], [*keep, N_WORDS, HITS, ITEMS])

    kept = rows.select(*keep).schema
    schema = T.StructType([*kept.fields, *rows.sparkSession.createDataFrame([], STATE).schema.fields])
    return rows.mapInArrow(run, schema)


def annotate(docs: DataFrame, benchmark: DataFrame, keep: list[str], *, size: int = WINDOW,
             block_windows: int = BLOCK_WINDOWS, offsets: bool = True) -> DataFrame:
    """``keep`` columns of every row of ``docs`` with N_WORDS, HITS (word ranges and, with ``offsets``, the code point
    ranges of the original text) and ITEMS (item ids that occur, sorted as text)."""
    small_batches(docs.sparkSession)
    rows = docs
    todo = blocks(benchmark, size, block_windows)
    block = next(todo, [])
    while True:
        following = next(todo, None)
        if following is None:
            return _scan_block(rows, block, keep, offsets)
        # another block follows: its pass needs the texts again, and starts from a stored state
        rows = stored(_scan_block(rows, block, list(dict.fromkeys([*keep, "text"])), False), "decontam")
        block = following


def n_hit() -> F.Column:
    return F.aggregate(HITS, F.lit(0).cast("long"), lambda n, h: n + h["last"] - h["first"])


def contaminated() -> F.Column:
    """At least one word hit, and hits on at least a twentieth of the words."""
    return (n_hit() > 0) & (n_hit() * 20 >= F.col(N_WORDS))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: its words, hit words, the items found, their digest, the verdict, and the hit passages as
    ``start:end`` code points of the original text, comma-joined."""
    found = annotate(documents(docs), benchmark, ["doc_id"], **options)
    return found.select("doc_id", F.col(N_WORDS).alias("n_words"), n_hit().alias("n_hit"),
                        F.size(ITEMS).cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", ITEMS), 256).alias("items_sha256"),
                        contaminated().alias("contaminated"),
                        F.array_join(F.transform(HITS, lambda h: F.concat_ws(":", h["start"], h["end"])), ",").alias("passages"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    found = annotate(docs, benchmark, docs.columns, offsets=False, **options)
    return found.where(~contaminated()).select(*docs.columns)
