"""Near duplicates by BagMinHash: signatures of weighted Jaccard similarity over word shingles.

A document is a multiset of shingles (five consecutive words; a shorter one is a single shingle of all its words).
For every shingle the weight axis is cut into dyadic levels (0,1], (1,2], (2,4], ...; each level has its own Poisson
process, seeded by shingle and level, whose points carry a signature slot and a weight inside the level.  A point
counts for a document when its weight does not exceed the shingle's count, and a slot keeps its earliest point.  Two
documents agree on a slot with exactly their weighted Jaccard similarity.  Processes are drawn in order of time and
stop at the largest value still in the signature, so the work per document is near its number of shingles.

Signatures are cut into bands.  Documents that share a band are candidates: within a bucket each is compared with
the bucket's centre (a star, not all pairs), pairs are verified on their whole shingle multisets, and verified links
give classes.  The centre is the member with most company over all its buckets, which in a large group is the text
that the others are copies of.  A star can miss a link between two others, so buckets that still hold several classes
are worked through exactly: their documents are joined on prefixes of their rarest shingles, in which any two
documents of the wanted similarity must meet early enough, and only pairs from different classes are compared.

Identical texts are one node from the start and cost nothing more.  Cases: a null text counts as empty; texts
without words are alike only when identical; repeated rows share a class; an empty table gives an empty result;
other columns are ignored, or carried by ``keep_one``.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored, words_of
from .components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4   # a pair of similarity 0.8 misses every band with probability 3e-6
SKETCH_BITS = 20      # counters that order shingles by frequency; any order is right, a good one is fast
WORDS_KEPT = 100_000  # hashed words kept by a worker

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _stride(k: int) -> np.uint64:
    return np.uint64(k * int(_STEP) & 0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """word -> 64-bit hash, the same in every process."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = WordHashes()


def shingles(text: str | None, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text as sorted 64-bit hashes, with their counts."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - size + 1, 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(size, len(words))):
        out = mix(out + h[k:k + n] + _STEP)
    return np.unique(out, return_counts=True)


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], slots: int) -> np.ndarray:
    """BagMinHash signatures (documents x slots) of shingle multisets; empty ones stay infinite."""
    sig = np.full(len(bags) * slots, np.inf)
    doc = np.repeat(np.arange(len(bags)), [len(h) for h, _ in bags])
    if not len(doc):
        return sig.reshape(len(bags), slots)
    seeds = np.concatenate([h for h, _ in bags])
    weight = np.concatenate([w for _, w in bags])
    # one process per shingle and dyadic level that its count reaches
    parts, level, low = [], 0, 0
    while True:
        held = np.flatnonzero(weight > low)
        if not len(held):
            break
        width = max(low, 1)
        parts.append((doc[held], mix(seeds[held] + _stride(level + 1)), np.full(len(held), width, np.float64),
                      (weight[held] - low).astype(np.float64)))
        low, level = low + width, level + 1
    doc, seed, width, room = (np.concatenate(x) for x in zip(*parts))
    time = np.zeros(len(doc))
    drawn, many = 0, 1
    while len(doc):
        # ``many`` points of every live process at once, each later than the one before
        at = seed[:, None] + (np.arange(drawn + 1, drawn + 1 + many, dtype=np.uint64) * _STEP)[None, :]
        first, second = mix(at), mix(at ^ _M2)
        times = -np.log(_uniform(first)) / (width * slots)[:, None]
        times[:, 0] += time
        times = np.cumsum(times, axis=1)  # added one by one, so the same whatever is drawn at once
        slot = (second & np.uint64(0xFFFFFFFF)) % np.uint64(slots)
        place = np.ceil(((second >> np.uint64(32)).astype(np.float64) + 0.5) * 2.0 ** -32 * width[:, None])
        ok = place <= room[:, None]
        np.minimum.at(sig, (doc[:, None] * slots + slot.astype(np.int64))[ok], times[ok])
        limit = sig.reshape(len(bags), slots).max(axis=1)
        time = times[:, -1]
        live = time < limit[doc]
        doc, seed, width, room, time = doc[live], seed[live], width[live], room[live], time[live]
        drawn += many
        many = max(1, min(32, 200_000 // max(len(doc), 1)))
    return sig.reshape(len(bags), slots)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    # the last bits are left out: a logarithm may round differently on another machine
    bits = np.ascontiguousarray(sig).view(np.uint64) >> np.uint64(16)
    out = np.zeros((len(sig), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * _STEP
    for r in range(rows):
        out = mix(out + bits[:, r:bands * rows:rows])
    return out.view(np.int64)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two shingle multisets; two empty ones have none."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    return shared / (total - shared)


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, text_key, n_shingles, bands) per document; no bands for a text without words."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            bags = [shingles(t) for t in batch["text"].to_pylist()]
            keys = band_keys(signatures(bags, bands * rows), bands, rows)
            sizes = [int(w.sum()) for _, w in bags]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_key"], pa.array(sizes, pa.int64()),
                 pa.array([k.tolist() if n else [] for k, n in zip(keys, sizes)], pa.list_(pa.int64()))],
                ["doc_id", "text_key", "n_shingles", "bands"])

    return keyed(docs).select("doc_id", "text", "text_key").mapInArrow(
        run, "doc_id long, text_key binary, n_shingles long, bands array<long>")


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.unhex(F.sha2(text, 256)).alias("text_key"))


def _verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle multisets overlap enough."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b")

    def run(batches):
        last, bag = None, None
        for batch in batches:
            ok = []
            for b, text_a, text_b in zip(batch["b"].to_pylist(), batch["text_a"].to_pylist(), batch["text_b"].to_pylist()):
                if b != last:
                    last, bag = b, shingles(text_b)
                ok.append(overlap(shingles(text_a), bag) >= similarity)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    # two numbers a link: written in a file per core, not in one per partition of texts
    return both.mapInArrow(run, "a long, b long").repartition(pairs.sparkSession.sparkContext.defaultParallelism)


def _elements(bag: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A multiset as a set: the k-th occurrence of a shingle is an element of its own."""
    h, n = bag
    out, k = [h], 1
    while (n > k).any():
        out.append(mix(h[n > k] + _stride(k)))
        k += 1
    return np.concatenate(out)


def _cross_pairs(buckets: DataFrame, classes: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs of different classes that may be similar, among the documents of buckets that hold several classes.

    Exact for these documents: similar ones meet in the prefixes of their rarest-first element lists.
    """
    spark = buckets.sparkSession
    members = buckets.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    mixed = members.groupBy("band", "key").agg(F.min("class").alias("low"), F.max("class").alias("high")) \
        .where("low <> high").select("band", "key")
    rest = stored(members.join(mixed, ["band", "key"]).groupBy("node").agg(F.first("class").alias("class"))
                  .join(texts, "node"), "mixed-buckets")
    mask = np.uint64((1 << SKETCH_BITS) - 1)

    def count(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                np.add.at(total, (_elements(shingles(text)) & mask).astype(np.int64), 1)
        used = np.flatnonzero(total)
        for i in range(0, len(used), 65536):
            part = used[i:i + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(total[part], pa.int64())], ["cell", "n"])

    cells = rest.select("text").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(1 << SKETCH_BITS, np.int64)  # 2^SKETCH_BITS numbers, whatever the corpus holds
    for r in cells.toLocalIterator():
        counts[r["cell"]] = r["n"]
    shared = spark.sparkContext.broadcast(counts)

    def prefixes(batches):
        frequency = shared.value
        for batch in batches:
            rows = []
            for node, cls, text in zip(batch["node"].to_pylist(), batch["class"].to_pylist(), batch["text"].to_pylist()):
                el = _elements(shingles(text))
                often = frequency[(el & mask).astype(np.int64)]
                order = np.lexsort((el, often))
                order = order[:len(el) - math.ceil(similarity * len(el) - 1e-9) + 1]
                # an element of a single document meets nothing
                rows += [(node, cls, len(el), at, t) for at, (t, n) in
                         enumerate(zip(el[order].view(np.int64).tolist(), often[order].tolist())) if n > 1]
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["node", "class", "n", "at", "token"])

    prefix = stored(rest.select("node", "class", "text").mapInArrow(
        prefixes, "node long, class long, n long, at long, token long"), "prefixes")
    several = prefix.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high")) \
        .where("low <> high").select("token")
    open_tokens = stored(prefix.join(several, "token"), "open-prefixes")
    x, y = (open_tokens.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "class", "n", "at")]) for s in "ab")
    # similar documents share at least this many elements, so after the first one they share there must be
    # enough left behind it in both lists
    needed = F.ceil((F.col("n_a") + F.col("n_b")) * (similarity / (1 + similarity)) - 1e-9)
    fits = (F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * similarity - 1e-9) \
        & (F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= needed)
    return x.join(y, "token").where((F.col("class_a") < F.col("class_b")) & fits) \
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, text_key, class_id (smallest doc_id of its class), class_size, kept."""
    small_batches(docs.sparkSession)
    signs = stored(signed(docs, bands, rows), "signatures")
    nodes = stored(signs.groupBy("text_key").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.max(F.struct("n_shingles", "bands")).alias("s"))
        .select(F.monotonically_increasing_id().alias("node"), "text_key", "rep", "copies", "s.n_shingles", "s.bands"),
        "nodes")
    rows_of = nodes.select("node", "n_shingles", F.posexplode("bands").alias("band", "key"))
    shared = rows_of.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    buckets = stored(rows_of.join(shared, ["band", "key"]), "buckets")
    company = buckets.groupBy("node").agg(F.sum("size").alias("company"))
    centres = buckets.join(company, "node").groupBy("band", "key").agg(
        F.max(F.struct("company", "node"))["node"].alias("first"))
    fits = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * similarity - 1e-9
    star = buckets.join(centres, ["band", "key"]).where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"),
                                                 F.col("n_shingles").alias("n_a")).distinct() \
        .join(nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b")), "b").where(fits).select("a", "b")
    wanted = buckets.select("node").distinct().join(nodes.select("node", "text_key", "rep"), "node")
    texts = stored(_texts(docs, wanted), "candidate-texts")
    links = stored(_verify(star, texts, similarity), "star-links")
    first_classes = components(links)
    cross = _cross_pairs(buckets.select("band", "key", "node"), first_classes, texts, similarity)
    more = stored(_verify(cross, texts, similarity), "cross-links")
    final = first_classes if more.isEmpty() else components(links.union(more))
    of_node = nodes.select("node", "text_key", "rep", "copies").join(final, "node", "left") \
        .withColumn("class", F.coalesce("class", "node"))
    summary = of_node.groupBy("class").agg(F.min(F.struct("rep", "text_key")).alias("first"), F.sum("copies").alias("class_size"))
    of_text = of_node.join(summary, "class").select(
        "text_key", F.col("first.rep").alias("class_id"), F.col("first.text_key").alias("class_key"), "class_size")
    return signs.select("doc_id", "text_key").join(of_text, "text_key").select(
        "doc_id", "text_key", "class_id", "class_size",
        (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_key") == F.col("class_key"))).alias("kept"))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text), one row per node: its copies differ in doc_id only, and one copy's row is taken."""
    some_id = F.coalesce(F.col("doc_id"), F.lit(-2 ** 63))
    found = keyed(docs).select("text_key", some_id.alias("some_id"), "text").join(
        wanted.select("node", "text_key", F.coalesce(F.col("rep"), F.lit(-2 ** 63)).alias("some_id")), ["text_key", "some_id"])
    # grouped by the join's own keys, so rows repeating id and text fold without another shuffle
    return found.groupBy("text_key", "some_id").agg(F.first("node").alias("node"), F.first("text").alias("text")) \
        .select("node", "text")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each class; the class's smallest doc_id stays."""
    judged = classes(docs, similarity)
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias("__gone_id"), F.col("text_key").alias("__gone_key")).distinct()
    key = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    return docs.join(gone, (F.col("__gone_id").eqNullSafe(docs["doc_id"].cast("long"))) & (F.col("__gone_key") == key), "left_anti")
