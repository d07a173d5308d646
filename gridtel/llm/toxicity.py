"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Texts (ASCII letters lower-cased) are read as the set of their hashed character n-grams.  On all labelled
rows outside the held-out fold Spark counts in how many toxic and other texts each n-gram occurs.  The scale of a feature is
its log-count ratio, shrunk by what chance explains: times max(0, 1 - E / G), where G is the likelihood-ratio statistic of
its counts against the share of toxic texts and E = ln(texts) / 2, at least 4 (two standard errors): more texts ask
for more evidence, and no n-gram is left out by a count of its own.  A logistic regression is fitted on presence times scale; an n-gram with a scale that no row of
the fit holds takes the mean coefficient of the others.

Only texts with a label are shuffled: Spark's runtime filter, a Bloom filter of at most ``FILTER_BITS`` bits over the labelled ids,
drops the rest at the scan (beyond that size it lets more through, and the join behind it decides).  Tasks send their
counts as packed blocks of cells.

Rows of the fit are a sample of at most ``TOXIC_ROWS`` toxic and ``CLEAN_ROWS`` other labelled documents, the first by
a hash of doc_id, from rows whose crc32(doc_id) mod 5 is not 0.  Scores use the text alone.

Cases: a null text counts as empty and is scored like any text without known n-grams; a null doc_id is held out and
trains nothing; a doc_id with several labels
is toxic if one of them says so; null labels do not count; of rows that repeat a
doc_id the largest text trains; with no rows of one of the labels every score is the
share of toxic rows (0 without any); repeated rows are scored each on their own; a text of any length takes a few bytes
a character in one task; an empty table gives an
empty result; other columns are ignored, or kept by ``drop_toxic``.
"""
from __future__ import annotations

import zlib
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, small_batches, stored

ORDERS = (4, 5, 6)
BITS = 23
BLOCK = 4096             # cells that travel together
FILTER_BITS = 1 << 26
TOXIC_ROWS = 1500
CLEAN_ROWS = 3000
PENALTY = 30.0
PART_ROWS = 500     # rows of the fit that are worked on together
FOLDS = 5

_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0x9E3779B9], np.uint32)


def grams(text: str) -> np.ndarray:
    """Cells of all n-grams of a text, with repeats."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    c = np.where((c >= 65) & (c <= 90), c + 32, c).astype(np.uint32)
    out = []
    for n in ORDERS:
        if len(c) >= n:
            h = np.full(len(c) - n + 1, n, np.uint32)
            for k in range(n):
                h = (h ^ c[k:len(c) - n + 1 + k]) * _MULTIPLIERS[k]
                h ^= h >> np.uint32(15)
            out.append(h >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


@dataclass
class Model:
    cell: np.ndarray      # cells with a weight, in order
    weight: np.ndarray    # of these: coefficient times scale; float32
    bias: float
    constant: float | None = None

    def dense(self) -> np.ndarray:
        """The weight of every cell; built where texts are scored, so that only the known cells travel."""
        out = np.zeros(1 << BITS, np.float32)
        out[self.cell] = self.weight
        return out

    def scores(self, texts: list[str | None], dense: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            cells = grams(text or "")
            cells = np.unique(cells[dense[cells] != 0])
            out[i] = dense[cells].astype(np.float64).sum() + self.bias
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == 0


def judged_ids(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic as 0 or 1) of the labelled documents outside the held-out fold."""
    return labels.where("doc_id is not null and toxic is not null") \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic")).where(~held_out())


@contextmanager
def runtime_filter(spark: SparkSession, ids: int):
    """Let Spark drop rows by a Bloom filter of the smaller side's keys before they are shuffled, at any size."""
    prefix = "spark.sql.optimizer.runtime.bloomFilter."
    bits = min(FILTER_BITS, 1 << max(16 * ids, 1024).bit_length())
    wanted = {"enabled": "true", "applicationSideScanSizeThreshold": "1", "creationSideThreshold": "1000000g",
              "expectedNumItems": str(max(ids, 1)), "maxNumItems": str(max(ids, 1)), "numBits": str(bits), "maxNumBits": str(FILTER_BITS)}
    before = {k: spark.conf.get(prefix + k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(prefix + k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(prefix + k, v)


def labelled_texts(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """(doc_id, toxic, text), one row per judged id; rows that repeat an id are merged before and after their shuffle.

    The condition on ``toxic`` always holds: Spark only builds a runtime filter from a side that has one.
    """
    return documents(docs).where(F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("text").alias("text")) \
        .join(judged.where("toxic >= 0"), "doc_id").select("doc_id", "toxic", "text")


def _packed(counts: np.ndarray) -> bytes:
    """A block of counts in the smallest unsigned type that holds them, compressed."""
    top = counts.max()
    return zlib.compress(counts.astype("u1" if top < 256 else "<u2" if top < 65536 else "<u4" if top < 1 << 32 else "<u8").tobytes(), 1)


def _counts(packed: bytes) -> np.ndarray:
    raw = zlib.decompress(packed)
    return np.frombuffer(raw, f"<u{len(raw) // BLOCK}").astype(np.int64)


def cell_counts(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """(block, n, toxic), packed: labelled texts, one per doc_id, that hold a cell, and the toxic ones of them.

    The first count of block -1 stands for all texts.  A task adds up its own texts and sends at most one row per block;
    the rows of a block are added where they arrive, one at a time.
    """
    small_batches(docs.sparkSession)

    def add(batches):
        counts, texts = np.zeros((2, 1 << BITS), np.uint32), np.zeros((2, BLOCK), np.uint32)
        for batch in batches:
            for toxic, text in zip(batch["toxic"].to_pylist(), batch["text"].to_pylist()):
                cells = np.unique(grams(text))
                for k in (0, 1) if toxic else (0,):
                    counts[k, cells] += 1
                    texts[k, 0] += 1
        yield from rows([-1], [texts])
        blocks = counts.reshape(2, -1, BLOCK)
        used = np.flatnonzero(blocks[0].any(1))
        for i in range(0, len(used), 256):
            yield from rows(used[i:i + 256], [blocks[:, b] for b in used[i:i + 256]])

    def rows(blocks, counts):
        if len(blocks):
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32())] + [pa.array([_packed(c[k]) for c in counts], pa.binary())
                                                                              for k in (0, 1)], ["block", "n", "toxic"])

    def merge(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, n, toxic in zip(*(batch[c].to_pylist() for c in ("block", "n", "toxic"))):
                part = np.stack([_counts(n), _counts(toxic)])
                held[block] = held[block] + part if block in held else part
        for block in sorted(held):
            yield from rows([block], [held[block]])

    schema = "block int, n binary, toxic binary"
    with runtime_filter(docs.sparkSession, judged.count()):
        return stored(labelled_texts(docs, judged).select("toxic", "text").mapInArrow(add, schema).repartition("block")
                      .mapInArrow(merge, schema), "toxicity-cells")


def scales(n: np.ndarray, toxic: np.ndarray, texts: int, toxic_texts: int) -> np.ndarray:
    """Log-count ratios of cells, shrunk by the evidence that their counts give."""
    if not 0 < toxic_texts < texts:
        return np.zeros(len(n), np.float32)
    share, clean = toxic_texts / texts, n - toxic
    ratio = np.log((toxic + share) / toxic_texts) - np.log((clean + 1 - share) / (texts - toxic_texts))
    evidence = np.zeros(len(n))
    for seen, part in ((toxic, share), (clean, 1 - share)):
        some = seen > 0
        evidence[some] += 2 * seen[some] * np.log(seen[some] / (n[some] * part))
    chance = max(4.0, np.log(texts) / 2)
    return np.where(evidence > chance, ratio * (1 - chance / np.maximum(evidence, 1e-9)), 0.0).astype(np.float32)


@dataclass
class Known:
    """Cells with a scale, in order, and their counts; and the two totals."""
    cell: np.ndarray
    n: np.ndarray
    toxic: np.ndarray
    texts: int
    toxic_texts: int


def known_cells(cells: DataFrame) -> Known:
    """The cells that have a scale; none where one of the labels is missing."""
    total = cells.where("block = -1").collect()
    texts, toxic_texts = (int(_counts(total[0][c])[0]) for c in ("n", "toxic")) if total else (0, 0)
    none = np.zeros(0, np.int64)
    if toxic_texts in (0, texts):
        return Known(none, none, none, texts, toxic_texts)

    def run(batches):
        for batch in batches:
            for block, *packed in zip(*(batch[c].to_pylist() for c in ("block", "n", "toxic"))):
                n, toxic = map(_counts, packed)
                at = np.flatnonzero(scales(n, toxic, texts, toxic_texts))
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([zlib.compress(x.astype("<i8").tobytes(), 1)], pa.binary()) for x in (block * BLOCK + at, n[at], toxic[at])],
                        ["cell", "n", "toxic"])

    rows = cells.where("block >= 0").mapInArrow(run, "cell binary, n binary, toxic binary").collect()
    found = [np.concatenate([none] + [np.frombuffer(zlib.decompress(r[c]), "<i8") for r in rows]) for c in ("cell", "n", "toxic")]
    order = np.argsort(found[0])
    return Known(*(x[order] for x in found), texts, toxic_texts)


def training_rows(docs: DataFrame, judged: DataFrame, toxic_rows: int, clean_rows: int) -> DataFrame:
    """(doc_id, toxic, text) of the sampled training documents; the sampled ids are bounded by the two parameters."""
    order = [F.xxhash64("doc_id"), "doc_id"]
    sample = judged.where("toxic <> 0").orderBy(*order).limit(toxic_rows) \
        .unionAll(judged.where("toxic = 0").orderBy(*order).limit(clean_rows))
    # one text per sampled id, taken before the shuffle, however many rows repeat it
    return documents(docs).join(F.broadcast(sample), "doc_id").groupBy("doc_id") \
        .agg(F.max("toxic").alias("toxic"), F.max("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    judged = stored(judged_ids(labels), "toxicity-judged")
    known = known_cells(cell_counts(docs, judged))
    if known.toxic_texts in (0, known.texts):
        return Model(known.cell, np.zeros(0, np.float32), 0.0, constant=float(known.toxic_texts > 0))
    rows = _known_slots(training_rows(docs, judged, toxic_rows, clean_rows), known)
    scale = scales(known.n, known.toxic, known.texts, known.toxic_texts)
    y = np.array([r["toxic"] for r in rows], float)

    def parts():
        """Consecutive rows with their slots and values; a row's own text is taken out of the counts behind its values."""
        for i in range(0, len(rows), PART_ROWS):
            found = [np.frombuffer(r["slot"], "<i4") for r in rows[i:i + PART_ROWS]]
            own = [scales(known.n[f] - 1, known.toxic[f] - t, known.texts - 1, known.toxic_texts - t)
                   for f, t in zip(found, y[i:i + PART_ROWS].astype(np.int64))]
            yield np.concatenate(found), np.concatenate(own), np.array([len(f) for f in found])

    parts = list(parts())
    del rows
    coefficient, bias = logistic(parts, y, len(scale))
    seen = np.zeros(len(scale), bool)
    for feature, _, _ in parts:
        seen[feature] = True
    if seen.any():
        coefficient[~seen] = coefficient[seen].mean()
    return Model(known.cell, (coefficient * scale).astype(np.float32), bias)


def _known_slots(rows: DataFrame, known: Known) -> list:
    """The sampled rows, by doc_id, with the slots of their known cells, packed; as bounded as the sample."""
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(known.cell)

    def run(batches):
        slots = np.full(1 << BITS, -1, np.int32)
        slots[shared.value] = np.arange(len(shared.value))
        for batch in batches:
            found = [slots[grams(text)] for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["toxic"], pa.array([np.unique(f[f >= 0]).astype("<i4").tobytes() for f in found], pa.binary())],
                ["doc_id", "toxic", "slot"])

    return sorted(rows.mapInArrow(run, "doc_id long, toxic int, slot binary").collect(), key=lambda r: r["doc_id"])


def logistic(parts: list[tuple], y: np.ndarray, n_features: int, steps: int = 150):
    """L2-penalized logistic regression of ``y`` (0 or 1); both labels weigh the same in total.

    ``parts`` lists consecutive rows: their features one after the other, the values of these, and how many each row
    has.  Gradient descent with momentum on the mean loss; the step is bounded by the largest rows' squared norm.
    """
    n = len(y)
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1 / n), 0.5 / max(1 - y.mean(), 1 / n)) / n
    ends = np.cumsum([len(sizes) for _, _, sizes in parts])
    bounds = [slice(b - len(sizes), b) for b, (_, _, sizes) in zip(ends.tolist(), parts)]

    def per_row(x, sizes):
        out, some = np.zeros(len(sizes)), sizes > 0
        if some.any():
            out[some] = np.add.reduceat(x, (np.cumsum(sizes) - sizes)[some])
        return out

    norm = np.concatenate([per_row(value.astype(np.float64) ** 2, sizes) for _, value, sizes in parts])
    step = 4.0 / (np.percentile(norm, 95) + 1)
    w, b = np.zeros(n_features), 0.0
    v_w, v_b = np.zeros(n_features), 0.0
    for _ in range(steps):
        gradient, total = PENALTY / n * w, 0.0
        for rows, (feature, value, sizes) in zip(bounds, parts):
            p = 1 / (1 + np.exp(-np.clip(per_row(w[feature] * value, sizes) + b, -40, 40)))
            g = weight[rows] * (p - y[rows])
            gradient += np.bincount(feature, np.repeat(g, sizes) * value, n_features)
            total += g.sum()
        v_w, v_b = 0.95 * v_w - step * gradient, 0.95 * v_b - step * total
        w, b = w + v_w, b + v_b
    return w, b


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        dense = shared.value.dense()
        for batch in batches:
            scores = shared.value.scores(batch["text"].to_pylist(), dense)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], ["doc_id", "score"])

    return documents(docs).mapInArrow(run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier trained on them does not reject."""
    model = train(docs, labels)
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        dense = shared.value.dense()
        for batch in batches:
            yield batch.filter(pa.array(shared.value.scores(batch["text"].to_pylist(), dense) < threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
