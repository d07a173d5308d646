"""Quality: Bradley-Terry pairwise ranking of documents, thresholded at a quantile of the scores.

A document's strength is a weighted sum of text features (shares of characters, word and line statistics).  Of a
preference pair, a document labelled good and one labelled bad, the good one wins with probability
1 / (1 + exp(-(difference of strengths))): the weights come from logistic loss on feature differences, with each
sampled document of either label in ``PAIRS`` pairs.  Strengths of *all* labelled documents outside the held-out fold are then
counted into fine bins, and the quantile at the share of bad labels becomes the strength that scores ``THRESHOLD``.

Features are read from every whole text once and stored packed, about 400 bytes a document; the texts are neither
shuffled nor read again.  Rows of the fit are a sample of at most ``GOOD_ROWS`` good and ``BAD_ROWS`` bad documents, the first by a
hash of doc_id, from rows whose crc32(doc_id) mod 5 is not 0.  Scores use the text alone.

Cases: a null text counts as empty, and an empty text has features and a score like any other; a null doc_id is held
out and trains nothing; a doc_id with several labels is bad if one of them says so, null labels do not count; of rows
that repeat a doc_id the one with the largest features trains, and every row is scored; equal strengths get equal scores; without rows of one of the labels every score
is the share of good rows (0 without any); a text of any length gives one row of features; an empty table gives an
empty result; other columns are ignored.
"""
from __future__ import annotations

import math
import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, small_batches, stored

GOOD_ROWS = 4000
BAD_ROWS = 4000
PAIRS = 16         # preference pairs that a sampled document takes part in, at least
THRESHOLD = 0.3    # the score at the quantile
PENALTY = 1e-3
BIN = 1 / 64       # width of the bins that strengths are counted in
FOLDS = 5

# Printable ASCII in classes: every mark on its own, letters by case, digits together.
_CLASSES = [bytes([b]) for b in range(33, 127) if not chr(b).isalnum()] + \
           [bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58)), b" ", b"\n", b"\t\r\x0b\x0c", bytes(range(128, 256))]
_CLASS_OF = np.zeros((256, len(_CLASSES)))
for _k, _members in enumerate(_CLASSES):
    _CLASS_OF[list(_members), _k] = 1.0
_LETTERS = np.arange(97, 123)
WIDTH = len(_CLASSES) + len(_LETTERS) + 16


def features(text: str) -> np.ndarray:
    """Shares of character classes and letters, and statistics of words and lines; float32."""
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = counts[_LETTERS] + counts[_LETTERS - 32]
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x]
    n, m = max(len(words), 1), max(len(lines), 1)
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    kinds = set(words)
    share = letters / max(letters.sum(), 1)
    triples = len(set(zip(words, words[1:], words[2:])))
    alone = sum(not w.isalnum() and w.isascii() and not any(97 <= b | 32 <= 122 for b in w) for w in kinds)
    more = [math.log1p(len(raw)), math.log1p(len(words)), math.log1p(len(lines)), math.log1p(len(words) / m),
            math.log1p(sizes.mean()), math.log1p(sizes.std()), math.log1p(sizes.max()), len(kinds) / n, math.log1p(n) * len(kinds) / n,
            sum(map(operator.eq, words, words[1:])) / n, triples / max(len(words) - 2, 1), len(set(lines)) / m, alone / max(len(kinds), 1),
            sum(w[:1].isupper() for w in kinds) / max(len(kinds), 1), sum(w[-1:] in b".!?,;:" for w in kinds) / max(len(kinds), 1),
            float(-(share[share > 0] * np.log(share[share > 0])).sum())]
    return np.concatenate([np.sqrt(counts @ _CLASS_OF / max(len(raw), 1)), np.sqrt(share), more]).astype(np.float32)


def fold(doc_id="doc_id") -> F.Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS


def held_out() -> F.Column:
    return fold() == 0


def feature_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, features) of every row, features as packed float32, stored in the shared folder."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            packed = [features(t).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(packed, pa.binary())], ["doc_id", "features"])

    return stored(documents(docs).mapInArrow(run, "doc_id long, features binary"), "quality-features")


def judged_ids(labels: DataFrame) -> DataFrame:
    """(doc_id, good) of the labelled documents outside the held-out fold."""
    return labels.where("doc_id is not null and quality is not null") \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("good")).where(~held_out())


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float = 0.0
    constant: float | None = None

    def strengths(self, packed: list[bytes]) -> np.ndarray:
        x = np.frombuffer(b"".join(packed), "<f4").reshape(-1, WIDTH).astype(np.float64)
        x = np.clip((x - self.centre) / self.scale, -8, 8)
        return np.array([math.fsum(row) for row in x * self.weight])  # the same in every batch

    def scores(self, packed: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(packed), self.constant)
        z = self.strengths(packed) - self.cut + math.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def bradley_terry(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, penalty: float = PENALTY, steps: int = 25) -> np.ndarray:
    """Weights whose differences predict the winner of each pair: Newton steps on the mean logistic loss.

    Pair k joins every row of the larger side with a row of the smaller one, shifted by k strides, so each row is met
    by many opponents.
    """
    n = max(len(good), len(bad))
    of = [(np.arange(n) % len(good), (np.arange(n) + k * (n // pairs + 1)) % len(bad)) for k in range(pairs)]
    w = np.zeros(good.shape[1])
    for _ in range(steps):
        gradient, curvature = penalty * w, penalty * np.eye(len(w))
        for i, j in of:
            d = good[i] - bad[j]
            lose = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))
            gradient = gradient - d.T @ lose / (n * pairs)
            curvature = curvature + (d * (lose * (1 - lose))[:, None]).T @ d / (n * pairs)
        move = np.linalg.solve(curvature, gradient)
        w = w - move
        if np.abs(move).max() < 1e-9:
            break
    return w


def quantile(counted: list[tuple[int, int]], share: float) -> float:
    """The strength below which ``share`` of the counted rows lie: an edge of the bins."""
    total, below = sum(n for _, n in counted), 0
    for slot, n in sorted(counted):
        if below + n / 2 >= share * total:
            return slot * BIN
        below += n
    return (max(slot for slot, _ in counted) + 1) * BIN


def train(rows: DataFrame, labels: DataFrame, good_rows: int = GOOD_ROWS, bad_rows: int = BAD_ROWS) -> Model:
    """Fit on a bounded sample of ``rows`` (see ``feature_rows``); the threshold covers every labelled row outside the held-out fold."""
    judged = stored(rows.where(F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("features").alias("features"))
                    .join(judged_ids(labels), "doc_id"), "quality-judged")
    counts = {r["good"]: r["n"] for r in judged.groupBy("good").agg(F.count("*").alias("n")).collect()}
    n_bad, n_good = counts.get(0, 0), sum(n for good, n in counts.items() if good)
    none = np.zeros(WIDTH)
    if not n_bad or not n_good:
        return Model(none, none + 1, none, constant=float(bool(n_good)))

    def first(which, n):
        found = judged.where(which).select("doc_id", "features").orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).collect()
        return np.stack([np.frombuffer(r["features"], "<f4") for r in found]).astype(np.float64)

    good, bad = first("good <> 0", good_rows), first("good = 0", bad_rows)
    # both labels weigh the same in centre and scale
    centre = (good.mean(0) + bad.mean(0)) / 2
    scale = np.sqrt((((good - centre) ** 2).mean(0) + ((bad - centre) ** 2).mean(0)) / 2)
    scale[scale < 1e-6] = 1.0
    model = Model(centre, scale, none)
    model.weight = bradley_terry(*(np.clip((x - centre) / scale, -8, 8) for x in (good, bad)))
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            slots = np.floor(shared.value.strengths(batch["features"].to_pylist()) / BIN) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64))], ["slot"])

    binned = judged.select("features").mapInArrow(run, "slot long").groupBy("slot").agg(F.count("*").alias("n")).collect()
    model.cut = quantile([(r["slot"], r["n"]) for r in binned], n_bad / (n_bad + n_good))
    return model


def score(rows: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``feature_rows``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(shared.value.scores(batch["features"].to_pylist()), pa.float64())], ["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double")


def rank(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    rows = feature_rows(docs)
    return score(rows, train(rows, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
