"""Exact duplicates by sorting content.

Rows are dealt by range: Spark samples splitters over (first characters, 64-bit content hash, doc_id), so equal texts
lie next to each other and a text with very many copies spreads over several partitions by doc_id.  Each partition is
sorted externally; one pass over it compares every text with its neighbour in full and closes a run where they
differ.  Runs inside a partition are final.  Only the first and the last run of a partition can go on in another
one: these few meet by their full text, and their totals return to their rows.

The splitters are sampled from short keys (64 characters and two numbers), never from whole texts.

Texts are equal when identical; a null text counts as empty.  Of equal texts the row with the largest doc_id stays;
a null doc_id is smaller than any other, and of rows repeating both text and doc_id one stays.  Every row is
returned, dropped ones too.  An empty table gives an empty result; other columns are ignored, or carried by
``keep_one``.
"""
from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, stored

PREFIX = 64
OUT_ROWS = 2048
# Reserved names, apart from any input's own columns.
ID, HEAD, HASH = "__sort_id", "__sort_head", "__sort_hash"
SHA, KEEP, SIZE, LAST, RUN, RUN_TEXT = ("__run_sha", "__run_keep", "__run_size", "__run_last", "__run_id", "__run_text")
RUNS = [T.StructField(SHA, T.StringType()), T.StructField(KEEP, T.LongType()), T.StructField(SIZE, T.LongType()),
        T.StructField(LAST, T.BooleanType()), T.StructField(RUN, T.LongType()), T.StructField(RUN_TEXT, T.StringType())]


def content_sort(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """All columns of ``docs``, sorted by content within range partitions."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("*", F.col("doc_id").cast("long").alias(ID), F.substring(text, 1, PREFIX).alias(HEAD),
                        F.xxhash64(text).alias(HASH))
    keys = [HEAD, HASH, ID]
    dealt = keyed.repartitionByRange(partitions, *keys) if partitions else keyed.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(HEAD, HASH, text, ID).drop(HEAD, HASH)


def _runs(ordered: DataFrame, carry: list[str]) -> DataFrame:
    """Carried columns with their run's digest, survivor and size; boundary runs are named by RUN, and still open."""
    schema = T.StructType([*ordered.select(*carry).schema.fields, *RUNS])

    def run(batches):
        partition = TaskContext.get().partitionId()
        run_types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string()]
        names = [f.name for f in RUNS]
        held: list[pa.RecordBatch] = []   # rows of the open run, as slices of their batches
        open_text, last_id, first = None, None, True

        def closed(boundary: int | None):
            size, sha = sum(b.num_rows for b in held), hashlib.sha256(open_text.encode("utf-8")).hexdigest()
            left = size
            for i, part in enumerate(held):
                n = part.num_rows
                left -= n
                last = [False] * n
                if not left:
                    last[-1] = True
                tag = None if boundary is None else 2 * partition + boundary
                # the run's text travels once, and only for boundary runs
                text = [open_text if tag is not None and not i else None] + [None] * (n - 1)
                cols = [[sha] * n, [last_id] * n, [size] * n, last, [tag] * n, text]
                yield [part.column(j) for j in range(len(carry))], [pa.array(c, t) for c, t in zip(cols, run_types)]

        out: list = []
        for batch in batches:
            texts, ids = batch["text"].to_pylist(), batch[ID].to_pylist()
            rows = batch.select(carry)
            start = 0
            for i, text in enumerate(texts):
                text = text or ""
                if text != open_text:
                    if i > start:
                        held.append(rows.slice(start, i - start))
                    if open_text is not None:
                        out.extend(closed(0 if first else None))
                        first = False
                    held, start, open_text = [], i, text
                last_id = ids[i]
            held.append(rows.slice(start))
            if len(out) >= OUT_ROWS // 8:
                yield from _joined(out, carry, names)
                out = []
        if open_text is not None:
            out.extend(closed(0 if first else 1))
        yield from _joined(out, carry, names)

    return ordered.select(*dict.fromkeys([*carry, "text", ID])).mapInArrow(run, schema)


def _joined(parts: list, carry: list[str], names: list[str]):
    for i in range(0, len(parts), OUT_ROWS):
        part = parts[i:i + OUT_ROWS]
        cols = [pa.concat_arrays([p[0][j] for p in part]) for j in range(len(carry))]
        cols += [pa.concat_arrays([p[1][j] for p in part]) for j in range(len(names))]
        yield pa.RecordBatch.from_arrays(cols, [*carry, *names])


def _resolved(runs: DataFrame) -> DataFrame:
    """Boundary runs with the same text joined: the survivor and size of all of them on every row."""
    ends = runs.where(F.col(RUN).isNotNull())
    per_run = ends.groupBy(RUN).agg(F.max(KEEP).alias(KEEP), F.count("*").alias(SIZE), F.max(RUN_TEXT).alias(RUN_TEXT))
    totals = (per_run.groupBy(RUN_TEXT)
              .agg(F.max(KEEP).alias("all_keep"), F.sum(SIZE).alias("all_size"), F.collect_list(RUN).alias("runs"))
              .select(F.explode("runs").alias("of_run"), "all_keep", "all_size"))
    # two rows of three numbers per partition at most
    return (runs.join(F.broadcast(totals), runs[RUN] == totals["of_run"], "left")
            .withColumn(KEEP, F.when(F.col(RUN).isNull(), F.col(KEEP)).otherwise(F.col("all_keep")))
            .withColumn(SIZE, F.coalesce("all_size", SIZE))
            .drop("all_keep", "all_size", "of_run", "runs"))


def copies(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    small_batches(docs.sparkSession, 512)
    ordered = content_sort(docs.select("doc_id", "text"), partitions)
    done = _resolved(stored(_runs(ordered, [ID]), "content-runs"))
    return done.select(F.col(ID).alias("doc_id"), F.col(KEEP).alias("keep_id"), F.col(SIZE).alias("group_size"),
                       (F.col(LAST) & F.col(ID).eqNullSafe(F.col(KEEP))).alias("kept"), F.col(SHA).alias("text_sha256"))


def keep_one(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, without the copies that ``copies`` drops."""
    small_batches(docs.sparkSession, 512)
    runs = stored(_runs(content_sort(docs, partitions), [*docs.columns, ID]), "content-runs")
    return _resolved(runs).where(F.col(LAST) & F.col(ID).eqNullSafe(F.col(KEEP))).select(*docs.columns)
