"""Shared pieces of the training-data operators: words, scratch tables, Arrow batches."""
from __future__ import annotations

import bisect
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# A word after lower-casing A-Z: digits, a-z and every character beyond ASCII.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of one text in order, as UTF-8 bytes; a null text has none."""
    return text.encode("utf-8").translate(_WORD_BYTES).split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text) only, a null text read as empty: other columns cannot clash with an operator's own."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there and lost executors recompute nothing."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, records: int = 256) -> None:
    """Bound what one Arrow batch holds: whole texts may be long, so few rows travel together."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))


def spans_text(spans: list[tuple[int, int, str, int]]) -> str:
    """``kind:start:end`` by start, then by the kind's listed rank, then end; comma-joined."""
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))


def united(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges without overlaps; ranges that touch become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def touches(ranges: list[tuple[int, int]], a: int, b: int) -> bool:
    """Whether [a, b) shares a character with one of the united ranges."""
    i = bisect.bisect_left(ranges, (b,))
    return i > 0 and ranges[i - 1][1] > a
