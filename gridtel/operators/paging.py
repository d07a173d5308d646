"""Deep pages (L1, L2): ``ORDER BY .. LIMIT n OFFSET m`` without a task that holds offset + n rows.

``sort_by_range`` stores a table once, range-partitioned on the order into parts of about ``rows_per_range`` rows, with the
row count of every part beside it.  ``page`` adds up the counts to find the few parts that hold the page and reads only
those: a task sorts at most a part, however deep the page lies.  For the first pages of an unsorted table the
plain top-k (``registry.page_by_id``, ``analytics.newest_first_page``) needs no stored copy.

The order must end in a full tie-breaker: rows that are equal under it have no defined order between them, and all of them
lie in one part, whatever its size.  Nulls come first in ascending columns and last in descending ones, as in Spark.
Cases: an offset past the end, or an empty table, gives an empty page with the table's columns; a negative offset counts
as 0; limits are clamped as everywhere (default 100, at most 1000).
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .registry import clamp_page

ROWS_PER_RANGE = 200_000
RANGE = "_range"  # partition folder; must not be a column of the table

Order = Sequence[tuple[str, bool]]  # (column, ascending)


def _order(order: Order) -> list[Column]:
    return [F.col(c).asc() if ascending else F.col(c).desc() for c, ascending in order]


def sort_by_range(df: DataFrame, path: str, order: Order, rows_per_range: int = ROWS_PER_RANGE) -> None:
    """Store ``df`` below ``path`` in ranges of ``order``, and the number of rows of each."""
    if RANGE in df.columns:
        raise ValueError(f"column {RANGE} is reserved")
    spark = df.sparkSession
    parts = max(1, math.ceil(df.count() / rows_per_range))
    rows = df.repartitionByRange(parts, *_order(order)).withColumn(RANGE, F.spark_partition_id())
    rows.sortWithinPartitions(RANGE, *_order(order)).write.partitionBy(RANGE).parquet(f"{path}/rows")
    stored = _rows(spark, path, df.schema)
    stored.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n")).coalesce(1).write.parquet(f"{path}/counts")


def _rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(RANGE, T.IntegerType())])).parquet(f"{path}/rows")


def page(spark: SparkSession, path: str, schema: T.StructType, order: Order, limit=None, offset: int = 0) -> DataFrame:
    """One page of a table that ``sort_by_range`` stored (``schema``: of that table, without the range)."""
    n, offset = clamp_page(limit), max(int(offset), 0)
    # one row per stored part, in one task: a table of 10^12 rows has 5 million of them
    before = F.sum("n").over(Window.orderBy(RANGE)) - F.col("n")
    parts = spark.read.schema(f"{RANGE} int, n long").parquet(f"{path}/counts").withColumn("start", before)
    wanted = parts.filter((F.col("start") < offset + n) & (F.col("start") + F.col("n") > offset)).collect()  # at most n parts
    rows = _rows(spark, path, schema).filter(F.col(RANGE).isin([r[RANGE] for r in wanted])).drop(RANGE)
    ordered = rows.orderBy(*_order(order))
    skip = offset - min((r["start"] for r in wanted), default=offset)
    return ordered.offset(skip).limit(n) if skip else ordered.limit(n)
