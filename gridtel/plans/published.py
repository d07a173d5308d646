"""Refreshes that readers see whole or not at all.

A refresh writes every table into a folder of its own, ``<base>/versions/<version>/<table>``, and only then appends one
line to the log ``<base>/published``: that small file is the swap, and a write that fails before it changes
nothing for readers.  A reader resolves the newest version once and reads all its tables from there, however long it runs.
``expire`` removes versions that were superseded longer ago than a stated time, which must exceed the longest read.
One writer at a time: versions are numbered by their time.
"""
from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "version long, published_at timestamp"
KEEP_SECONDS = 24 * 3600


def _log(spark: SparkSession, base: str) -> DataFrame | None:
    try:
        log = spark.read.schema(LOG_SCHEMA).json(f"{base}/published")
    except AnalysisException as ex:
        if ex.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return log


def current_version(spark: SparkSession, base: str) -> int | None:
    """The newest published version; None before the first."""
    log = _log(spark, base)
    return None if log is None else log.agg(F.max("version")).first()[0]


def publish(tables: Mapping[str, DataFrame], base: str, sort: Mapping[str, tuple] | None = None) -> int:
    """Write all ``tables`` as a new version and make it the current one; returns the version.

    ``sort`` names the columns a table's files are sorted by.
    """
    spark = next(iter(tables.values())).sparkSession
    version = max(int(time.time() * 1000), (current_version(spark, base) or 0) + 1)
    for name, df in tables.items():
        if sort and name in sort:
            df = df.sortWithinPartitions(*sort[name])
        df.write.parquet(f"{base}/versions/{version}/{name}")
    # one file, put in place by one rename
    spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("published_at")).coalesce(1) \
        .write.mode("append").json(f"{base}/published")
    return version


class Snapshot:
    """The tables of one version; stays on it while newer ones are published."""

    def __init__(self, spark: SparkSession, base: str, version: int | None = None):
        self.spark, self.base = spark, base
        self.version = current_version(spark, base) if version is None else version
        if self.version is None:
            raise FileNotFoundError(f"nothing is published under {base}")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/versions/{self.version}/{name}")


def expire(spark: SparkSession, base: str, keep_seconds: float = KEEP_SECONDS) -> list[int]:
    """Delete the folders of versions superseded more than ``keep_seconds`` ago, and of writes that were never published
    and are older than that; the current version always stays.  Returns the versions removed."""
    log = _log(spark, base)
    if log is None:
        return []
    # as many rows as refreshes
    at = {r["version"]: r["published_at"].timestamp() for r in log.collect()}
    published = sorted(at)
    superseded = {v: at[after] for v, after in zip(published, published[1:])}
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/versions")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    removed = []
    for status in fs.listStatus(root):
        version = int(status.getPath().getName())
        since = superseded.get(version, None if version in at else version / 1000)
        if since is not None and since < time.time() - keep_seconds:
            fs.delete(status.getPath(), True)
            removed.append(version)
    return sorted(removed)
