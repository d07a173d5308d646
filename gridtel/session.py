"""Spark session settings and shared-storage helpers."""
from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC instants, ANSI casts (bad text aborts,
# as in the reference's silver layer), AQE for runtime re-planning and skew.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # operators on whole texts lower it for their own run; every query starts from this
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.ui.enabled": "false",
    # checkpoint files go when their DataFrame does
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}

# Rows of a Parquet file take many times its size in a task that sorts them, so a task reads no more than this of it.
MOST_READ_MB = 16


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "gridtel", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster ``master`` stays ``None`` and the launcher decides; tests
    and the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of SESSION_CONF to an existing session
    and make the package importable in the executors' Python workers."""
    for k, v in SESSION_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    read = "spark.sql.files.maxPartitionBytes"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsMb(spark.conf.get(read)) > MOST_READ_MB:
        spark.conf.set(read, f"{MOST_READ_MB}m")  # a smaller value of the launcher's stays
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """``addPyFile`` a zip of this package once per application.

    The pandas functions (thermal lag, Isolation Forest) are pickled by
    reference, so every executor must be able to import ``gridtel``.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="gridtel-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "gridtel"), "zip", root_dir=os.path.dirname(pkg_dir),
                                  base_dir=os.path.basename(pkg_dir))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    A cluster names it.  Only a local master, where driver and executors are
    one process, falls back to a scratch folder; elsewhere executors could not
    read what the driver's folder holds, so an unset value is an error.  The
    value is also registered as the RDD checkpoint dir so
    ``DataFrame.checkpoint()`` writes there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="gridtel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    jsc = spark.sparkContext._jsc
    if jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path


# Shuffle files of a finished statement stay on disk until the driver happens to collect its garbage, unless this is on.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Statements run in here delete their shuffle files when they end: for frames that are written once and read from files."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back: the plan behind it runs once."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike ``localCheckpoint``) and bounds the plan
    of iterative jobs.
    """
    checkpoint_dir(df.sparkSession)
    # Persist first: writing the checkpoint is a second job that would otherwise
    # recompute the whole plan.
    df.persist()
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()
