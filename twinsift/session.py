"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every plan here relies on; harmless on a cluster that sets its own.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "twinsift") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TWINSIFT_DRIVER_MEMORY", "16g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of this session.

    The cluster's ``spark.checkpoint.dir`` wins (Spark applies it when the
    context starts); only where none is set and the master is local (tests)
    is a private folder chosen; on any other master that is an error. The setting itself is never modified at runtime.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not conf_dir:
        conf_dir = tempfile.mkdtemp(prefix="twinsift-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches by bytes as well as rows, so that long texts
    cannot fill a worker. Smaller values set by the user stay."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 4096),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)):
        now = str(spark.conf.get(key))
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(key, str(most))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark deletes the shuffle files of an execution when it ends, on
    all executors; for executions whose result is stored. Unlike
    ``release_shuffles`` it costs no garbage collection and no wait."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release_shuffles(spark: SparkSession) -> None:
    """Ask the driver's JVM to collect dropped plans so that Spark's cleaner
    frees shuffle files of finished steps (their results are stored). Twice,
    with a pause: a plan's files go only after the plan itself has gone."""
    import gc
    import time

    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``twinsift`` importable in the Python workers (the pandas
    functions are pickled by module reference), as ``--py-files`` would:
    the package is zipped once per application and added with
    ``addPyFile``, which Spark distributes to every executor."""
    import zipfile

    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="twinsift-pkg-"), "twinsift.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
