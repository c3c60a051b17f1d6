"""Session defaults and the one place that decides where checkpoints go."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(app_name: str = "issuerlake", cores: int | None = None) -> SparkSession:
    """A session for tests and benchmarks. On a cluster the caller brings its own."""
    cores = cores or os.cpu_count() or 4
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(cores))
    builder = builder.config("spark.driver.memory", os.environ.get("ISSUERLAKE_DRIVER_MEMORY", "8g"))
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, or a fresh local one when none is set.

    ``spark.checkpoint.dir`` names shared storage on a cluster, so a lost
    executor can be replaced without recomputing. A folder of this machine is
    only ever used by a local session.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not configured and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = configured or tempfile.mkdtemp(prefix="issuerlake-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


#: Spark's own setting to remove the shuffle files of a query when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Queries that end in here leave no shuffle files: once their rows are written, nobody reads those again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, removed when this program ends: results that are read later may still lie in it."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    settings = spark._jsparkSession.sessionState().newHadoopConf()

    def remove() -> None:
        try:
            target.getFileSystem(settings).delete(target, True)
        except Exception:  # the Java side has ended first
            pass

    atexit.register(remove)
    return path
