"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import pickle
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from issuerlake.session import shuffles_end

_SETTING = "spark.checkpoint.dir"


def folder(spark: SparkSession) -> str:
    """The session's shared folder. Only a local session without one gets a folder of its own machine."""
    base = spark.conf.get(_SETTING, None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    base = "file://" + tempfile.mkdtemp(prefix="issuerlake-shared-")
    spark.conf.set(_SETTING, base)
    return base


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, rows: int = 0) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends there, and a lost executor costs no rerun.

    With ``rows`` a file has so many at most."""
    spark = df.sparkSession
    path = scratch(spark, name)
    with shuffles_end(spark):
        df.write.option("compression", "zstd").option("maxRecordsPerFile", rows).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def one_by_one(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` for few large rows: each lies in a file of its own, so that tasks can share them out."""
    return materialize(df, name, rows=1)


def spent(*tables: DataFrame) -> None:
    """Remove tables that ``materialize`` gave and nothing reads again, so that the disk holds what is still needed only."""
    for table in tables:
        discard(table.sparkSession, table._written)


class Shared:
    """A bounded object that tasks read; sent as bytes that need no installed package to load."""

    def __init__(self, spark: SparkSession, value: object) -> None:
        self._sent, self._value = spark.sparkContext.broadcast(cloudpickle.dumps(value)), None

    @property
    def value(self):
        if self._value is None:
            self._value = pickle.loads(self._sent.value)
        return self._value

    def end(self) -> None:
        """No task reads it any more."""
        self._sent.destroy()


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that is not read again."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
