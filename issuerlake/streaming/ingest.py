"""Continuous ingest of landing files (INC-4).

The file source keeps its own record of the files it has read, in the
checkpoint, which is what skipping unchanged inputs amounts to on a stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from issuerlake.operators.tables import insert_new_into, upsert_into


def ingest_available(
    spark: SparkSession, path: str, schema: T.StructType, apply: Callable[[DataFrame, int], None], checkpoint: str,
    fmt: str = "json", max_files: int | None = None, **options,
) -> None:
    """INC-4: hand every file not read before to ``apply``, in batches, then stop.

    ``checkpoint`` must lie on storage all executors share. A batch that failed is
    handed over again, so ``apply`` must be idempotent; the sinks below are.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.load(path).writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def upserting(
    table: str, keys: Sequence[str], partition_by: Sequence[str] = (), clean: Callable[[DataFrame], DataFrame] = lambda df: df, **options
) -> Callable[[DataFrame, int], None]:
    """A sink that cleans a batch and upserts it into a stored table; without partition columns only touched buckets are opened."""

    def apply(batch: DataFrame, _: int) -> None:
        upsert_into(table, clean(batch), keys, partition_by, **options)

    return apply


def inserting(
    table: str, keys: Sequence[str], partition_by: Sequence[str] = (), clean: Callable[[DataFrame], DataFrame] = lambda df: df, **options
) -> Callable[[DataFrame, int], None]:
    """A sink that appends only rows whose key the stored table lacks."""

    def apply(batch: DataFrame, _: int) -> None:
        insert_new_into(table, clean(batch), keys, partition_by, **options)

    return apply
