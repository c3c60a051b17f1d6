"""Keyed table maintenance and incremental selection (SNK-2..9, INC-1..3).

Frames in, frames out, plus ``*_into`` forms that maintain a partitioned Parquet
table: they rewrite only the buckets or partitions the updates touch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuerlake.operators.ordering import null_safe, up
from issuerlake.operators.stored import insert_buckets, upsert_buckets
from issuerlake.operators.windows import dedupe


def last_update_wins(updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key; without an order the greatest row in all its columns, so that reruns agree."""
    unordered = ("map", "variant")
    rest = [
        f.name for f in updates.schema
        if f.name not in keys and f.name not in order and f.dataType.typeName() not in unordered
    ]
    ties = [F.col(c).desc_nulls_last() for c in [*order, *rest]] or [up(keys[0])]
    return dedupe(updates, keys, ties)


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    order: Sequence[str] = (),
    touch: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """SNK-2, SNK-3, SNK-7: insert or update by natural key, nulls being equal.

    Only ``columns`` change on a match (by default every column the updates carry);
    a null in them is written. ``touch`` names a column that receives ``now`` on
    every inserted or updated row, changed or not.
    """
    keys = list(keys)
    named = updates.columns if columns is None else columns
    given = [c for c in named if c in updates.columns and c not in keys]
    final = last_update_wins(updates, keys, order).select(*keys, *given, F.lit(True).alias("_given"))
    joined = target.alias("t").join(final.alias("u"), null_safe("t", "u", keys), "full_outer")
    matched = F.coalesce(F.col("u._given"), F.lit(False))
    stamp = now if now is not None else F.current_timestamp()

    def column(c: str) -> Column:
        kind = target.schema[c].dataType
        if c in keys:
            return F.when(matched, F.col(f"u.{c}").cast(kind)).otherwise(F.col(f"t.{c}")).alias(c)
        if c == touch:
            return F.when(matched, stamp.cast(kind)).otherwise(F.col(f"t.{c}")).alias(c)
        if c in given:
            return F.when(matched, F.col(f"u.{c}").cast(kind)).otherwise(F.col(f"t.{c}")).alias(c)
        return F.col(f"t.{c}").alias(c)

    return joined.select(*[column(c) for c in target.columns])


def insert_new(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], force: bool = False, order: Sequence[str] = ()
) -> DataFrame:
    """SNK-4: add rows whose key is absent; ``force`` overwrites present ones."""
    if force:
        return upsert(target, updates, keys, order=order)
    known = target.select(*keys).distinct().alias("t")
    fresh = last_update_wins(updates, keys, order).alias("u").join(known, null_safe("u", "t", keys), "left_anti")
    return target.unionByName(fresh.select("u.*"), allowMissingColumns=True)


def update_column(target: DataFrame, updates: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """SNK-6: set one column by key; blank values and unknown keys change nothing."""
    values = updates.where(F.coalesce(F.col(col).cast("string"), F.lit("")) != "").select(*keys, col)
    values = last_update_wins(values, keys).withColumnRenamed(col, "_value")
    return target.join(values, list(keys), "left").withColumn(col, F.coalesce("_value", col)).select(*target.columns)


def append_version(rows: DataFrame, path: str) -> None:
    """SNK-5: add versions; nothing stored is ever changed."""
    rows.write.mode("append").parquet(path)


def write_manifest(rows: DataFrame, path: str) -> None:
    """SNK-9: link catalogue or download manifest as JSON lines."""
    rows.write.mode("overwrite").json(path)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """SNK-1, SNK-8: one folder per key.

    ``rebalance`` gathers each key in few files and, at run time, splits a key too
    large for one task.
    """
    writer = df.hint("rebalance", *partition_by).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).format(fmt).save(path)


def _stored(path: str, updates: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The stored table, its partition values read as the updates type them; before its first row, an empty one shaped like the updates."""
    spark = updates.sparkSession
    try:
        found = spark.read.parquet(path).schema
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], updates.schema)
    # Guessed types would turn a tax id into a number.
    fields = [updates.schema[f.name] if f.name in partition_by else f for f in found]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _touched(path: str, updates: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of the partitions the updates name, a null partition included."""
    parts = updates.select(*partition_by).distinct().alias("p")
    stored = _stored(path, updates, partition_by).alias("s")
    return stored.join(parts, null_safe("s", "p", partition_by), "left_semi")


def upsert_into(
    path: str, updates: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = (), order: Sequence[str] = (),
    buckets: int | None = None, **options
) -> None:
    """SNK-2 on a stored table, in hash buckets of the key (``operators.stored``) unless partition columns are named.

    With ``partition_by``, columns of the key, only partitions named by the updates are replaced (dynamic partition overwrite);
    finding them reads the table's partition columns. With ``order``, an update that
    is older than the stored row of its key changes nothing, so the result does not
    depend on how updates are split into batches. Running it twice leaves the same rows.
    """
    if not partition_by:
        return upsert_buckets(path, updates, keys, buckets, order, **options)
    missing = set(partition_by) - set(keys)
    if missing:
        raise ValueError(f"partition columns must belong to the key: {sorted(missing)}")
    target = _touched(path, updates, partition_by)
    final = last_update_wins(updates, keys, order)
    if order:
        newer = [F.col(f"s.{c}") for c in order], [F.col(f"u.{c}") for c in order]
        older = null_safe("u", "s", keys) & (F.struct(*newer[0]) > F.struct(*newer[1]))
        final = final.alias("u").join(target.select(*keys, *order).alias("s"), older, "left_anti")
    write_partitioned(upsert(target, final, keys, order=order, **options), path, partition_by)


def insert_new_into(
    path: str, updates: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = (), order: Sequence[str] = (),
    buckets: int | None = None,
) -> None:
    """SNK-4 on a stored table, bucketed or partitioned: absent rows are appended, nothing is rewritten."""
    if not partition_by:
        return insert_buckets(path, updates, keys, buckets, order)
    known = _touched(path, updates, partition_by).select(*keys).distinct().alias("t")
    fresh = last_update_wins(updates, keys, order).alias("u").join(known, null_safe("u", "t", keys), "left_anti")
    fresh.select("u.*").write.mode("append").partitionBy(*partition_by).parquet(path)


def changed_files(listing: DataFrame, tracker: DataFrame, force: bool = False) -> DataFrame:
    """INC-1: files whose modification time differs from the tracked one, or is not tracked."""
    if force:
        return listing
    seen = tracker.select("path", F.col("modified_at").alias("_seen"))
    return listing.join(seen, "path", "left").where(~F.col("modified_at").eqNullSafe(F.col("_seen"))).drop("_seen")


def outdated_outputs(inputs: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """INC-1: keys whose newest input is not older than their output, or that have no output."""
    newest = inputs.groupBy(key).agg(F.max("modified_at").alias("newest_input"))
    built = outputs.groupBy(key).agg(F.max("modified_at").alias("built_at"))
    return newest.join(built, key, "left").where(
        F.col("built_at").isNull() | (F.col("built_at") <= F.col("newest_input"))
    )


def listing_diff(source: DataFrame, destination: DataFrame, seconds: float = 1.0) -> DataFrame:
    """INC-2: state of every path: ``new``, ``changed``, ``same`` or ``extra``.

    Equal size and modification times less than ``seconds`` apart are the same.
    """
    s = source.select("path", F.col("size").alias("_ss"), F.col("modified_at").cast("double").alias("_sm"))
    d = destination.select("path", F.col("size").alias("_ds"), F.col("modified_at").cast("double").alias("_dm"))
    same = (F.abs(F.col("_sm") - F.col("_dm")) < seconds) & (F.col("_ss") == F.col("_ds"))
    return s.join(d, "path", "full_outer").select(
        "path",
        F.when(F.col("_ds").isNull(), "new").when(F.col("_ss").isNull(), "extra").when(same, "same")
        .otherwise("changed").alias("state"),
    )


def new_keys(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """INC-3: distinct keys not known yet."""
    return df.select(*keys).distinct().join(known.select(*keys).distinct(), list(keys), "left_anti")
