"""Stored tables in hash buckets (SNK-2, SNK-4): a write opens and replaces only the buckets its keys fall in.

Layout of a table folder:

``data/_bucket=B/_version=V/*.parquet``
    Rows of one bucket as one write left them. Buckets are a hash of the whole natural
    key, nulls included, so that no single issuer or day makes a bucket large.
``commits/*.parquet``
    A record per write and bucket: what the write did to the bucket (``replace`` or
    ``add``), its version, its turn, and the table's buckets, keys and schema.

A bucket holds the versions from its last ``replace`` on. Rows are written first and
recorded last, by one file: a write that fails leaves nothing that is read, and running
it again is the same as running it once. Which folders to open is known before a row is
read (at most one list of versions per bucket), so a plan names just those. One writer
at a time; readers may run beside it, as versions stay until ``vacuum``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuerlake.operators.ordering import null_safe

#: Buckets of a table unless its first write says otherwise.
BUCKETS = 256

_COMMIT = "turn long, bucket int, version string, deed string, buckets int, keys array<string>, schema string"


@dataclass
class State:
    """What is recorded of a table: its layout, and for each bucket the versions that make it up."""

    buckets: int
    keys: list[str]
    schema: T.StructType
    turn: int = 0
    versions: dict[int, list[str]] = field(default_factory=dict)


def bucket_of(schema: T.StructType, keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row: alike for keys that the table's types make equal."""
    return F.pmod(F.xxhash64(*[F.col(k).cast(schema[k].dataType) for k in keys]), F.lit(buckets)).cast("int").alias("_bucket")


def table_state(spark: SparkSession, path: str) -> State | None:
    """None before the first write. Commits come to the driver aggregated: a record per bucket."""
    try:
        commits = spark.read.schema(_COMMIT).parquet(f"{path}/commits")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = F.max(F.when(F.col("deed") == "replace", F.col("turn")))
    starts = commits.groupBy("bucket").agg(F.coalesce(last, F.lit(0)).alias("since"))
    held = commits.join(starts, "bucket").where("turn >= since").groupBy("bucket").agg(F.sort_array(F.collect_set(F.struct("turn", "version"))).alias("v"))
    shape = commits.agg(F.max(F.struct("turn", "buckets", "keys", "schema")).alias("s")).first()["s"]
    if shape is None:
        return None
    state = State(shape["buckets"], list(shape["keys"]), T.StructType.fromJson(_parsed(shape["schema"])), shape["turn"])
    state.versions = {r["bucket"]: [x["version"] for x in r["v"]] for r in held.collect()}
    return state


def _parsed(text: str) -> dict:
    import json

    return json.loads(text)


def read_table(spark: SparkSession, path: str, only: Sequence[int] | None = None) -> DataFrame:
    """The rows of a stored table, or of some of its buckets; other folders are not even listed."""
    state = table_state(spark, path)
    if state is None:
        raise ValueError(f"no table at {path}")
    return _read(spark, path, state, only)


def _read(spark: SparkSession, path: str, state: State, only: Sequence[int] | None = None) -> DataFrame:
    folders = [f"{path}/data/_bucket={b}/_version={v}" for b, held in sorted(state.versions.items()) if only is None or b in only for v in held]
    if not folders:
        return spark.createDataFrame([], state.schema)
    layout = T.StructType([*state.schema.fields, T.StructField("_bucket", T.IntegerType()), T.StructField("_version", T.StringType())])
    found = spark.read.schema(layout).option("basePath", f"{path}/data").option("ignoreMissingFiles", False).parquet(*folders)
    return found.drop("_bucket", "_version")


def _prepare(path: str, updates: DataFrame, keys: Sequence[str], buckets: int | None) -> tuple[State, list[int]]:
    """The table as it is, or as it begins, and the buckets the updates touch (at most all of them)."""
    state = table_state(updates.sparkSession, path)
    if state is None:
        state = State(buckets or BUCKETS, list(keys), T.StructType([f for f in updates.schema]))
    elif state.keys != list(keys):
        raise ValueError(f"the table at {path} has the key {state.keys}")
    elif buckets not in (None, state.buckets):
        raise ValueError(f"the table at {path} has {state.buckets} buckets")
    found = updates.select(bucket_of(state.schema, keys, state.buckets)).distinct().collect()
    return state, sorted(r["_bucket"] for r in found)


def _commit(path: str, rows: DataFrame, state: State, touched: list[int], deed: str) -> None:
    spark, version = rows.sparkSession, uuid.uuid4().hex
    dealt = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in state.schema], bucket_of(state.schema, state.keys, state.buckets), F.lit(version).alias("_version"))
    dealt.hint("rebalance", "_bucket").write.mode("append").partitionBy("_bucket", "_version").parquet(f"{path}/data")
    kept = _written(spark, path, touched, version)
    records = [(state.turn + 1, b, version, deed, state.buckets, state.keys, state.schema.json()) for b in touched if b in kept]
    if records:
        spark.createDataFrame(records, _COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/commits")


def _written(spark: SparkSession, path: str, touched: list[int], version: str) -> set[int]:
    """Buckets the version has a folder of: a bucket that got no row has none."""
    jvm = spark._jvm.org.apache.hadoop.fs
    base = jvm.Path(f"{path}/data")
    files = base.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return {b for b in touched if files.exists(jvm.Path(f"{path}/data/_bucket={b}/_version={version}"))}


def widened(state: State, updates: DataFrame) -> State:
    """The table with columns that only the updates have."""
    more = [f for f in updates.schema if f.name not in state.schema.names]
    return State(state.buckets, state.keys, T.StructType([*state.schema.fields, *more]), state.turn, state.versions)


def upsert_buckets(path: str, updates: DataFrame, keys: Sequence[str], buckets: int | None = None, order: Sequence[str] = (), **options) -> None:
    """SNK-2 on a stored table: rows of the touched buckets are read, merged and written as a new version.

    Options are those of ``upsert``. With ``order``, an update older than the stored row
    of its key changes nothing, so the result does not depend on how updates are split
    into batches. Columns only the updates have are added, null in other rows.
    """
    from issuerlake.operators.tables import last_update_wins, upsert

    state, touched = _prepare(path, updates, keys, buckets)
    state = widened(state, updates)
    target = _read(updates.sparkSession, path, state, touched)
    final = last_update_wins(updates, keys, order)
    if order:
        newer = [F.col(f"s.{c}") for c in order], [F.col(f"u.{c}") for c in order]
        older = null_safe("u", "s", keys) & (F.struct(*newer[0]) > F.struct(*newer[1]))
        final = final.alias("u").join(target.select(*keys, *order).alias("s"), older, "left_anti")
    if touched:
        _commit(path, upsert(target, final, keys, order=order, **options), state, touched, "replace")


def insert_buckets(path: str, updates: DataFrame, keys: Sequence[str], buckets: int | None = None, order: Sequence[str] = ()) -> None:
    """SNK-4 on a stored table: rows whose key is absent are added; the keys of the touched buckets are read, nothing is rewritten."""
    from issuerlake.operators.tables import last_update_wins

    state, touched = _prepare(path, updates, keys, buckets)
    state = widened(state, updates)
    known = _read(updates.sparkSession, path, state, touched).select(*keys).alias("t")
    fresh = last_update_wins(updates, keys, order).alias("u").join(known, null_safe("u", "t", keys), "left_anti").select("u.*")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in state.schema if f.name not in updates.columns]
    if touched:
        _commit(path, fresh.select("*", *missing), state, touched, "add")


def compact(spark: SparkSession, path: str, most: int = 8) -> None:
    """Rewrite the buckets that more than ``most`` versions make up."""
    state = table_state(spark, path)
    many = [] if state is None else [b for b, held in state.versions.items() if len(held) > most]
    if many:
        _commit(path, _read(spark, path, state, many), state, many, "replace")


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove versions no bucket is made of any more, recorded or not; returns how many. Run it when nobody reads or writes the table."""
    state = table_state(spark, path)
    if state is None:
        return 0
    jvm = spark._jvm.org.apache.hadoop.fs
    base = jvm.Path(f"{path}/data")
    files, gone = base.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), 0
    for b in range(state.buckets):
        folder = jvm.Path(f"{path}/data/_bucket={b}")
        if files.exists(folder):
            for found in files.listStatus(folder):
                if found.getPath().getName().removeprefix("_version=") not in state.versions.get(b, []):
                    files.delete(found.getPath(), True)
                    gone += 1
    return gone
