"""Positions are counted over rows that are written once, compressed."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from issuerlake.operators import windows as W
from issuerlake.session import ensure_checkpoint_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _left(spark):
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    return {p for p in folder.rglob("*") if p.name.startswith(("rdd-", "positions-"))}


def test_sorted_rows_lie_on_disk_as_parquet(spark):
    """A checkpoint keeps every row whole and uncompressed, beside the sort's shuffle files."""
    before, setting = _left(spark), spark.conf.get(CLEANUP, None)
    row = F.to_variant_object(F.struct("id", F.lit("the same long text " * 20).alias("text")))
    rows = spark.range(0, 30_000, 1, 6).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"), row.alias("row"))
    placed = W.positions(rows, ["k"], ["v"])
    assert {(r.k, r.v): r.position for r in placed.select("k", "v", "position").collect()} == {(i % 7, i): i // 7 for i in range(30_000)}
    assert placed.where("try_variant_get(row, '$.id', 'long') = v").count() == 30_000
    (new,) = _left(spark) - before
    size = sum(p.stat().st_size for p in new.rglob("*.parquet"))
    assert new.name.startswith("positions-") and 0 < size < 30_000 * 100 and spark.conf.get(CLEANUP, None) == setting


def test_types_without_a_parquet_form_are_counted_too(spark):
    rows = spark.createDataFrame([("a", 2), ("b", 1), ("a", 1)], "k string, v int").withColumn("none", F.lit(None)).withColumn("span", F.expr("make_interval(v)"))
    got = W.positions(rows, ["k"], ["v"])
    assert got.columns == ["k", "v", "none", "span", "position"]
    assert {(r.k, r.v): r.position for r in got.select("k", "v", "position").collect()} == {("a", 1): 0, ("a", 2): 1, ("b", 1): 0}
