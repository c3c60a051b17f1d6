"""Stored tables in buckets: what is opened, what a failed write leaves, and what they hold."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from issuerlake.operators import stored
from issuerlake.operators import tables as T
from issuerlake.operators.quality import duplicate_keys

SCHEMA = "code string, line int, v double"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def many(spark):
    return spark.range(2000).select(F.lpad(F.col("id").cast("string"), 8, "0").alias("code"), F.when(F.col("id") % 3 > 0, 1).alias("line"), F.lit(0.0).alias("v"))


def opened(spark, path, update, write, monkeypatch):
    """Buckets named in the plan of the rows a write commits."""
    plans, commit = [], stored._commit

    def spy(path, rows, *rest):
        plans.append(rows._jdf.queryExecution().executedPlan().toString() + "\n".join(rows.inputFiles()))
        commit(path, rows, *rest)

    monkeypatch.setattr(stored, "_commit", spy)
    write(path, update, ["code", "line"])
    return set(re.findall(r"_bucket=(\d+)", plans[0]))


@pytest.mark.parametrize("write", [T.upsert_into, T.insert_new_into])
def test_plan_opens_only_touched_buckets(spark, tmp_path, monkeypatch, write):
    path = str(tmp_path / "t")
    T.upsert_into(path, many(spark), ["code", "line"], buckets=32)
    update = frame(spark, ("00000005", 1, 1.0), ("00000005", None, 2.0))
    buckets = {r[0] for r in update.select(stored.bucket_of(update.schema, ["code", "line"], 32)).collect()}
    seen = opened(spark, path, update, write, monkeypatch)
    assert seen == {str(b) for b in buckets} and len(seen) <= 2
    after = stored.read_table(spark, path)
    assert after.count() == 2001 and duplicate_keys(after, ["code", "line"]).count() == 0


def test_null_and_padded_keys_and_reruns(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        T.upsert_into(path, frame(spark, ("00000000000191", None, 1.0), ("191", None, 2.0), (None, None, 3.0), (None, 1, 4.0)), ["code", "line"], buckets=4)
    T.upsert_into(path, frame(spark, (None, None, 30.0), ("00000000000191", 1, 5.0)), ["code", "line"])
    want = [("00000000000191", 1, 5.0), ("00000000000191", None, 1.0), ("191", None, 2.0), (None, 1, 4.0), (None, None, 30.0)]
    assert rows(stored.read_table(spark, path)) == sorted(want, key=str)
    T.insert_new_into(path, frame(spark, (None, 1, 9.0), ("new", None, 9.0)), ["code", "line"])
    assert rows(stored.read_table(spark, path)) == sorted([*want, ("new", None, 9.0)], key=str)


def test_order_makes_batches_equal(spark, tmp_path):
    old, new = frame(spark, ("a", 1, 1.0)), frame(spark, ("a", 1, 2.0))
    for name, batches in (("x", (old, new)), ("y", (new, old)), ("z", (old.union(new),))):
        for batch in batches:
            T.upsert_into(str(tmp_path / name), batch, ["code", "line"], order=["v"], buckets=3)
        assert rows(stored.read_table(spark, str(tmp_path / name))) == [("a", 1, 2.0)]


def test_columns_may_be_added_and_left_out(spark, tmp_path):
    path = str(tmp_path / "t")
    T.upsert_into(path, frame(spark, ("a", 1, 1.0), ("b", 1, 1.0)), ["code", "line"], buckets=4)
    T.upsert_into(path, spark.createDataFrame([("a", 1, "x")], "code string, line int, note string"), ["code", "line"])
    T.insert_new_into(path, spark.createDataFrame([("c", 1)], "code string, line int"), ["code", "line"])
    assert rows(stored.read_table(spark, path)) == [("a", 1, 1.0, "x"), ("b", 1, 1.0, None), ("c", 1, None, None)]
    # Keys of another type fall in the same buckets.
    T.upsert_into(path, spark.createDataFrame([("a", 1, 7.0)], "code string, line long, v double"), ["code", "line"])
    assert ("a", 1, 7.0, "x") in rows(stored.read_table(spark, path)) and stored.read_table(spark, path).count() == 3


def test_failed_writes_are_never_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    T.upsert_into(path, frame(spark, ("a", 1, 1.0)), ["code", "line"], buckets=2)
    monkeypatch.setattr(stored, "_written", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    for write in (T.upsert_into, T.insert_new_into):
        with pytest.raises(OSError):
            write(path, frame(spark, ("a", 1, 2.0), ("b", 1, 2.0)), ["code", "line"])
    monkeypatch.undo()
    assert rows(stored.read_table(spark, path)) == [("a", 1, 1.0)]
    assert stored.vacuum(spark, path) >= 2
    T.upsert_into(path, frame(spark, ("a", 1, 3.0)), ["code", "line"])
    assert rows(stored.read_table(spark, path)) == [("a", 1, 3.0)] and stored.vacuum(spark, path) == 1
    assert rows(stored.read_table(spark, path)) == [("a", 1, 3.0)]


def test_compacting_keeps_the_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        T.insert_new_into(path, frame(spark, (f"k{i}", 1, 1.0), ("same", None, float(i))), ["code", "line"], buckets=1)
    before = rows(stored.read_table(spark, path))
    assert len(before) == 5 and len(stored.table_state(spark, path).versions[0]) == 4
    stored.compact(spark, path, most=2)
    assert rows(stored.read_table(spark, path)) == before and len(stored.table_state(spark, path).versions[0]) == 1


def test_layout_is_fixed(spark, tmp_path):
    path = str(tmp_path / "t")
    T.upsert_into(path, frame(spark, ("a", 1, 1.0)), ["code", "line"], buckets=2)
    with pytest.raises(ValueError):
        T.upsert_into(path, frame(spark, ("a", 1, 1.0)), ["code"])
    with pytest.raises(ValueError):
        T.upsert_into(path, frame(spark, ("a", 1, 1.0)), ["code", "line"], buckets=3)
    with pytest.raises(ValueError):
        stored.read_table(spark, str(tmp_path / "none"))
    T.upsert_into(path, frame(spark), ["code", "line"])
    assert stored.read_table(spark, path).count() == 1
