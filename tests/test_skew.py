"""Operators over data in which one key holds most of the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from issuerlake.operators import aggregates as A
from issuerlake.operators import joins as J
from issuerlake.operators import windows as W
from issuerlake.operators.ordering import down, up

ROWS = 200_000


def hot(spark):
    """Two thirds of the rows belong to key 0."""
    ids = spark.range(0, ROWS, 1, 16)
    key = F.when(F.col("id") < ROWS * 2 // 3, 0).otherwise(F.col("id") % 1000)
    return ids.select(key.alias("k"), "id", (F.col("id") % 97).alias("v"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 9000).cast("int")).alias("d"))


def test_rankings_leave_the_hot_key_in_the_map_tasks(spark):
    df = hot(spark)
    latest = W.latest_per(df, ["k"], [down("id")])
    hottest = df.where("k = 0").agg(F.max("id")).collect()[0][0]
    assert [r.id for r in latest.where("k = 0").collect()] == [hottest]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    # One limit before the shuffle and one after it.
    assert plan.count("WindowGroupLimit") == 2
    top = W.top_n_per(df, ["k"], [down("id"), up("v")], 3)
    assert {r.total for r in top.where("k = 0").collect()} == {df.where("k = 0").count()}


def test_counts_and_sets_are_exact(spark):
    df = hot(spark)
    n = df.where("k = 0").count()
    assert A.count_by(df, "k").where("k = 0").collect()[0].n == n
    other = df.where("v < 10")
    row = J.set_compare(df.select("k", "v"), other.select("k", "v"), "k", "v").where("k = 0").collect()[0]
    assert (row.n_a, row.n_b, row.only_a, row.common) == (97, 10, 87, 10)
    intake = J.document_intake(df.select("k", F.col("v").alias("h")), other.select("k", F.col("v").alias("h")), "k", ["k", "h"])
    got = intake.where("k = 0").collect()[0]
    assert got.received == n and got.new + got.skipped == n


def test_nested_children_come_in_bounded_parts(spark):
    parts = A.nest_children(hot(spark), ["k"], ["d", "id"], [], F.date_trunc("month", "d")).where("k = 0")
    sizes = [r.n_items for r in parts.select("n_items").collect()]
    assert len(sizes) > 200 and max(sizes) < ROWS // 100 and sum(sizes) == hot(spark).where("k = 0").count()


def test_many_ranks_of_a_hot_key(spark):
    """Beyond Spark's group limit a key is ranked in shares first; the second ranking gets at most n rows of each."""
    df = hot(spark)
    top = W.top_rows(df, ["k"], [down("v"), up("id")], 5000, rank="position")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 2 and "_share" in plan
    want = [r.id for r in df.where("k = 0").orderBy(F.desc("v"), "id").limit(5000).collect()]
    got = top.where("k = 0").orderBy("position").collect()
    assert [r.id for r in got] == want and [r.position for r in got] == list(range(1, 5001))
    pages = W.page_per(df, ["k"], [down("id")], offset=4000, limit=1000).where("k = 0")
    sorted_ids = [r.id for r in df.where("k = 0").orderBy(F.desc("id")).limit(5000).collect()]
    assert [r.id for r in pages.orderBy("position").collect()] == sorted_ids[4000:]


def test_deep_pages(spark):
    df = spark.range(0, 1_200_000, 1, 8).select((1_200_000 - F.col("id")).alias("id"), (F.col("id") % 3).alias("v"))
    assert [r.id for r in W.deep_page(df, [up("id")], 1_000_000, 5).collect()] == list(range(1_000_001, 1_000_006))
    assert W.deep_page(df, [up("id")], 1_200_000, 5).count() == 0
    assert [r.id for r in W.deep_page(df, [up("id")], 1_199_998, 50).collect()] == [1_199_999, 1_200_000]


def test_pages_by_key_walk_the_whole_frame(spark):
    """Page after page gives the sorted frame, nulls in their place."""
    rows = [(1, "a"), (None, "b"), (2, None), (2, "c"), (1, None), (None, None), (3, "z")]
    df = spark.createDataFrame(rows, "n int, t string")
    for order in ([("n", up), ("t", down)], [("n", down), ("t", up)]):
        want = [tuple(r) for r in df.orderBy(*[way(c) for c, way in order]).collect()]
        got, after = [], None
        while page := W.page_after(df, order, after, 2).collect():
            got += [tuple(r) for r in page]
            after = list(page[-1])
        assert got == want
    plan = W.page_after(df, [("n", up), ("t", up)], [1, "a"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=2" in plan


def test_hot_dates_are_split_by_keys(spark):
    from issuerlake.operators import filters, joins

    df = spark.range(10).select(F.lit("2024-01-01").alias("data_referencia"), F.col("id").cast("string").alias("ticker_deb"), F.lit(None).cast("double").alias("taxa_indicativa"), F.lit(1.0).alias("pu_indicativo"))
    assert [r.ticker_deb for r in filters.missing_rates(df).collect()] == sorted(str(i) for i in range(10))
    plan = W.order_listing(df, "history")._jdf.queryExecution().analyzed().toString()
    assert "ticker_deb" in plan.splitlines()[0] and joins.ties(df, ["data_referencia"])


def test_blocks_of_a_hot_key_and_a_hot_year(spark):
    """Positions are counted over all tasks: no array is longer than asked, though two thirds of the rows have one key and one date."""
    df = hot(spark).withColumn("d", F.when(F.col("k") == 0, F.lit("2010-05-05").cast("date")).otherwise(F.col("d")))
    blocks = A.nest_blocks(df, ["k"], ["d", "id"], ["d", "id"], 500).where("k = 0").orderBy("part").collect()
    total = df.where("k = 0").count()
    assert [b.n_items for b in blocks] == [500] * (total // 500) + ([total % 500] if total % 500 else [])
    assert [i.id for b in blocks for i in b["items"]] == [r.id for r in df.where("k = 0").orderBy("id").collect()]


def test_positions_count_null_keys_and_empty_frames(spark):
    rows = spark.createDataFrame([(None, 2), (None, 1), ("a", 5), ("a", None), ("b", 1)], "k string, v int")
    got = {(r.k, r.v): r.position for r in W.positions(rows, ["k"], ["v"]).collect()}
    assert got == {(None, 1): 0, (None, 2): 1, ("a", 5): 0, ("a", None): 1, ("b", 1): 0}
    assert W.positions(rows.limit(0), ["k"], ["v"]).count() == 0


def test_nested_statements_take_two_shuffles(spark):
    rows = spark.createDataFrame([("a", "2020", "DFP", d, c, "x", 1.0) for d in ("DRE", "BPA") for c in ("1", "2")], "cnpj string, data_ref string, tipo_doc string, demonstracao string, cd_conta string, ds_conta string, valor double")
    nested = A.nest_statements(rows)
    assert nested._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    (row,) = nested.collect()
    assert {d: sorted(m) for d, m in row.demonstracoes.items()} == {"BPA": ["1", "2"], "DRE": ["1", "2"]}
