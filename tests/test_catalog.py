"""Every catalogued query against its SQL, and the shape of every plan."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from issuerlake.plans.catalog import CATALOG
from oracle import compare, duck

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(name for name, q in CATALOG.items() if q.sql))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], FOLDER) is None


def test_every_query_has_sql():
    assert set(CATALOG) <= set(entry.queries()) and set(CATALOG) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(CATALOG) - {"streamed_history", "stored_upserts", "stored_inserts"}))
def test_plan_scales(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "Python", "Pandas"):
        assert bad not in plan
    # Pages of a document are numbered whole: a document is as large as one task's row anyway.
    # Spark plans no limit for 1,000 ranks or more: there the cut is a ranking of its own (tests/test_skew.py).
    if not name.startswith("search_by") and name not in ("financial_pages", "many_top_lines"):
        # Every ranking is cut in the map tasks, before its shuffle.
        windows, limits = len(re.findall(r"\bWindow \[", plan)), len(re.findall("WindowGroupLimit", plan))
        assert limits >= windows


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "data_evento" and df.count() > 0
