from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from issuerlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("issuerlake-tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def value(spark):
    """One value of an expression over one row."""

    def run(expression, **columns):
        from pyspark.sql import functions as F

        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()]) if columns else spark.range(1)
        return row.select(expression.alias("x")).collect()[0]["x"]

    return run


@pytest.fixture
def values(spark):
    """Values of an expression of column ``c`` over many texts."""

    def run(make, texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
        return [r["x"] for r in df.select("i", make("c").alias("x")).orderBy("i").collect()]

    return run
