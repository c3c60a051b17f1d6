"""Rows without ids, repeated rows, clashing names and targets that are hard or impossible to reach."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from issuerlake.llm import subword
from issuerlake.llm.decontaminate import clean, contamination
from issuerlake.llm.jaccard import keep_one, similar_sets
from issuerlake.llm.mixing import fit_rates, mixed, rates
from issuerlake.llm.search import top_k
from issuerlake.llm.substrings import without_repeats

PASSAGE = "the quick brown fox jumps over the lazy dog while five boxing wizards watch quietly from afar"
OTHER = "rain fell on the quiet harbour all night and every lamp along the pier went out one by one"
COLUMNS = "doc_id long, text string, times int, copy string, gram string, window int, item int, key string, own string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, 3, "c", "g", 1, 2, "k", "o") for i, t in rows], COLUMNS)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, [(None, PASSAGE), (None, OTHER), (None, None), (1, PASSAGE), (1, PASSAGE), (2, OTHER + " again"), (3, ""), (4, None), (5, "alone here")])


def test_contaminated_rows_without_an_id(spark, docs):
    items = spark.createDataFrame([(7, PASSAGE)], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.contaminated) for r in contamination(docs, items).collect())
    n, m = len(PASSAGE.split()), len(OTHER.split())
    assert got == [(0, 0, 0, False), (0, n, n, True), (0, m, 0, False), (1, n, n, True), (1, n, n, True), (2, m + 1, 0, False), (3, 0, 0, False), (4, 0, 0, False), (5, 2, 0, False)]
    kept = clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect() if r.text) == [(0, OTHER), (2, OTHER + " again"), (5, "alone here")]
    assert kept.count() == 6


def test_similar_rows_without_an_id(docs):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in similar_sets(docs, 3, 80).collect()]
    assert len(got) == 9 and got.count((1, 15, 1)) == 2
    assert sorted(c or 0 for i, _, c in got if i is None) == [0, 1, 2]
    kept = keep_one(docs, 3, 80)
    assert kept.columns == docs.columns
    # One row of id 1; the rows without an id give way to 1 and 2, and the empty one stays.
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect() if r.text) == [(1, PASSAGE), (2, OTHER + " again"), (5, "alone here")]
    assert sorted(r.doc_id or 0 for r in kept.collect() if not r.text) == [0, 3, 4]


def test_repeats_and_search_without_an_id(docs):
    got = without_repeats(docs).collect()
    assert len(got) == 9 and all(r.n_removed == 0 for r in got if r.doc_id is None)
    assert {r.doc_id for r in top_k(docs.dropDuplicates(["doc_id"]), docs.where("doc_id is null or doc_id = 2"), 3).collect()} <= {1, 2, 5}


def test_sample_takes_one_row_of_an_id(spark):
    rows = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text"))
    labels = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a")], "doc_id long, label string")
    assert len(subword.sample(labels, rows, 10)) == 1


def nonnegative_least_squares(n, p, t):
    """Totals of the best nonnegative rates, by plain projected gradient run to its end."""
    a = p * n[:, None]
    x, step = np.ones(len(n)), 1 / np.linalg.eigvalsh(a.T @ a).max()
    for _ in range(200_000):
        x = np.maximum(0, x - step * (a @ (a.T @ x - t)))
    return a.T @ x


@pytest.mark.parametrize("share", [(0.90, 0.09, 0.01), (1 / 3, 1 / 3, 1 / 3), (0.02, 0.02, 0.96)])
def test_rates_against_least_squares(spark, share):
    rng = np.random.default_rng(3)
    p = rng.dirichlet((6, 2, 0.4), 60)
    p[:3] = [[0.1, 0.1, 0.8], [0.8, 0.1, 0.1], [0.1, 0.8, 0.1]]
    n = rng.integers(1, 40, 60)
    members = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p)], "n_tokens long, chances array<double>").repartition(4)
    t = np.array(share) * n.sum()
    got, best = fit_rates(members, t), nonnegative_least_squares(n.astype(float), p, t)
    assert np.abs(got.reached - t).sum() <= np.abs(best - t).sum() + 1e-3 * n.sum()
    assert np.allclose(got.reached, best, atol=2e-3 * n.sum())
    if np.abs(best - t).max() < 1e-6 * n.sum():
        assert got.missed < 1e-3


def test_mixed_keeps_columns_of_any_name(spark):
    docs = table(spark, [(i, ("red apple " if i % 4 else "blue stone ") * 20) for i in range(120)] + [(None, "red apple")])
    labels = spark.createDataFrame([(i, "red" if i % 4 else "blue") for i in range(120)], "doc_id long, label string")
    got = mixed(docs, labels, {"red": 0.5, "blue": 0.5})
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    rated = rates(docs, labels, {"red": 0.5, "blue": 0.5})
    assert got.count() == rated.agg(F.sum("copies")).collect()[0][0]
    wanted = rated.agg(*[F.sum(F.col("n_tokens") * F.col("rate") * F.col("chances")[k]) for k in range(2)]).collect()[0]
    assert abs(wanted[0] / sum(wanted) - 0.5) < 1e-3
