"""Ranked search against plain scoring of every document, and its pruning."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pytest

from issuerlake.llm import pairbounds
from issuerlake.llm.queries import QUERIES, SQL
from oracle import compare, duck
from test_llm import FOLD, FOLDER

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k):
    bags = [(i, TERM.findall((t or "").translate(FOLD))) for i, t in docs]
    n, total = sum(bool(w) for _, w in bags), sum(len(w) for _, w in bags)
    df = collections.Counter(x for _, w in bags for x in set(w))
    terms = collections.defaultdict(set)
    for i, t in items:
        terms[i] |= set(TERM.findall((t or "").translate(FOLD)))
    out = []
    for item, asked in terms.items():
        scored = []
        for i, w in bags:
            tf, m = collections.Counter(w), 10 + (90 * len(w) * n) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((1_000_000_000 * tf[x]) // (1000 * tf[x] + 8 * m)) for x in asked if tf[x])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, k):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, item_id string").repartition(3)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    return sorted(map(tuple, pairbounds.ranked(d, q, k).collect()), key=str)


@pytest.mark.parametrize("seed,words,asked", [(1, 1 << 30, 1 << 30), (2, 400, 1 << 30), (3, 200, 30)])
def test_ranks_like_plain_scoring(spark, monkeypatch, seed, words, asked):
    monkeypatch.setattr(pairbounds, "WORDS", words)
    monkeypatch.setattr(pairbounds, "ASKED", asked)
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(150)] + ["É", "漢字", "9"]
    say = lambda n: " ".join(vocabulary[min(int(rng.paretovariate(0.4)) - 1, len(vocabulary) - 1)] for _ in range(n))
    docs = [(i, say(rng.randint(0, 60))) for i in range(200)]
    docs += [(500, None), (501, ""), (502, " ,;"), (None, say(30)), (7, docs[7][1]), (7, "other"), (600, "W1 w2 " * 60_000)] + [(700 + i, docs[3][1]) for i in range(30)]
    items = [(i, say(rng.randint(1, 25))) for i in range(25)] + [(90, None), (91, "..."), (92, "unknown"), (3, "w149 w148"), (None, "w5 w6"), (93, docs[3][1])]
    assert found(spark, docs, items, 5) == brute(docs, items, 5)


def test_pairs_bound_below_the_sum_and_skip(monkeypatch):
    """Two rare terms that never meet: a document gets one of them, so fewer documents are admitted than with single maxima."""
    lists = {0: (np.arange(0, 20), np.full(20, 100)), 1: (np.arange(20, 40), np.full(20, 100)), 2: (np.arange(0, 1000), np.full(1000, 90)), 3: (np.arange(0, 500), np.full(500, 85))}
    terms, joint = pairbounds.Lists.__new__(pairbounds.Lists), pairbounds.Lists.__new__(pairbounds.Lists)
    terms.of, terms.most = lists, {p: int(x.max()) for p, (_, x) in lists.items()}
    joint.of, joint.most = {(0, 1): (np.zeros(0, np.int64), np.zeros(0, np.int64))}, {(0, 1): 0}
    searcher = pairbounds.Searcher(1000, terms, joint)
    assert searcher.units([0, 1, 2]) == [(100, (0, 1)), (90, (2,))]
    top, scores = searcher.best([0, 1, 2], 10)
    assert top.tolist() == list(range(10)) and scores.tolist() == [190] * 10 and searcher.admitted == 40
    joint.of, joint.most = {}, {}
    plain = pairbounds.Searcher(1000, terms, joint)
    assert plain.best([0, 1, 2, 3], 10)[1].tolist() == [275] * 10
    assert plain.admitted > 40


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")], 3) == [] and found(spark, [(1, "a")], [], 3) == []


def test_query_matches_sql(spark):
    assert compare(spark, duck(FOLDER), QUERIES["op12_ranked_search"], SQL["op12_ranked_search"], FOLDER) is None
