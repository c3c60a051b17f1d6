"""Cases in which an operator did less than its whole job."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from issuerlake.llm import search
from issuerlake.llm.jaccard import similar_sets
from issuerlake.llm.language import identify, learn
from issuerlake.llm.queries import QUERIES
from test_llm import FOLDER, jaccard_classes


@pytest.mark.parametrize("ids", [(0, 1), (98, 99)])
def test_jaccard_of_pairs_that_share_rare_and_frequent_grams(spark, ids):
    """89 of 111 n-grams: 4 of the pair only, 85 of a passage in more than FEW documents; the pair has the passage's smallest document, or not."""
    passage = [f"p{k}" for k in range(85)]
    rows = [(10 + i, " ".join([f"o{i}x{k}" for k in range(15)] + passage)) for i in range(20)]
    rows += [(i, " ".join([f"q{i}x{k}" for k in range(11)] + [f"both{k}" for k in range(4)] + passage)) for i in ids]
    want = jaccard_classes(dict(rows), 1, 80)
    assert want[ids[1]] == (100, ids[0])
    got = similar_sets(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_limits_of_rare_languages_in_large_tables(spark):
    """A language of three texts among 6,000, of the ids that come last by hash, and one of short texts only, reject noise as others do."""
    rng = np.random.default_rng(1)
    words = {x: ["".join(rng.choice(list(letters), rng.integers(2, 8))) for _ in range(60)] for x, letters in (("aa", "aeiourstln"), ("bb", "äöykptvhmi"), ("cc", "ūžšėčąqwxz"))}
    say = lambda x, n: " ".join(rng.choice(words[x], n))
    rare = [r.id for r in spark.range(6000).orderBy(F.xxhash64("id").desc()).limit(3).collect()]
    rows = [(i, say("bb", 60), "bb") if i in rare else (i, say("aa", 15), "aa") for i in range(6000)]
    rows += [(6000 + i, say("cc", 2)[:12], "cc") for i in range(5)] + [(7000, "1234 !!", "dd")]
    model = learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb", "cc"] and np.isfinite(model.limits).all()
    clean = [say("aa", 30), say("bb", 30), say("bb", 200), "bb?"]
    noise = ["".join(chr(x) for x in rng.integers(low, high, 300)) for low, high in ((0x430, 0x450), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0x3B1, 0x3C9))]
    noise += ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 300)) for _ in range(4)]
    asked = spark.createDataFrame(list(enumerate(clean + noise)), "doc_id long, text string")
    got = {r.doc_id: r for r in identify(asked, model).collect()}
    assert [got[i].rejected for i in range(len(clean + noise))] == [False] * len(clean) + [True] * len(noise)
    assert [got[i].lang_pred for i in range(3)] == ["aa", "bb", "bb"]


def test_search_of_several_shards_ranks_near_ties_alike(spark, monkeypatch):
    """Scores that differ in the seventh digit only are equal, and ranked by doc_id, whatever the number of shards and groups."""
    rows = [(i, "common " + f"f{i} " * (9000 + (i < 20))) for i in range(42)] + [(100 + i, f"f{i} common") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame([(1, "common"), (2, "common f1 f7"), (3, "f30"), (4, "none"), (5, None)], "doc_id long, text string")
    one = sorted(map(tuple, search.top_k(docs, asked, 6).collect()))
    assert [r[2] for r in one if r[0] == 1] == [100, 101, 102, 0, 1, 2]
    monkeypatch.setattr(search, "SHARD", 6)
    monkeypatch.setattr(search, "GROUP", 2)
    assert sorted(map(tuple, search.top_k(docs, asked, 6).collect())) == one
    monkeypatch.setattr(search, "SHARD", 1000)
    monkeypatch.setattr(search, "POSTINGS", 10)
    assert sorted(map(tuple, search.top_k(docs, asked, 6).collect())) == one


def test_search_query_asks_whole_documents(spark):
    ids = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()}
    got = QUERIES["op10_search"](spark, FOLDER).collect()
    asked = {r.query_id for r in got}
    assert asked and all(q % 20 == 0 for q in asked) and {r.doc_id for r in got} <= ids
    assert all(r.score > 0 for r in got) and max(r["rank"] for r in got) == 10
