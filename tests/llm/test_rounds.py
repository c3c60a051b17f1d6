"""What is sent or kept at once stays a part of the whole."""

from __future__ import annotations

import numpy as np

from issuerlake.llm import jaccard, search, subword


def _spy(monkeypatch, module):
    names, real = [], module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: names.append(name) or real(df, name))
    return names


def test_the_driver_gets_useful_grams_only(spark):
    """Tasks leave out n-grams of one row; the model is the one of whole bags."""
    texts = [f"{'calm' if i % 2 else 'rude'} word{i * 7919} " + "filler " * (i % 3) for i in range(60)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(62)], "doc_id long, label int")
    import pyarrow as pa

    whole = sorted(((i % 2, b.astype(np.int32), n.astype(np.int32), int(n.sum())) for i, b, n in subword.bags(pa.array(texts, pa.string())) if len(b)), key=lambda r: r[1].tobytes())
    rows = subword.sample(labels, docs)
    assert len(rows) == 60 and [(r[0], r[3]) for r in rows] == [(r[0], r[3]) for r in whole]
    assert sum(len(r[1]) for r in rows) < sum(len(r[1]) for r in whole) / 2
    a, b = subword.fit(rows), subword.fit(whole)
    assert a.classes == b.classes == [0, 1] and a.weights.any()
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.bias, b.bias)
    assert subword.sample(labels.where("label = 9"), docs) == []


def test_search_goes_group_by_group(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"w{i % 7} w{i % 5} w{i % 3}") for i in range(40)], "doc_id long, text string")
    asked = docs.where("doc_id < 9")
    one = sorted(map(tuple, search.top_k(docs, asked, 3).collect()))
    names = _spy(monkeypatch, search)
    monkeypatch.setattr(search, "GROUP", 3)
    monkeypatch.setattr(search, "SHARD", 15)
    assert sorted(map(tuple, search.top_k(docs, asked, 3).collect())) == one and len(one) == 27
    assert names.count("found") == 4


def test_pairs_are_verified_by_fragment(spark, monkeypatch):
    names = _spy(monkeypatch, jaccard)
    rows = [(i, " ".join(f"d{i // 2}x{k}" for k in range(40 - i % 2))) for i in range(10)]
    got = jaccard.similar_sets(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i // 2 * 2 for i in range(10)}
    assert names.count("common") == jaccard.FRAGMENTS


def test_near_copies_leave_no_spent_tables(spark, tmp_path, monkeypatch):
    """Tables that nothing reads again are removed: prefixes are on disk once, not once for every round."""
    from issuerlake.llm import shared

    monkeypatch.setattr(shared, "folder", lambda spark: f"file://{tmp_path}")
    monkeypatch.setattr(jaccard, "FEW", 2)
    base = [f"w{i}" for i in range(40)]
    texts = [" ".join(base[:39] + [f"x{i % 6}"]) for i in range(12)] + [f"own{i} text of{i} its" for i in range(5)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = _spy(monkeypatch, jaccard)
    got = {r.doc_id: r.component_id for r in jaccard.similar_sets(docs, 3, 90).collect()}
    assert got == {i: 0 if i < 12 else i for i in range(19)}
    assert names.count("prefixes") > 1 and names.count("met") == jaccard.SHARES
    left = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()}
    assert not left & {"sets", "prefixes", "ordered", "renewed", "often", "met", "pairs", "common", "edges"}


def test_search_sends_a_share_of_the_shards_at_a_time(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"w{i % 7} w{i % 5} w{i % 3}") for i in range(40)], "doc_id long, text string")
    asked = docs.where("doc_id < 9")
    one = sorted(map(tuple, search.top_k(docs, asked, 3).collect()))
    names = _spy(monkeypatch, search)
    monkeypatch.setattr(search, "SHARD", 6)
    monkeypatch.setattr(search, "ROUND", 1)
    assert sorted(map(tuple, search.top_k(docs, asked, 3).collect())) == one and len(one) == 27
    assert names.count("found") == 1 and names.count("part") > 2


def test_blocks_of_a_shard_hold_like_documents():
    """Two kinds of documents take turns by id: no block holds both, so a query of one kind opens none of the other's."""
    import numpy as np

    from issuerlake.llm import search as S

    n = 4 * S.BLOCK
    kinds = [(np.array([1, 2]), np.array([2, 1], np.int32)), (np.array([3, 4]), np.array([2, 1], np.int32))]
    index = S.Index(np.arange(n)[::-1].copy(), np.full(n, 3), [kinds[i % 2] for i in range(n)], 3.0)
    assert index.blocks == 4 and len(index.cell) - 1 == 8  # each of four words in two blocks
    for k in (10, n):
        ids, scores = index.search(np.array([1, 2]), np.ones(2), k)
        assert ids.tolist() == list(range(1, n, 2))[:k] and len(set(scores)) == 1  # equal scores by id
