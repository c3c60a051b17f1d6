"""Encoding by a table of distinct chunks against the library itself."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from issuerlake.llm import pieces
from issuerlake.llm.queries import QUERIES
from issuerlake.llm.tokens import tokenizer_path
from test_llm import FOLDER

MODEL = tokenizer_path("piece_bpe_32k.model")
PARTS = ["a", "b", "the", "\n", " ", "  ", "▁", "é", "漢", "\x00", "<s>", "</s>", "<unk>", "<0x0A>", "1", "23", "'s", "\t", "😀", "　", " the", "\r\n"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def awkward():
    rng = random.Random(5)
    texts = [None, "", " ", "   ", "a ", " a", "x" * 200_000, "long text " * 150_000, "漢字" * 3000]
    return texts + ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(500)]


@pytest.mark.parametrize("small", [False, True])
def test_ids_and_texts_are_the_librarys(spark, library, monkeypatch, small):
    if small:  # many blocks, buckets and batches
        for name, value in (("BLOCK", 300), ("SHARE", 50), ("COMMON", 3), ("OUT", 40)):
            monkeypatch.setattr(pieces, name, value)
    rows = list(enumerate(awkward())) + [(None, "no id"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, block int, ids string").repartition(3)
    got = pieces.encode(docs, MODEL, decoded=True).collect()
    want = sorted((i is None, i or 0, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, list(r.ids), r.decoded) for r in got) == want


def test_decode_and_empty_tables(spark, library):
    docs = spark.createDataFrame([(1, "Ab  c\n"), (2, None)], "doc_id long, text string")
    back = pieces.decode(pieces.encode(docs, MODEL), MODEL).collect()
    assert {r.doc_id: r.decoded for r in back} == {1: "Ab  c\n", 2: ""}
    none = pieces.encode(spark.createDataFrame([], "doc_id long, text string"), MODEL, decoded=True)
    assert none.columns == ["doc_id", "ids", "decoded"] and none.count() == 0


def test_models_that_rewrite_texts_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(MODEL, "rb").read())
    proto.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        pieces.without_prefix(proto.SerializeToString())


def test_spread_repeats_runs():
    got = pieces.spread(np.arange(6), np.array([2, 0, 3, 1]), np.array([3, 1, 0, 0, 2]))
    assert got.tolist() == [5, 0, 1, 0, 1, 2, 3, 4]


def test_query_covers_whole_texts(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op11_sentencepiece"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_numbers_of_all_sizes_come_back():
    x = np.array([0, 5, 191, 192, 193, 65_727, 65_728, 4_128_767, 4_128_768, 4_128_960, 5_000_000, (1 << 32) - 1], np.uint32)
    assert pieces.unpack_numbers(pieces.pack_numbers(x)).tolist() == x.tolist()
    assert pieces.unpack_numbers(pieces.pack_numbers(x[:0])).tolist() == []
