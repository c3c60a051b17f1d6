"""Training-data operators against SQL, brute force, exact round trips and held-out labels, and on awkward inputs."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from issuerlake.llm import coder  # noqa: E402
from issuerlake.llm.counts import count_tokens, document_counts  # noqa: E402
from issuerlake.llm.decontaminate import contamination  # noqa: E402
from issuerlake.llm.jaccard import similar_sets  # noqa: E402
from issuerlake.llm.language import identify, learn  # noqa: E402
from issuerlake.llm.licenses import PHRASES, license_scan  # noqa: E402
from issuerlake.llm.mixing import rates  # noqa: E402
from issuerlake.llm.queries import QUERIES, SQL  # noqa: E402
from issuerlake.llm.search import top_k  # noqa: E402
from issuerlake.llm.substrings import without_repeats  # noqa: E402
from issuerlake.llm.tokenfiles import join_crc, roundtrip  # noqa: E402
from issuerlake.llm.tokens import Encoder, tokenizer_path  # noqa: E402
from issuerlake.llm.toxicity import toxicity  # noqa: E402
from oracle import compare, duck  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK, MARK = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, n int, words string, block int, lang string"

PASSAGE = "the quick brown fox jumps over the lazy dog while five boxing wizards watch quietly from afar"
LONG = " ".join(f"w{i}" for i in range(3000))
TEXTS = [
    PASSAGE, None, "", "   \n\t ", "one", "one two", PASSAGE, PASSAGE + " extra", "start " + PASSAGE, LONG, LONG + " tail",
    "Été 漢字 naïve " * 6, "a a a a a a a a a a a a a a a a", "Under the MIT License. Licensed under CC BY-NC 4.0.", "#2 # <|endoftext|>  x\n\n y",
    LONG.replace("w1500 ", "other "),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, i, "x", 0, "xx" if i % 2 else None) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[0]], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(FOLDER), QUERIES[name], SQL[name], FOLDER) is None


def test_contamination(spark, docs, none):
    items = spark.createDataFrame([(1, "FOX jumps over the lazy-dog while five boxing wizards"), (10, "one two"), (2, None), (3, "!!"), (4, "one two")], "item_id long, text string")
    got = contamination(docs, items).collect()
    texts, windows = texts_of(docs), {"1": "fox jumps over the lazy dog while five boxing wizards".split(), "10": ["one", "two"], "4": ["one", "two"]}
    assert len(got) == len(TEXTS) + 1
    for r in got:
        words, hit, found = MARK.findall(texts[r.doc_id].translate(FOLD)), set(), set()
        for item, window in windows.items():
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    found.add(item)
                    hit |= set(range(i, i + len(window)))
        names = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert tuple(r) == (r.doc_id, len(words), len(hit), len(found), names, bool(hit))
    assert contamination(none, items).count() == 0
    assert not any(r.contaminated for r in contamination(docs, items.limit(0)).collect())


def jaccard_classes(texts, n, percent):
    sets = {}
    for i, text in texts.items():
        w = BLANK.findall(text.translate(FOLD))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    label = {i: i for i in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return {i: (len(sets[i]), label[i]) for i in sets}


def test_jaccard(spark, docs, none):
    family = [(100 + i, f"{LONG[:400]} v{i} " + " ".join(f"x{i % 7}y{k}" for k in range(i % 5))) for i in range(40)]  # more than FEW near copies
    every = docs.select("doc_id", "text").union(spark.createDataFrame(family, "doc_id long, text string"))
    got = similar_sets(every, 3, 90).collect()
    assert len(got) == len(TEXTS) + 1 + 40
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == jaccard_classes(texts_of(every), 3, 90)
    assert similar_sets(none, 5, 80).count() == 0


def test_substrings(docs, none):
    texts, first = texts_of(docs), {}
    words = {i: BLANK.findall(t) for i, t in texts.items()}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k : k + 13]), i)
    got = without_repeats(docs).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        w, gone = words[r.doc_id], set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < r.doc_id:
                gone |= set(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert (r.n_words, r.n_removed, r.kept, r.kept_sha256) == (len(w), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest())
    assert without_repeats(none).count() == 0


def test_coder_round_trip():
    rng = np.random.default_rng(1)
    blocks = [np.minimum(rng.zipf(1.3, n), 50256) for n in (1, 2, 700, coder.BLOCK)] + [np.tile(np.arange(90), 40)[: coder.BLOCK]]
    coded = coder.encode(blocks, 50257)
    assert all((a == b).all() for a, b in zip(blocks, coder.decode(coded)))
    assert len(coded[-1]) < len(blocks[-1])  # repeats are predicted
    assert (coder.decode(coded[2:3])[0] == blocks[2]).all()  # any block alone
    with pytest.raises(coder.BlockError):
        coder.decode([coded[2][:40] + bytes([coded[2][40] ^ 1]) + coded[2][41:]])
    assert join_crc(zlib.crc32(b"abc"), zlib.crc32(b"defgh"), 5) == zlib.crc32(b"abcdefgh")


def test_token_files(spark, docs, none, tmp_path):
    tokenizer = Encoder(Path(tokenizer_path()).read_text()).tokenizer
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    want, start = [], 0
    for doc, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(tuple(r) for r in roundtrip(docs, f"file://{tmp_path}/a", tokenizer_path()).collect())
    assert got == want
    assert roundtrip(none, f"file://{tmp_path}/b", tokenizer_path()).count() == 0
    counted = document_counts(docs, f"file://{tmp_path}/c", tokenizer_path(), 50256)
    tokenizer.encode_special_tokens = True
    plain = sorted((doc, len(tokenizer.encode(text, add_special_tokens=False).ids) + 1) for doc, text in rows)
    assert sorted((r.doc_id, r.n_tokens) for r in counted.collect()) == plain


def test_count_tokens_across_blocks(spark):
    ids = np.array([5, 6, 0, 0, 7, 7, 7, 7, 7, 7, 0, 8], "<u2")
    blocks = [("f", i, ids[3 * i : 3 * i + 3].tobytes()) for i in range(4)] + [("g", 0, b"")]
    got = count_tokens(spark.createDataFrame(blocks, "file string, block long, raw binary"), 0).orderBy("doc_no").collect()
    assert [tuple(r) for r in got] == [("f", 0, 0, 3), ("f", 1, 3, 1), ("f", 2, 4, 7)]


def test_language(spark, docs, none):
    tables = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = learn(tables)
    truth = {r.doc_id: r.lang for r in tables.collect()}
    got = identify(tables, model).collect()
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got]) > 0.97
    odd = {r.doc_id: r for r in identify(docs, model).collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].rejected and odd[i].score == 0 for i in (1, 2, 3))
    assert identify(none, model).count() == 0
    assert {r.lang_pred for r in identify(docs, learn(none)).collect()} == {"und"}


def test_toxicity(spark, docs, none):
    rows = [(i, f"calm words of day {i} and {'vilestuff ' * (i % 2)} more") for i in range(300)]
    labels = [(i, i % 2) for i in range(300)] + [(0, None)]
    tables = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity(tables, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.predicted == r.doc_id % 2 for r in got if r.held_out]) > 0.95
    assert {r.score for r in toxicity(docs, none.withColumn("toxic", none["n"])).collect()} == {0.0}
    assert toxicity(none, spark.createDataFrame(labels, "doc_id long, toxic int")).count() == 0


def test_licenses(docs, none):
    texts = texts_of(docs)
    for r in license_scan(docs).collect():
        words = MARK.findall(texts[r.doc_id].translate(FOLD))
        places = sorted((i, x) for p, x in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
        at = [i for i, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(at), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and 0 <= r.score <= 1
    found = {r.doc_id: r.labels for r in license_scan(docs).collect()}
    assert found[13] == "cc-by-nc,mit" and found[0] == ""
    assert license_scan(none).count() == 0


def test_mixing(spark, none):
    rows = [(i, ("red apple " if i % 4 else "blue stone ") * 20) for i in range(200)] + [(500, None), (501, "")]
    tables = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, "red" if i % 4 else "blue") for i in range(0, 200)], "doc_id long, label string")
    got = rates(tables, labels, {"red": 0.5, "blue": 0.5}).collect()
    n, p, r = (np.array([x[k] for x in got]) for k in ("n_tokens", "chances", "rate"))
    total = (n * r) @ p
    assert (r >= 0).all() and abs(total[0] / total.sum() - 0.5) < 0.05
    assert {x.rate for x in got if x.doc_id >= 500} == {1.0}
    assert rates(none, labels).count() == 0


def test_search(spark, docs, none):
    rows = {r.doc_id: MARK.findall((r.text or "").translate(FOLD)) for r in docs.collect()}
    unique = docs.dropDuplicates(["doc_id"])
    bags = {i: collections.Counter(w) for i, w in rows.items()}
    df, n, mean = collections.Counter(w for b in bags.values() for w in b), len(rows), sum(map(len, rows.values())) / len(rows)
    got = collections.defaultdict(list)
    for r in top_k(unique, unique, 3).orderBy("rank").collect():
        got[r.query_id].append((r.doc_id, r.score))
    for q, bag in bags.items():
        score = {}
        for i, b in bags.items():
            s = sum(c * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * len(rows[i]) / mean)) for w, c in bag.items() if w in b)
            if s:
                score[i] = round(s, 6)
        best = sorted(score.items(), key=lambda x: (-x[1], x[0]))[:3]
        assert [i for i, _ in got[q]] == [i for i, _ in best] and np.allclose([s for _, s in got[q]], [s for _, s in best], atol=2e-6)
    assert top_k(none, unique, 3).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = P.one_of_each(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    classes = jaccard_classes({r.doc_id: r.text or "" for r in docs.collect()}, 5, 80)
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in classes.items() if c == i}
    got = P.run(spark, FOLDER)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 0
