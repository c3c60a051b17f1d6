"""Alignment of two tokenizers against plain loops over both libraries' tokens, and the joining of fragments."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from issuerlake.llm import alignment as A
from issuerlake.llm.pieces import without_prefix
from issuerlake.llm.queries import QUERIES
from issuerlake.llm.tokens import tokenizer_path
from test_llm import FOLDER
from test_pieces import PARTS

BYTES, PIECES = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
SHOWN = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def pair():
    with open(BYTES, encoding="utf-8") as f, open(PIECES, "rb") as g:
        return A.Pair(f.read(), without_prefix(g.read()))


def tokens(pair, libraries, text):
    """(id, start, end) of both, or None."""
    a, b = libraries
    if not text:
        return None
    want, out = (" " + text).encode(), []
    for ids, known in ((a.encode(" " + text, add_special_tokens=False).ids, pair.a_bytes), (b.encode(text), pair.b_bytes)):
        if b"".join(known[i] for i in ids) != want:
            return None
        at, some = 0, []
        for i in ids:
            some.append((i, at, at + len(known[i])))
            at += len(known[i])
        out.append(some)
    return out


def brute(pair, libraries, texts):
    found, counts = [], collections.Counter()
    for text in texts:
        got = tokens(pair, libraries, text)
        if got is None:
            found.append(None)
            continue
        a, b = got
        common = sorted({e for _, _, e in a} & {e for _, _, e in b})
        links, j = [], 0
        for x, s, e in a:
            while b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                links.append((x, b[k][0]))
                k += 1
        groups, low, ia, ib = [], 0, 0, 0
        for high in common:
            parts = []
            for some, at in ((a, ia), (b, ib)):
                upto = at
                while upto < len(some) and some[upto][2] <= high:
                    upto += 1
                parts.append((",".join(str(t[0]) for t in some[at:upto]), upto))
            (left, ia), (right, ib) = parts
            groups.append(f"{left}|{right}")
        counts.update(set(links))
        found.append((len(a), len(b), groups, links))
    most = collections.defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links = f
            out.append((n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def awkward():
    rng = random.Random(3)
    words = ["the", "Étranger", "naïve", "漢字かな", "don't", "1234", "x\ny", "tab\tbed", "🙂🙂", "end.\n\n", "A  B", "<|endoftext|>", "<0x0A>", "http://a.b/c?d=e", "\x1c", "mm" * 9]
    texts = [None, "", " ", "a", "a ", MARKED, "x" * 3000, "漢" * 500, "the the the", "the the the", "no  single  blanks  here  " * 40, "line\nline\n" * 80]
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(60)]
    return texts + ["".join(rng.choices(PARTS, k=rng.randint(1, 60))) for _ in range(150)]


MARKED = "a ▁ mark in the text"


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("held", [A.HELD, 0])
def test_counts_and_groups(spark, pair, libraries, monkeypatch, small, held):
    monkeypatch.setattr(A, "HELD", held)
    if small:  # most texts are cut in ranges and joined in a tree of several levels
        for name, value in (("SPAN", 16), ("FAN", 2), ("BATCH", 100), ("REMEMBERED", 20)):
            monkeypatch.setattr(A, name, value)
    rows = [*enumerate(awkward()), (None, "no id"), (7, "again"), (7, "again")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, row int, pairs string").repartition(3)
    got = A.alignment(docs, BYTES, PIECES).collect()
    want = brute(pair, libraries, [t for _, t in rows])
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(((r.doc_id, *(r[c] for c in SHOWN)) for r in got), key=key) == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=key)


def test_joining_is_associative(pair, monkeypatch):
    monkeypatch.setattr(A, "SPAN", 5)
    for text in ("a\nb  c\nd don't  stop\nnow 12  34\n" * 3, "wordswithoutany" * 4, "漢字  かな\n" * 5):
        parts = [A.range_fragment(pair, *r) for r in A.ranges(text)]
        assert any(len(f.head[0]) + len(f.tail[0]) for f in parts)
        left = A.START
        for f in parts:
            left = A.compose(pair, left, f)
        for seed in range(5):
            rng, some = random.Random(seed), list(parts)
            while len(some) > 1:
                k = rng.randrange(len(some) - 1)
                some[k : k + 2] = [A.compose(pair, some[k], some[k + 1])]
            got = A.compose(pair, A.START, some[0])
            assert (got.text, got.n_a, got.n_b, got.n_groups, got.n_links) == (left.text, left.n_a, left.n_b, left.n_groups, left.n_links)
            assert np.array_equal(got.pairs, left.pairs) and np.array_equal(got.times, left.times)
            assert not len(got.tail[0]) and not len(got.tail[1])


def test_empty_table(spark):
    assert A.alignment(spark.createDataFrame([], "doc_id long, text string"), BYTES, PIECES).collect() == []


def test_query_covers_whole_texts(spark, pair, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r[c] for c in SHOWN) for r in QUERIES["op13_alignment"](spark, FOLDER).collect()}
    assert got == dict(zip([i for i, _ in rows], brute(pair, libraries, [t for _, t in rows])))
