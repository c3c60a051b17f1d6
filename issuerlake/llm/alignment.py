"""Alignment of two tokenizers' tokens of the same text.

A is a byte-level tokenizer of blank+text, B a SentencePiece model of text (which adds
the blank). Places where tokens of both end cut the text into groups; tokens whose
bytes overlap are linked.

The tokens that end in a range of bytes make a fragment: its tokens up to the first
common end (open, as the group may have begun before), the groups between common ends
(closed: only their digest and links are kept), and the tokens after the last one
(open). Two neighbouring fragments make one: what was open between them is aligned
anew. This is associative, so fragments of a document can be joined in any bracketing.

Texts up to ``SPAN`` bytes are handled in one task; words between single blanks are
fragments without open ends, and remembered. Longer texts are cut in ranges, for each
tokenizer at the next place where its tokens must end (not the same for both), dealt
to tasks, and joined in a tree of groups of ``FAN`` fragments.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from issuerlake.llm.pieces import MARK, pack, spread, unpack, without_prefix
from issuerlake.llm.shared import Shared, materialize
from issuerlake.llm.tokens import Encoder

#: Bytes of a text that one task aligns; characters of a range of a longer one.
SPAN = 1 << 16
#: Fragments joined at once.
FAN = 16
#: Bytes of text handled at once, and words remembered by a worker, at most.
BATCH, REMEMBERED = 1 << 21, 300_000
#: Linked pairs of ids that are sent to all tasks, at most; more are joined.
HELD = 4_000_000

# A's tokens end where white space follows a visible character, B's where a mark follows another character.
_A_CUT = re.compile(r"(?<=\S)(?=[ \t\n\r])")
_B_CUT = re.compile(rf"(?<=[^ {MARK}])(?=[ {MARK}])")

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_DOC = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
_FRAGMENT = "row long, doc_id long, at long, ok boolean, solid boolean, n_a long, n_b long, n_groups long, n_links long, text binary, pairs binary, times binary, head_a binary, head_b binary, tail_a binary, tail_b binary"
_RANGE = "row long, doc_id long, at long, a_from long, a string, b_from long, b string"
_KINDS = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (x.split(" ") for x in ddl.split(", "))])


def _byte_values() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: visible ones for themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class Pair:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a_model: str, b_model: bytes) -> None:
        """``b_model``: as ``pieces.without_prefix`` gives it."""
        import sentencepiece

        self.a = Encoder(a_model, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        values = _byte_values()
        self.a_bytes = [b""] * self.a.vocabulary
        for token, i in self.a.tokenizer.get_vocab().items():
            self.a_bytes[i] = bytes(values[c] for c in token) if all(c in values for c in token) else token.encode()
        self.b_size = self.b.get_piece_size()
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace(MARK, " ").encode() for i in range(self.b_size)]
        self.a_len, self.b_len = (np.array([len(x) for x in known], np.int64) for known in (self.a_bytes, self.b_bytes))
        names = [str(i).encode() for i in range(max(self.a.vocabulary, self.b_size))]
        self.width = len(names)
        self.names = [n + mark for mark in (b",", b"|", b";") for n in names]

    def encode_a(self, texts: list[str]) -> list[np.ndarray]:
        found = [x.astype(np.int64) for x in self.a.encode(texts)]
        self.a.known = {}  # words are remembered aligned
        return found

    def encode_b(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.b.encode(texts, num_threads=1)]

    def closed(self, a: np.ndarray, b: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens (id, end) of whole groups: their text, each group's end and length of text, and linked pairs in order of A."""
        ends = _common(a[:, 1], b[:, 1])
        groups = np.concatenate([np.searchsorted(ends, a[:, 1]), np.searchsorted(ends, b[:, 1])])
        second = np.repeat([0, 1], [len(a), len(b)])
        ids = np.concatenate([a[:, 0], b[:, 0]])
        turn = np.argsort(groups * 2 + second, kind="stable")
        key = (groups * 2 + second)[turn]
        last = np.append(key[1:] != key[:-1], True)
        parts = [self.names[i] for i in (ids[turn] + self.width * last * (1 + second[turn])).tolist()]
        sizes = np.bincount(groups[turn], np.fromiter(map(len, parts), np.int64, len(parts)), len(ends)).astype(np.int64)
        first = min(a[0, 1] - self.a_len[a[0, 0]], b[0, 1] - self.b_len[b[0, 0]])
        low = np.searchsorted(b[:, 1], np.append(first, a[:-1, 1]), "right")
        high = np.searchsorted(np.append(first, b[:-1, 1]), a[:, 1], "left")
        n = high - low
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        links = np.repeat(a[:, 0], n) * self.b_size + b[np.repeat(low, n) + step, 0]
        return b"".join(parts), np.stack([ends, sizes], 1), links, n


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers in both of two rising lists."""
    return a[b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a] if len(b) else a[:0]


def _none() -> np.ndarray:
    return np.zeros((0, 2), np.int64)


@dataclass
class Fragment:
    """Tokens are rows (id, end). ``solid``: there is a common end in it; else all tokens are in ``head``."""

    ok: bool
    solid: bool
    head: tuple[np.ndarray, np.ndarray]
    tail: tuple[np.ndarray, np.ndarray]
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    text: bytes = b""
    pairs: np.ndarray = None
    times: np.ndarray = None

    def __post_init__(self) -> None:
        if self.pairs is None:
            self.pairs = self.times = np.zeros(0, np.int64)


#: The beginning of a document: a common end before any token.
START = Fragment(True, True, (_none(), _none()), (_none(), _none()))


def tally(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted, with their summed times."""
    found, where = np.unique(pairs, return_inverse=True)
    return found, np.bincount(where, times, len(found)).astype(np.int64)


def fragment(pair: Pair, a: np.ndarray, b: np.ndarray, ok: bool = True) -> Fragment:
    """Tokens of neighbouring bytes, cut at their common ends."""
    ends = _common(a[:, 1], b[:, 1])
    if not len(ends):
        return Fragment(ok, False, (a, b), (_none(), _none()))
    cut = lambda x: np.searchsorted(x[:, 1], [ends[0], ends[-1]], "right")
    (a0, a1), (b0, b1) = cut(a), cut(b)
    out = Fragment(ok, True, (a[:a0], b[:b0]), (a[a1:], b[b1:]))
    return _close(pair, out, a[a0:a1], b[b0:b1]) if a1 > a0 else out


def _close(pair: Pair, out: Fragment, a: np.ndarray, b: np.ndarray) -> Fragment:
    """``out`` with whole groups after its closed ones."""
    text, groups, links, _ = pair.closed(a, b)
    pairs, times = tally(np.concatenate([out.pairs, links]), np.concatenate([out.times, np.ones(len(links), np.int64)]))
    return replace(out, n_a=out.n_a + len(a), n_b=out.n_b + len(b), n_groups=out.n_groups + len(groups), n_links=out.n_links + len(links), text=out.text + text, pairs=pairs, times=times)


def compose(pair: Pair, x: Fragment, y: Fragment) -> Fragment:
    """The fragment of both ranges, ``y`` following ``x``."""
    left = x.tail if x.solid else x.head
    open_ = fragment(pair, *(np.concatenate([p, q]) for p, q in zip(left, y.head)), x.ok and y.ok)
    if not x.solid:
        if not y.solid:
            return open_
        out = replace(open_, tail=y.tail)
    elif not open_.solid:
        return replace(x, tail=open_.head, ok=open_.ok)
    else:  # what was open on the right of x is closed by the first common end
        out = _close(pair, x, *open_.head)
        out = replace(out, ok=open_.ok, tail=y.tail if y.solid else open_.tail)
        out = _append(out, open_)
    return _append(out, y) if y.solid else out


def _append(x: Fragment, y: Fragment) -> Fragment:
    pairs, times = tally(np.concatenate([x.pairs, y.pairs]), np.concatenate([x.times, y.times]))
    return replace(x, **{c: getattr(x, c) + getattr(y, c) for c in _COUNTS}, text=x.text + y.text, pairs=pairs, times=times)


def _packed(pairs: np.ndarray) -> bytes:
    return pack(np.diff(pairs, prepend=0).astype(np.uint64))


def _pairs(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64).astype(np.int64))


def _done(row: int, doc_id, f: Fragment | None) -> dict:
    if f is None or not f.ok:
        none = np.zeros(0, np.int64)
        return {"row": row, "doc_id": doc_id, **dict.fromkeys(_COUNTS, 0), "groups_sha256": "", "pairs": _packed(none), "times": pack(none.astype(np.uint32))}
    return {"row": row, "doc_id": doc_id, **{c: getattr(f, c) for c in _COUNTS}, "groups_sha256": hashlib.sha256(f.text[:-1]).hexdigest() if f.text else "", "pairs": _packed(f.pairs), "times": pack(f.times.astype(np.uint32))}


class Words:
    """Aligned words: between single blanks both tokenizers always cut, so a word is a fragment without open ends."""

    def __init__(self, pair: Pair) -> None:
        self.pair = pair
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.texts: list[bytes] = []
        self.numbers = np.zeros((0, 5), np.int64)  # n_a, n_b, n_groups, n_links, 1 if bytes differ
        self.links = np.zeros(0, np.int64)

    def learn(self, words: list[str]) -> None:
        """Words that begin with a single blank and end with a visible character are encoded a thousand at a time, end to end: both tokenizers cut between them."""
        plain = [w for w in words if w[0] == " " and len(w) > 1 and not w[1].isspace() and not w[-1].isspace() and MARK not in w]
        if plain and not self._learn_joined(plain):
            plain = []
        known = set(plain)
        self._learn_apart([w for w in words if w not in known])

    def _learn_joined(self, words: list[str]) -> bool:
        pair, texts = self.pair, ["".join(words[k : k + 1000]) for k in range(0, len(words), 1000)]
        ids = ([i for t in texts for i in pair.a.tokenizer.encode(t, add_special_tokens=False).ids], [i for x in pair.b.encode(texts, num_threads=1) for i in x])
        raw = [w.encode() for w in words]
        if any(b"".join([known[i] for i in x]) != b"".join(raw) for x, known in zip(ids, (pair.a_bytes, pair.b_bytes))):
            return False
        self._add(words, np.fromiter(map(len, raw), np.int64, len(raw)), *[np.array(x, np.int64) for x in ids])
        return True

    def _learn_apart(self, words: list[str]) -> None:
        if not words:
            return
        pair, raw = self.pair, [w.encode() for w in words]
        a, b = pair.encode_a(words), pair.encode_b(words)
        same = [b"".join([pair.a_bytes[i] for i in x.tolist()]) == w and b"".join([pair.b_bytes[i] for i in y.tolist()]) == w for w, x, y in zip(raw, a, b)]
        good = [k for k, x in enumerate(same) if x]
        if good:
            self._add([words[k] for k in good], np.array([len(raw[k]) for k in good]), *[np.concatenate([x[k] for k in good]) for x in (a, b)])
        bad = [w for w, x in zip(words, same) if not x]
        self.known.update(zip(bad, range(len(self.texts), len(self.texts) + len(bad))))
        self.texts += [b""] * len(bad)
        self.numbers = np.concatenate([self.numbers, np.repeat([[0, 0, 0, 0, 1]], len(bad), 0)])

    def _add(self, words: list[str], sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Remember words of so many bytes whose ids, one word after another, are ``a`` and ``b``."""
        ends = np.cumsum(sizes)
        tokens = [np.stack([x, np.cumsum(size[x])], 1) for x, size in ((a, self.pair.a_len), (b, self.pair.b_len))]
        text, groups, links, n = self.pair.closed(*tokens)
        a_word, b_word, word = (np.searchsorted(ends, x[:, 1]) for x in (*tokens, groups[:, :1].repeat(2, 1)))
        counts = [np.bincount(a_word, minlength=len(words)), np.bincount(b_word, minlength=len(words)), np.bincount(word, minlength=len(words)), np.bincount(a_word, n, len(words))]
        upto = np.cumsum(np.bincount(word, groups[:, 1], len(words)).astype(np.int64)).tolist()
        self.known.update(zip(words, range(len(self.texts), len(self.texts) + len(words))))
        self.texts += [text[x:y] for x, y in zip([0, *upto], upto)]
        self.numbers = np.concatenate([self.numbers, np.stack([*counts, np.zeros(len(words))], 1).astype(np.int64)])
        self.links = np.concatenate([self.links, links])

    def documents(self, texts: list[str]) -> list[Fragment | None]:
        """None for a text whose bytes the tokens do not give back."""
        cut = [Encoder.pieces(" " + t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.clear()
        new = list(set(chain.from_iterable(cut)).difference(self.known))
        for at in range(0, len(new), 20_000):
            self.learn(new[at : at + 20_000])
        places = np.array(list(map(self.known.__getitem__, chain.from_iterable(cut))), np.int64)
        ends = np.append(0, np.cumsum([len(words) for words in cut]))
        sums = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(self.numbers[places], 0)])
        links = spread(self.links, self.numbers[:, 3], places)
        joined, numbers = b"".join, np.diff(sums[ends], axis=0).tolist()
        out = []
        for k, (n_a, n_b, n_groups, n_links, bad) in enumerate(numbers):
            if bad:
                out.append(None)
                continue
            some, times = np.unique(links[sums[ends[k], 3] : sums[ends[k + 1], 3]], return_counts=True)
            text = joined(map(self.texts.__getitem__, places[ends[k] : ends[k + 1]].tolist()))
            out.append(replace(START, n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=n_links, text=text, pairs=some, times=times))
        return out


def _short(models: Shared):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, row = Words(Pair(*models.value)), TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            cuts = (np.flatnonzero(np.diff(np.cumsum(sizes) // BATCH)) + 1).tolist()
            for at, upto in zip([0, *cuts], [*cuts, len(batch)]):
                ids, texts = (batch.column(k).slice(at, upto - at).to_pylist() for k in (0, 1))
                full = [k for k, t in enumerate(texts) if t]
                found = dict(zip(full, words.documents([texts[k] for k in full])))
                yield pa.RecordBatch.from_pylist([_done(2 * (row + k), i, found.get(k)) for k, i in enumerate(ids)], schema=_schema(_DOC))
                row += len(ids)

    return align


def ranges(text: str) -> list[tuple[int, str, int, str]]:
    """(byte, A's slice, byte, B's slice) of the ranges of blank+text. Slices may be empty."""
    full, out = " " + text, []
    a = b = a_from = b_from = 0
    for at in range(SPAN, len(full) + SPAN, SPAN):
        found = [max(low, m.start()) if at < len(full) and (m := cut.search(full, max(at, low))) else len(full) for cut, low in ((_A_CUT, a), (_B_CUT, b))]
        out.append((a_from, full[a : found[0]], b_from, full[b : found[1]]))
        a_from, b_from = a_from + len(out[-1][1].encode()), b_from + len(out[-1][3].encode())
        a, b = found
    return out


def _cut_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 32
    for batch in batches:
        for k in range(len(batch)):  # one long text at a time
            i, text = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
            some = [{"row": 2 * row + 1, "doc_id": i, "at": at, "a_from": x, "a": s, "b_from": y, "b": t} for at, (x, s, y, t) in enumerate(ranges(text))]
            yield pa.RecordBatch.from_pylist(some, schema=_schema(_RANGE))
            row += 1


def range_fragment(pair: Pair, a_from: int, a: str, b_from: int, b: str) -> Fragment:
    ids = (pair.encode_a([a])[0] if a else np.zeros(0, np.int64), pair.encode_b([b])[0] if b else np.zeros(0, np.int64))
    same = [b"".join([known[i] for i in x.tolist()]) == s.encode() for x, known, s in zip(ids, (pair.a_bytes, pair.b_bytes), (a, b))]
    tokens = [np.stack([x, start + np.cumsum(size[x])], 1) for x, size, start in zip(ids, (pair.a_len, pair.b_len), (a_from, b_from))]
    return fragment(pair, *tokens, all(same)) if all(same) else Fragment(False, False, (_none(), _none()), (_none(), _none()))


def _stored(row: int, doc_id, at: int, f: Fragment) -> dict:
    flat = {f"{end}_{side}": x.tobytes() for end in ("head", "tail") for side, x in zip("ab", getattr(f, end))}
    return {"row": row, "doc_id": doc_id, "at": at, "ok": f.ok, "solid": f.solid, "text": f.text, "pairs": _packed(f.pairs), "times": pack(f.times.astype(np.uint32)), **{c: getattr(f, c) for c in _COUNTS}, **flat}


def _loaded(r: dict) -> Fragment:
    open_ = [tuple(np.frombuffer(r[f"{end}_{side}"], np.int64).reshape(-1, 2) for side in "ab") for end in ("head", "tail")]
    return Fragment(r["ok"], r["solid"], *open_, **{c: r[c] for c in _COUNTS}, text=r["text"], pairs=_pairs(r["pairs"]), times=unpack(r["times"], np.uint32).astype(np.int64))


def _fragments(models: Shared):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(*models.value)
        for batch in batches:
            for r in batch.to_pylist():
                f = range_fragment(pair, r["a_from"], r["a"], r["b_from"], r["b"])
                yield pa.RecordBatch.from_pylist([_stored(r["row"], r["doc_id"], r["at"], f)], schema=_schema(_FRAGMENT))

    return align


def _join(models: Shared, last: bool):
    kept: list[Pair] = []

    def join(rows: pa.Table) -> pa.Table:
        if not kept:
            kept.append(Pair(*models.value))
        rows = sorted(rows.to_pylist(), key=lambda r: r["at"])
        f = START if last else _loaded(rows[0])
        for r in rows if last else rows[1:]:
            f = compose(kept[0], f, _loaded(r))
        r = rows[0]
        out = _done(r["row"], r["doc_id"], f) if last else _stored(r["row"], r["doc_id"], r["at"] // FAN, f)
        return pa.Table.from_pylist([out], schema=_schema(_DOC if last else _FRAGMENT))

    return join


def aligned(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, int]:
    """A row for each row of ``docs`` with its counts, groups and distinct linked pairs (A's id times B's vocabulary plus B's id), stored; and B's vocabulary."""
    import sentencepiece

    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        a_model, b_model = f.read(), g.read()
    models = Shared(spark, (a_model, without_prefix(b_model)))  # two vocabulary files
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    long = F.coalesce(F.octet_length("text"), F.lit(0)) > SPAN
    short = rows.where(~long).mapInArrow(_short(models), _DOC)
    cut = rows.where(long).mapInArrow(_cut_long, _RANGE).repartition(F.col("row"), F.col("at"))
    fragments = materialize(cut.mapInArrow(_fragments(models), _FRAGMENT), "fragments")
    parts = (fragments.agg(F.max("at")).first()[0] or 0) + 1
    while parts > FAN:
        fragments = fragments.groupBy("row", F.expr(f"at div {FAN}")).applyInArrow(_join(models, False), _FRAGMENT)
        parts = -(-parts // FAN)
    joined = fragments.groupBy("row").applyInArrow(_join(models, True), _DOC)
    return materialize(short.unionByName(joined), "aligned"), sentencepiece.SentencePieceProcessor(model_proto=b_model).get_piece_size()


def pair_counts(documents: DataFrame, b_size: int) -> DataFrame:
    """``pair, n, best``: documents that hold a pair linked, and whether no pair of the same A id has more."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = [_pairs(x) for x in batch.column(0).to_pylist()]
            found, n = np.unique(np.concatenate([np.zeros(0, np.int64), *some]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["pair", "n"])

    counts = documents.select("pairs").mapInArrow(distinct, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.expr(f"pair div {b_size}")))  # B's vocabulary bounds a window
    return counts.withColumn("best", F.col("n") == most)


def alignment(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for each row of ``docs`` (doc_id, text).

    ``n_best``: links whose pair of ids stands in most documents among the pairs of its
    A id, ties included; ``count_sum``: the sum over links of the documents that hold
    the pair linked. Null doc_ids and repeated rows are rows like others (a repeated row
    counts as a further document). Null and empty texts, and texts that either tokenizer
    does not give back byte by byte, have no tokens: zeros and ''. Other columns are
    ignored. The groups of one text, as written for the digest, must fit a value of 2 GB.
    """
    documents, b_size = aligned(docs, a_path, b_path)
    counts = materialize(pair_counts(documents, b_size), "pairs")
    shown = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if counts.count() <= HELD:
        known = counts.orderBy("pair").toArrow()  # at most HELD rows
        sent = Shared(docs.sparkSession, tuple(known.column(k).to_numpy() for k in ("pair", "n", "best")))
        extra = _schema("n_best long, count_sum long")

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pair, n, best = sent.value
            for batch in batches:
                out = []
                for keys, times in zip(batch.column("pairs").to_pylist(), batch.column("times").to_pylist()):
                    at, t = np.searchsorted(pair, _pairs(keys)), unpack(times, np.uint32).astype(np.int64)
                    out.append({"n_best": int(t[best[at]].sum()), "count_sum": int((t * n[at]).sum())})
                more = pa.RecordBatch.from_pylist(out, schema=extra)
                yield pa.RecordBatch.from_arrays([more.column(c) if c in extra.names else batch.column(c) for c in shown], shown)

        kinds = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in shown)
        return documents.mapInArrow(score, kinds)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, keys, times in zip(*(batch.column(k).to_pylist() for k in range(3))):
                pairs = _pairs(keys)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), row)), pa.array(pairs), pa.array(unpack(times, np.uint32).astype(np.int64))], ["row", "pair", "times"])

    links = documents.select("row", "pairs", "times").mapInArrow(opened, "row long, pair long, times long").join(counts, "pair")
    sums = links.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return documents.join(sums, "row", "left").select(*[F.coalesce(c, F.lit(0)).alias(c) if c in ("n_best", "count_sum") else F.col(c) for c in shown])
