"""Subword-bag text classifier: character n-gram vectors, averaged, into a linear softmax; trained jointly in numpy.

A text's features are the byte n-grams of its words, with the words' edges, hashed
into ``BUCKETS``. A misspelt word shares most of its n-grams, and so its vectors,
with the word that was learned. Training sees a bounded sample; as the softmax is
linear, what scoring needs of the model is one number per bucket and class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuerlake.llm import text as T
from issuerlake.llm.shared import Shared, materialize

BUCKETS = 1 << 17
#: Lengths of n-grams in bytes, word edges counted.
LENGTHS = (3, 4, 5, 6)
#: Rows that a model is fitted on, at most.
SAMPLE = 4000
SIZE = 4
EPOCHS = 40
DECAY = np.float32(1e-5)
#: An n-gram with a vector occurs in this share of one class's rows at least, and in this share of all rows at most.
RARE, COMMON = 0.005, 0.06
#: Times its usual odds that one class must have among a more common n-gram's rows.
ODDS = 6.0

_FOLD = T.LOWER.copy()
_FOLD[T.MARKS] = 0x20


def _buckets(chunk: T.Chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: buckets, and the byte each n-gram ends before (in a text padded by one blank before each document)."""
    n = len(chunk)
    data = np.full(len(chunk.data) + n + 1, 0x20, np.uint8)
    doc = np.repeat(np.arange(n), np.diff(chunk.bounds))
    data[np.arange(len(chunk.data)) + doc + 1] = _FOLD[chunk.data]
    blank = data == 0x20
    wide = data.astype(np.uint32) + np.uint32(1)
    for k in LENGTHS:
        size = len(data) - k + 1
        if size <= 0:
            continue
        inner = np.zeros(size, bool)
        h = np.full(size, k, np.uint32)
        for j in range(k):
            h *= np.uint32(0x01000193)
            h ^= wide[j : j + size]
            if 0 < j < k - 1:
                inner |= blank[j : j + size]
        at = np.flatnonzero(~inner & ~(blank[:size] & blank[k - 1 :]))
        h = h[at]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        yield (h & np.uint32(BUCKETS - 1)).astype(np.int64), at


def _starts(chunk: T.Chunk) -> np.ndarray:
    return chunk.bounds + np.arange(len(chunk) + 1)


def bags(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per document: its row, the buckets it has and how often."""
    for chunk in T.chunks(texts):
        starts, parts = _starts(chunk), list(_buckets(chunk))
        for i in range(len(chunk)):
            mine = [b[np.searchsorted(at, starts[i]) : np.searchsorted(at, starts[i + 1])] for b, at in parts]
            yield chunk.row + i, *np.unique(np.concatenate(mine) if mine else np.zeros(0, np.int64), return_counts=True)


@dataclass
class Model:
    """``weights``: per class and bucket, the class's part of an n-gram's vector; ``bias`` per class; ``classes`` in order."""

    classes: list
    weights: np.ndarray
    bias: np.ndarray

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Class probabilities of whole texts, a row each; a text without words gets the bias alone."""
        out = np.zeros((len(texts), len(self.classes)))
        for chunk in T.chunks(texts):
            starts = _starts(chunk)
            total, seen = np.zeros((len(chunk), len(self.classes))), np.zeros(len(chunk))
            for b, at in _buckets(chunk):
                cuts = np.searchsorted(at, starts)
                seen += np.diff(cuts)
                for c in range(len(self.classes)):
                    sums = np.concatenate([[0.0], np.cumsum(self.weights[c][b], dtype=np.float64)])
                    total[:, c] += sums[cuts[1:]] - sums[cuts[:-1]]
            out[chunk.row : chunk.row + len(chunk)] = total / np.maximum(seen, 1)[:, None] + self.bias
        out = np.exp(out - out.max(axis=1, keepdims=True)) if len(out) else out
        return out / out.sum(axis=1, keepdims=True) if len(out) else out


def _useful(per: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Buckets that get a vector, from how many rows of each class have them and how many rows each class has.

    N-grams in too few of the rows, or in very many with all classes alike, get none: the
    first say nothing of other texts, the second of the class.
    """
    total, share = rows.sum(), (rows / rows.sum())[:, None]
    seen = per.sum(axis=0)
    odds = ((per + 0.5) / (seen - per + 0.5) * (1 - share) / share).max(axis=0)
    often = (per >= np.maximum(2, RARE * share * total)).any(axis=0)
    return often & ((seen <= max(2, COMMON * total)) | (odds >= ODDS))


def fit(rows: list[tuple], balanced: bool = True, seed: int = 7) -> Model:
    """A model from ``(label, buckets, counts, total)``: vectors and softmax trained together, full batches, Adam.

    ``total`` counts all n-grams of a row; buckets that are not useful may be left out.
    With ``balanced`` every class weighs the same; without, scores follow the classes' shares.
    """
    rows = [r for r in rows if r[0] is not None and r[3]]
    classes = sorted({r[0] for r in rows})
    k = max(1, len(classes))
    flat = Model(classes or [0], np.zeros((k, BUCKETS), np.float32), np.zeros(k))
    if k == 1:
        return flat
    per = np.zeros((k, BUCKETS), np.int64)
    for name, buckets, _, _ in rows:
        per[classes.index(name), buckets] += 1
    useful = _useful(per, np.array([sum(r[0] == c for r in rows) for c in classes]))
    picked = [useful[r[1]] for r in rows]
    sizes = np.array([p.sum() for p in picked])
    kept = np.flatnonzero(sizes)
    if not len(kept):
        return flat
    # The driver holds millions of n-grams here: narrow numbers, and nothing longer than it is read.
    label = np.array([classes.index(rows[i][0]) for i in kept])
    col = np.concatenate([rows[i][1][picked[i]].astype(np.int32) for i in kept])
    val = np.concatenate([(rows[i][2][picked[i]] / rows[i][3]).astype(np.float32) for i in kept])
    del rows, picked
    sizes = sizes[kept]
    row, first = np.repeat(np.arange(len(kept), dtype=np.int32), sizes), np.concatenate([[0], np.cumsum(sizes)[:-1]])
    scale = np.float32(1 / np.add.reduceat(val, first).mean())
    val *= scale
    count = np.bincount(col, minlength=BUCKETS)
    used = np.flatnonzero(count)
    begin = np.concatenate([[0], np.cumsum(count[used])[:-1]])
    place = np.zeros(BUCKETS, np.int32)
    place[used] = np.arange(len(used))
    col = place[col]
    turn = np.argsort(col, kind="stable").astype(np.int32)
    row_t, val_t = row[turn], val[turn]
    del row, turn

    def times(x: np.ndarray, at: np.ndarray, by: np.ndarray) -> np.ndarray:
        out = x[at]
        out *= by
        return out

    rng = np.random.default_rng(seed)
    vectors = (rng.standard_normal((len(used), SIZE)) * 0.1).astype(np.float32)
    soft = (rng.standard_normal((SIZE, k)) * 0.5).astype(np.float32)
    bias = np.zeros(k, np.float32)
    weight = 1 / np.bincount(label, minlength=k)[label] if balanced else np.ones(len(label))
    weight = weight / weight.sum()
    goal = np.eye(k, dtype=np.float32)[label]
    params = [vectors, soft, bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, EPOCHS + 1):
        mean = np.stack([np.add.reduceat(times(vectors[:, j], col, val), first) for j in range(SIZE)], axis=1)
        logit = mean @ soft + bias
        p = np.exp(logit - logit.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = ((p - goal) * weight[:, None]).astype(np.float32)
        back = slope @ soft.T
        gradients = [
            np.stack([np.add.reduceat(times(back[:, j], row_t, val_t), begin) for j in range(SIZE)], axis=1) + DECAY * vectors,
            mean.T @ slope, slope.sum(axis=0),
        ]
        for x, g, (m, v), rate in zip(params, gradients, moments, (0.5, 0.1, 0.1)):
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            x -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)).astype(np.float32)
    weights = flat.weights
    weights[:, used] = (vectors @ soft).T * scale
    return Model(classes, weights, bias.astype(float))


def sample(labelled: DataFrame, docs: DataFrame, limit: int = SAMPLE) -> list[tuple]:
    """``(label, buckets, counts, total)`` of at most ``limit`` rows of ``labelled`` (doc_id, label), chosen by a hash of the id.

    Of repeated rows of an id one counts, with the smallest label and the smallest text.
    Rows have the useful buckets only, which tasks pick: the driver gets one number per
    class and bucket first, then at most ``limit`` rows of useful buckets.
    """
    few = labelled.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    few = few.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).withColumnRenamed("doc_id", "few_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(bags(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b.astype(np.int32).tobytes() for _, b, _ in found], pa.binary()), pa.array([c.astype(np.int32).tobytes() for _, _, c in found], pa.binary())],
                ["label", "buckets", "counts"],
            )

    kind = dict(labelled.dtypes)["label"]
    picked = docs.join(F.broadcast(few), docs["doc_id"] == few["few_id"])  # at most `limit` ids
    picked = picked.groupBy("few_id").agg(F.first("label").alias("label"), F.min("text").alias("text")).select("label", "text")
    bagged = materialize(picked.mapInArrow(count, f"label {kind}, buckets binary, counts binary").where("length(buckets) > 0"), "bags")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many rows of a label have a bucket; at BUCKETS, how many rows it has."""
        for batch in batches:
            labels = batch.column(0).to_pylist()
            for name in set(labels):
                per = np.zeros(BUCKETS + 1, np.int64)
                for label, b in zip(labels, batch.column(1)):
                    if label == name:
                        per[np.frombuffer(b.as_buffer(), np.int32)] += 1
                        per[BUCKETS] += 1
                met = np.flatnonzero(per)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(met), batch.schema.field(0).type), pa.array(met.astype(np.int32)), pa.array(per[met])], ["label", "bucket", "n"])

    seen = bagged.select("label", "buckets").mapInArrow(spread, f"label {kind}, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    classes = sorted(r[0] for r in bagged.select("label").distinct().collect())
    per = np.zeros((max(1, len(classes)), BUCKETS + 1), np.int64)
    for k, name in enumerate(classes):
        mine = seen.where(F.col("label") == F.lit(name)).select("bucket", "n").toArrow()
        per[k, mine.column(0).to_numpy()] = mine.column(1).to_numpy()
    if not classes:
        return []
    useful = Shared(docs.sparkSession, _useful(per[:, :BUCKETS], per[:, BUCKETS]))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(np.frombuffer(b.as_buffer(), np.int32), np.frombuffer(c.as_buffer(), np.int32)) for b, c in zip(batch.column(1), batch.column(2))]
            kept = [useful.value[b] for b, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b[x].tobytes() for (b, _), x in zip(found, kept)], pa.binary()),
                 pa.array([c[x].tobytes() for (_, c), x in zip(found, kept)], pa.binary()), pa.array([int(c.sum()) for _, c in found], pa.int64())],
                ["label", "buckets", "counts", "total"],
            )

    # In the order of their whole bags: sums in the fit then have one order.
    got = bagged.orderBy("buckets").mapInArrow(pick, f"label {kind}, buckets binary, counts binary, total long").toArrow()
    return [
        (label.as_py(), np.frombuffer(b.as_buffer(), np.int32), np.frombuffer(c.as_buffer(), np.int32), total.as_py())
        for label, b, c, total in zip(*(got.column(i) for i in range(4)))
    ]
