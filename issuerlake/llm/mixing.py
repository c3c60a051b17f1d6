"""Mixing documents to target weights by soft membership.

A classifier learned from a labelled table gives each document a probability for
every domain. A document with rate r and n tokens is expected to add r * n * p(d)
tokens to domain d; nonnegative rates are sought whose domain totals are as near to
the targets as possible: min |sum_i r_i n_i p_i - t|^2 over r >= 0, by projected
gradient.

The gradient of a document depends only on its own n and p and on the residuals of
the totals, one number per domain. So the gradients of all steps are summed as one
vector per domain, z, and a document's rates are the sum projected: max(0, 1 - p . z).
Among rates that meet the targets these are the ones nearest to 1 (weighted by tokens).
Rare domains have small gradients: each step is scaled by the inverse second moment of
the documents whose rate is positive, and its length is the best of several tried in
the same pass. No table of rates is kept; a lost task is simply run again.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuerlake.llm import subword
from issuerlake.llm import text as T
from issuerlake.llm.shared import Shared, materialize

log = logging.getLogger(__name__)

#: Relative distance of every domain's total from its target at which steps end.
CLOSE = 1e-4
#: Gain of a step, relative to the objective, below which no step helps any more: the targets are out of reach then.
FLAT = 1e-13
#: Weight of staying near 1 where targets are out of reach: small, so that the totals come as near as they can.
STAY = 1e-11
#: Lengths of a step tried in one pass.
LENGTHS = 2.0 ** -np.arange(10)


def posteriors(docs: DataFrame, labels: DataFrame, limit: int = subword.SAMPLE) -> tuple[list, DataFrame]:
    """The domains, and ``(doc_id, n_tokens, chances)`` per row of ``docs``: words, and a probability per domain in order.

    ``labels`` has (doc_id, label); at most ``limit`` of its rows are learned from.
    Null and empty texts have 0 tokens.
    """
    docs = docs.select("doc_id", "text")
    model = subword.fit(subword.sample(labels.select("doc_id", "label"), docs, limit), balanced=False)
    shared = Shared(docs.sparkSession, model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = shared.value.scores(batch.column(1))
            n = [T.cut(c, T.BLANKS, False, hashes=False).counts for c in T.chunks(batch.column(1))]
            bounds = np.arange(0, p.size + 1, p.shape[1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(n) if n else np.zeros(0), pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(p.ravel()))],
                ["doc_id", "n_tokens", "chances"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return model.classes, docs.mapInArrow(score, f"doc_id {kind}, n_tokens long, chances array<double>")


@dataclass(frozen=True)
class Fit:
    """The summed gradient, and the totals per domain that its rates reach; ``missed``: largest relative distance from a target."""

    z: np.ndarray
    reached: np.ndarray
    missed: float


def _rates(p: np.ndarray, z: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, 1.0 - p @ z)


def fit_rates(members: DataFrame, targets: np.ndarray) -> Fit:
    """Fit ``members`` (n_tokens, chances) to target totals per domain; steps go on until all are ``CLOSE`` or none helps.

    A pass over the members per step; what comes back is a square of domains per length tried.
    """
    size, scale = len(targets), targets.sum() or 1.0
    goal = targets / scale

    def measure(points: np.ndarray) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """At each point: the objective (halved, its least is sought), totals, and second moment of the documents with a positive rate."""
        cell = 1 + size + size * size

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((len(points), cell))
            for batch in batches:
                n, p = batch.column(0).to_numpy().astype(float), batch.column(1).flatten().to_numpy().reshape(-1, size)
                for row, z in zip(out, points):
                    r = _rates(p, z)
                    row[0] += (n * r * r).sum() / 2
                    row[1 : size + 1] += (r * n) @ p
                    row[size + 1 :] += ((p * (n * (r > 0))[:, None]).T @ p).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size), pa.int32()), pa.array(out.ravel())], ["k", "x"])

        got = members.select("n_tokens", "chances").mapInArrow(add, "k int, x double").groupBy("k").agg(F.sum("x").alias("x")).collect()
        flat = np.zeros(len(points) * cell)
        for row in got:
            flat[row["k"]] = row["x"]
        return [
            (c[0] + goal @ z + STAY / 2 * z @ z, c[1 : size + 1], c[size + 1 :].reshape(size, size))
            for z, c in zip(points, flat.reshape(-1, cell) / scale)
        ]

    def missed(totals: np.ndarray) -> float:
        return float((np.abs(totals - goal) / np.maximum(goal, 1e-6)).max())

    z = np.zeros(size)
    value, totals, moment = measure(z[None])[0]
    while missed(totals) > CLOSE:
        slope = totals - goal - STAY * z
        step = np.linalg.solve(moment + (STAY + 1e-12) * np.eye(size), slope)
        points = z + LENGTHS[:, None] * step
        tried = measure(points)
        best = min(range(len(points)), key=lambda i: tried[i][0])
        if value - tried[best][0] <= FLAT * max(abs(value), 1e-9):
            break
        z, (value, totals, moment) = points[best], tried[best]
    return Fit(z, totals * scale, missed(totals))


def rates(docs: DataFrame, labels: DataFrame, weights: dict | None = None, limit: int = subword.SAMPLE) -> DataFrame:
    """``(doc_id, n_tokens, chances, rate, copies)`` per row of ``docs``.

    ``weights``: share of all tokens each domain should have (default: equal); labels
    without a weight get 0. The total stays as it is. ``copies``: how often the
    document is taken, its rate rounded up or down by a hash of its id (rows without
    an id by the same number). Tokens are words between blanks. Documents
    without words keep rate 1. Without two labels to learn from all rates are 1.
    Repeated rows are rated alike; other columns are ignored. Targets that no rates
    reach are logged with the totals reached.
    """
    domains, members = posteriors(docs, labels, limit)
    members = materialize(members, "members")
    share = np.array([(weights or dict.fromkeys(domains, 1.0)).get(d, 0.0) for d in domains], float)
    share = share / share.sum() if share.sum() else np.full(len(domains), 1 / len(domains))
    tokens = members.agg(F.sum("n_tokens")).collect()[0][0] or 0
    fit = fit_rates(members, share * tokens) if tokens else Fit(np.zeros(len(domains)), np.zeros(len(domains)), 0.0)
    if fit.missed > CLOSE:
        log.warning("targets out of reach: shares %s, reached %s", dict(zip(domains, share)), dict(zip(domains, fit.reached / tokens)))
    size = len(domains)

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(2).flatten().to_numpy().reshape(-1, size)
            r = np.where(batch.column(1).to_numpy() > 0, _rates(p, fit.z), 1.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(r)], ["doc_id", "n_tokens", "chances", "rate"])

    kind = dict(members.dtypes)["doc_id"]
    found = members.mapInArrow(rated, f"doc_id {kind}, n_tokens long, chances array<double>, rate double")
    return found.withColumn("copies", F.floor(F.col("rate") + _even(F.col("doc_id"))).cast("int"))


def _even(doc_id: Column) -> Column:
    """A number from 0 to 1, the same for a document every time."""
    return F.pmod(F.xxhash64(doc_id, F.lit("mixing")), F.lit(1 << 30)) / float(1 << 30)


def mixed(docs: DataFrame, labels: DataFrame, weights: dict | None = None) -> DataFrame:
    """All columns of ``docs``, each row as often as its copies say (see ``rates``). Columns may have any names."""
    own, times, copy = (f"{x}_{uuid.uuid4().hex}" for x in ("doc_id", "times", "copy"))
    copies = rates(docs, labels, weights).groupBy(F.col("doc_id").alias(own)).agg(F.max("copies").alias(times))
    joined = docs.join(copies, docs["doc_id"].eqNullSafe(copies[own]))
    return joined.where(F.col(times) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*[docs[c] for c in docs.columns])


def quality_domains(labels: DataFrame) -> DataFrame:
    """``(doc_id, label)``: quality and toxicity of the labelled rows as one domain name."""
    name = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", name.alias("label"))
