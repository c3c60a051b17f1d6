"""Ranked lexical search: MaxScore whose bounds come from pairs of terms.

1. ``build_index``: every task turns its documents into shards, each a whole inverted
   index of a bounded number of words (term, documents in order, occurrences).
2. Items are taken in blocks of bounded size. One pass sums each asked term's documents
   over all shards, so that weights are global.
3. ``with_pairs``: per shard, the impacts of the asked terms, and for pairs of terms of
   an item that are neighbours in order of weight the list of documents that hold both,
   with their joint impact and its maximum, are computed once and stored.
4. Search: terms that limit each other most are joined to units. A unit's bound is the
   most that one document gets from both, which is often far below the sum of the two
   maxima: rare terms seldom stand together. Units are read from the highest bound down;
   once the bounds still to come are below the k-th score, no further document is
   admitted, and the rest is only looked up for documents that can still be among the k.
5. The best of each shard are merged by score and doc_id.

Terms are compared by 64-bit hashes of their bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from issuerlake.llm import text as T
from issuerlake.llm.pieces import pack, unpack
from issuerlake.llm.shared import Shared, materialize

#: Words of a shard, about; a longer document is a shard of its own.
WORDS = 2_000_000
#: Terms of the items that are asked in one pass, about.
ASKED = 200_000

_SHARD = "shard long, docs array<long>, sizes binary, terms binary, dfs binary, gaps binary, tfs binary, n long, total long"
_SERVED = "docs array<long>, terms binary, counts binary, gaps binary, impacts binary, pairs binary, pair_counts binary, pair_gaps binary, pair_impacts binary"
_KINDS = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (x.split(" ") for x in ddl.split(", "))])


def _gaps(docs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Steps between the documents of each list; a list begins with the document itself."""
    out = docs.astype(np.int64)
    out[1:] -= docs[:-1]
    begins = (np.cumsum(counts) - counts)[counts > 0]
    out[begins] = docs[begins]
    return out.astype(np.uint32)


def _docs(gaps: np.ndarray, counts: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(gaps.astype(np.int64)))
    return sums[1:] - np.repeat(sums[np.cumsum(counts) - counts], counts)


def _shard(number: int, ids: list, lists: list[np.ndarray]) -> dict:
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))  # numbers in a shard follow doc_id: ties go by number
    sizes = np.array([len(lists[i]) for i in order], np.int64)
    hashes = np.concatenate([np.zeros(0, np.uint64), *[lists[i] for i in order]])
    docs = np.repeat(np.arange(len(order)), sizes)
    turn = np.argsort(hashes, kind="stable")
    hashes, docs = hashes[turn], docs[turn]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = hashes[1:] != hashes[:-1]
    post = fresh.copy()
    post[1:] |= docs[1:] != docs[:-1]
    at = np.flatnonzero(post)
    tfs = np.diff(np.append(at, len(hashes)))
    heads = np.flatnonzero(fresh[at])
    dfs = np.diff(np.append(heads, len(at)))
    terms = hashes[at][heads]
    steps = terms.copy()
    steps[1:] -= terms[:-1]
    return {
        "shard": number, "docs": [ids[i] for i in order], "sizes": pack(sizes.astype(np.uint32)), "terms": pack(steps), "dfs": pack(dfs.astype(np.uint32)),
        "gaps": pack(_gaps(docs[at], dfs)), "tfs": pack(tfs.astype(np.uint32)), "n": int((sizes > 0).sum()), "total": int(sizes.sum()),
    }


def _term_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, np.ndarray]]:
    for batch in batches:
        for chunk in T.chunks(batch.column(1)):
            words = T.cut(chunk, T.MARKS, lower=True)
            ids = batch.column(0).slice(chunk.row, len(chunk)).to_pylist()
            first = words.first.tolist()
            for i, a, b in zip(ids, first[:-1], first[1:]):
                yield i, words.hashes[a:b]


def build_index(docs: DataFrame) -> DataFrame:
    """Shards of all rows of ``docs`` (doc_id, text), stored in the shared folder. Null texts hold no term."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, lists, held = TaskContext.get().partitionId() << 32, [], [], 0
        for i, hashes in _term_lists(batches):
            ids.append(i)
            lists.append(hashes)
            held += len(hashes)
            if held >= WORDS:
                yield pa.RecordBatch.from_pylist([_shard(number, ids, lists)], schema=_schema(_SHARD))
                number, ids, lists, held = number + 1, [], [], 0
        if ids:
            yield pa.RecordBatch.from_pylist([_shard(number, ids, lists)], schema=_schema(_SHARD))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(shards, _SHARD), "index")


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, terms array<long>``: the different terms of each item; rows of one item_id (null is one) are one item."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, hashes in _term_lists(batches):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([T.as_long(np.unique(hashes))], pa.list_(pa.int64()))], ["item_id", "terms"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    lists = rows.mapInArrow(listed, "item_id long, terms array<long>")
    return lists.select("item_id", F.explode("terms").alias("term")).distinct().groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))


def _present(row: dict, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which asked terms a shard has, where its list of terms has them, and the documents of all its terms."""
    terms, dfs = np.cumsum(unpack(row["terms"], np.uint64), dtype=np.uint64), unpack(row["dfs"], np.uint32).astype(np.int64)
    if not len(terms):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), dfs
    at = np.minimum(np.searchsorted(terms, asked), len(terms) - 1)
    here = np.flatnonzero(terms[at] == asked)
    return here, at[here], dfs


def document_frequencies(index: DataFrame, asked: np.ndarray) -> dict[int, int]:
    """Documents that hold each of the ``asked`` terms (sorted), over all shards."""
    sent = Shared(index.sparkSession, asked)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                here, at, dfs = _present(row, sent.value)
                yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(dfs[at])], ["place", "df"])

    found = index.select("terms", "dfs").mapInArrow(count, "place long, df long").groupBy("place").agg(F.sum("df").alias("df")).collect()
    return {r["place"]: r["df"] for r in found}


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def neighbours(items: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """Pairs of places of terms that are neighbours in an item's order of weight, each once."""
    pairs = set()
    for places in items:
        ordered = places[np.lexsort((places, -weights[places]))]
        pairs.update((min(a, b), max(a, b)) for a, b in zip(ordered[:-1].tolist(), ordered[1:].tolist()))
    return np.array(sorted(pairs), np.int64).reshape(-1, 2)


def with_pairs(index: DataFrame, asked: np.ndarray, weights: np.ndarray, pairs: np.ndarray, n: int, total: int) -> DataFrame:
    """Per shard, stored: documents and impacts of the asked terms, and of the pairs documents that hold both with their joint impacts."""
    sent = Shared(index.sparkSession, (asked, weights, pairs))

    def serve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights, pairs = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                here, at, dfs = _present(row, asked)
                docs, tfs = _docs(unpack(row["gaps"], np.uint32), dfs), unpack(row["tfs"], np.uint32).astype(np.int64)
                mass = 10 + (90 * unpack(row["sizes"], np.uint32).astype(np.int64) * n) // max(total, 1)
                ends = np.append(0, np.cumsum(dfs))
                lists = {}
                for place, k in zip(here.tolist(), at.tolist()):
                    d, tf = docs[ends[k] : ends[k + 1]], tfs[ends[k] : ends[k + 1]]
                    lists[place] = d, weights[place] * ((1_000_000_000 * tf) // (1000 * tf + 8 * mass[d]))
                used, joint = [], []
                for k, (a, b) in enumerate(pairs.tolist()):
                    if a in lists and b in lists:
                        both, i, j = np.intersect1d(lists[a][0], lists[b][0], assume_unique=True, return_indices=True)
                        used.append(k)
                        joint.append((both, lists[a][1][i] + lists[b][1][j]))
                out = {"docs": row["docs"], "terms": pack(here.astype(np.uint32)), "pairs": pack(np.array(used, np.uint32))}
                for mark, some in (("", list(lists.values())), ("pair_", joint)):
                    counts = np.array([len(d) for d, _ in some], np.int64)
                    d, x = (np.concatenate([np.zeros(0, np.int64), *[v[i] for v in some]]) for i in (0, 1))
                    out |= {f"{mark}counts": pack(counts.astype(np.uint32)), f"{mark}gaps": pack(_gaps(d, counts)), f"{mark}impacts": pack(x)}
                yield pa.RecordBatch.from_pylist([out], schema=_schema(_SERVED))

    return materialize(index.select("docs", "sizes", "terms", "dfs", "gaps", "tfs").mapInArrow(serve, _SERVED), "pairs")


class Lists:
    """Document lists of a shard with impacts, by name; the largest impact of each."""

    def __init__(self, names: list, counts: bytes, gaps: bytes, impacts: bytes) -> None:
        n = unpack(counts, np.uint32).astype(np.int64)
        docs, x = _docs(unpack(gaps, np.uint32), n), unpack(impacts, np.int64)
        ends = np.append(0, np.cumsum(n)).tolist()
        self.of = {name: (docs[a:b], x[a:b]) for name, a, b in zip(names, ends[:-1], ends[1:])}
        self.most = {name: int(v.max()) if len(v) else 0 for name, (_, v) in self.of.items()}


def _look_up(docs: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` are among ``docs`` (both sorted), and where."""
    if not len(docs):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(docs, wanted), len(docs) - 1)
    return docs[at] == wanted, at


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


class Searcher:
    """MaxScore over one shard."""

    def __init__(self, size: int, terms: Lists, joint: Lists) -> None:
        self.size, self.terms, self.joint = size, terms, joint
        self.admitted = 0  # documents that got a place at all, over all searches

    def units(self, places: list[int]) -> list[tuple[int, tuple]]:
        """(bound, terms) of disjoint pairs and single terms, by falling bound: the pairs that lower the sum of bounds most."""
        most = self.terms.most
        held = {p for p in places if most.get(p)}
        savings = []
        for pair in {x for p in held for x in self.with_term.get(p, ()) if x[0] in held and x[1] in held}:
            bound = max(self.joint.most[pair], most[pair[0]], most[pair[1]])
            savings.append((most[pair[0]] + most[pair[1]] - bound, pair, bound))
        units = []
        for saved, pair, bound in sorted(savings, key=lambda x: (-x[0], x[1])):
            if saved > 0 and pair[0] in held and pair[1] in held:
                units.append((bound, pair))
                held -= set(pair)
        units += [(most[p], (p,)) for p in held]
        return sorted(units, key=lambda x: (-x[0], x[1]))

    @property
    def with_term(self) -> dict:
        if not hasattr(self, "_with"):
            self._with: dict[int, list] = {}
            for pair in self.joint.of:
                for p in pair:
                    self._with.setdefault(p, []).append(pair)
        return self._with

    def best(self, places: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of the k best documents; equal scores by number."""
        units = self.units(places)
        rest = np.append(np.cumsum([b for b, _ in units][::-1])[::-1], 0).tolist() if units else [0]
        scores, least, at = np.zeros(self.size, np.int64), 0, 0
        while at < len(units) and (at == 0 or rest[at] >= least):
            for p in units[at][1]:
                docs, x = self.terms.of[p]
                scores[docs] += x
            at += 1
            least = _kth(scores[scores > 0], k) if at < len(units) else 0
        kept = np.flatnonzero(scores)
        self.admitted += len(kept)
        for i in range(at, len(units)):
            kept = kept[scores[kept] + rest[i] >= least]
            self._add(kept, scores, units[i], rest[i + 1], least)
            least = max(least, _kth(scores[kept], k))
        kept = kept[scores[kept] >= least]
        top = kept[np.lexsort((kept, -scores[kept]))[:k]]
        return top, scores[top]

    def _add(self, kept: np.ndarray, scores: np.ndarray, unit: tuple[int, tuple], rest: int, least: int) -> None:
        terms = unit[1]
        if len(terms) == 2:
            docs, x = self.joint.of[terms]
            found, at = _look_up(docs, kept)
            scores[kept[found]] += x[at[found]]
            kept = kept[~found]
            # Not both: one of the two at most.
            kept = kept[scores[kept] + max(self.terms.most[t] for t in terms) + rest >= least]
        for term in terms:
            docs, x = self.terms.of[term]
            found, at = _look_up(docs, kept)
            scores[kept[found]] += x[at[found]]


def search_shards(served: DataFrame, items: list[tuple[object, np.ndarray]], pairs: np.ndarray, k: int) -> DataFrame:
    """``item_id, doc_id, score``: the k best of each shard for each item (its id and places of terms)."""
    sent = Shared(served.sparkSession, (items, pairs))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, pairs = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.array([0 if x is None else x for x in row["docs"]], np.int64)
                empty = np.array([x is None for x in row["docs"]], bool)
                terms = Lists(unpack(row["terms"], np.uint32).tolist(), row["counts"], row["gaps"], row["impacts"])
                names = [tuple(x) for x in pairs[unpack(row["pairs"], np.uint32)].tolist()]
                searcher = Searcher(len(ids), terms, Lists(names, row["pair_counts"], row["pair_gaps"], row["pair_impacts"]))
                out = [(item, *searcher.best(places.tolist(), k)) for item, places in items]
                docs = np.concatenate([np.zeros(0, np.int64), *[d for _, d, _ in out]])
                named = pa.array([i for i, d, _ in out for _ in range(len(d))], pa.int64())
                yield pa.RecordBatch.from_arrays([named, pa.array(ids[docs], mask=empty[docs]), pa.array(np.concatenate([np.zeros(0, np.int64), *[s for _, _, s in out]]))], ["item_id", "doc_id", "score"])

    return served.mapInArrow(search, "item_id long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item the k rows of ``docs`` (doc_id, text) of the highest score above 0.

    Scores are 64-bit integers from global counts; equal ones rank by ascending doc_id,
    null ids last. Every row of ``docs`` is a document, repeated ids too. Rows of
    ``items`` (item_id, text) with one item_id, null included, are one item. Null and
    empty texts hold no term: they are in no result, count in no statistic, and as
    items give no rows. Other columns are ignored.
    """
    index = build_index(docs)
    stats = index.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("total"), F.lit(0)).alias("total")).first()
    asks = materialize(item_terms(items), "items")
    blocks = (asks.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0] // ASKED) + 1
    found = None
    for block in range(blocks):
        some = asks.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()  # one block of items
        asked = np.unique(np.concatenate([np.zeros(0, np.int64), *[np.array(r["terms"], np.int64) for r in some]]).view(np.uint64))
        dfs = document_frequencies(index, asked)
        weights = np.array([weight(stats["n"], dfs[p]) if p in dfs else 0 for p in range(len(asked))], np.int64)
        places = [(r["item_id"], np.searchsorted(asked, np.sort(np.array(r["terms"], np.int64).view(np.uint64)))) for r in some]
        pairs = neighbours([p[weights[p] > 0] for _, p in places], weights)
        served = with_pairs(index, asked, weights, pairs, stats["n"], stats["total"])
        part = search_shards(served, places, pairs, k)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
