"""Substring dedup by compaction of a de Bruijn graph over words.

The edges of the graph are runs of ``length`` words ("k-mers") of the documents.
Only k-mers that occur in several documents matter, and repeated text forms long
paths without branches, so edges are never all written out:

1. Every k-mer contains one anchor, the smallest hash of the ``ANCHOR``-word runs in
   it. Equal k-mers have equal anchors, so a k-mer whose anchor occurs in one
   document only is not repeated. Anchors are a fifth of the words; they alone are
   shuffled to find the repeated ones.
2. Consecutive k-mers with the same anchor are one path of the graph without
   branches, compacted to one row: (anchor, hash of its words, document, position).
   Paths with equal words are joined into one, whose source is the smallest document
   that has it: all later places repeat it whole.
3. Paths that are equal only in part branch: they share an anchor, but not all
   words. One copy of each such path is opened into its edges, and edges with the
   same words are joined across paths.
4. What is left repeated is stitched into maximal spans by source coordinates, and
   the words of the documents are cut there.

Rows per anchor are summed in each batch before they are shuffled: text that very
many documents share sends one row per batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuerlake.llm import text as T
from issuerlake.llm.shared import materialize

#: Words of an anchor, at most.
ANCHOR = 5
#: Chunks of text in which paths with the same words are found before any shuffle.
CHUNKS = 32


def _minima(x: np.ndarray, width: int) -> np.ndarray:
    """Index of the first smallest value of every window of ``width`` values."""
    best = np.arange(len(x) - width + 1)
    low = x[: len(best)].copy()
    for j in range(1, width):
        y = x[j : j + len(best)]
        less = y < low
        low[less] = y[less]
        best[less] += j - (best[less] - np.flatnonzero(less))
    return best


def _paths(words: T.Words, length: int):
    """For each k-mer of each document: its document, its first word, and the word where its anchor starts."""
    width = min(ANCHOR, length)
    grams, at = T.ngrams(words, width)
    if not len(words.hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), grams
    by_word = np.full(len(words.hashes), np.iinfo(np.uint64).max, np.uint64)
    by_word[at] = grams
    if len(by_word) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), by_word
    anchor = _minima(by_word[: len(by_word) - width + 1], length - width + 1)
    limit = np.repeat(words.first[1:], words.counts)[: len(anchor)]
    kmer = np.flatnonzero(limit - np.arange(len(anchor)) >= length)
    doc = np.searchsorted(words.first, kmer, "right") - 1
    return doc, kmer, anchor[kmer], by_word


def _runs(doc: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Where a new path starts among k-mers."""
    return np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])) if len(doc) else np.zeros(0, np.int64)


def repeated_spans(docs: DataFrame, length: int = 13) -> DataFrame:
    """``(doc_id, start, stop)``: k-mers, as word ranges from ``start`` of the first to ``stop`` of the last, that also start in a smaller doc_id."""
    docs = docs.select("doc_id", "text").where(F.col("text").isNotNull() & F.col("doc_id").isNotNull())

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            found = []
            for chunk in T.chunks(batch.column(1)):
                words = T.cut(chunk, T.BLANKS, lower=False)
                doc, kmer, anchor, by_word = _paths(words, length)
                new = _runs(doc, anchor)
                found.append((by_word[anchor[new]], ids[chunk.row + doc[new]], anchor[new] - words.first[doc[new]]))
            if not found:
                continue
            h, d, at = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((d, h))
            h, d, at = h[order], d[order], at[order]
            new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            group = np.cumsum(np.concatenate([[0], (h[1:] != h[:-1]).astype(np.int64)])) if len(h) else new
            last = np.concatenate([new[1:], [len(h)]]) - 1 if len(h) else new
            several = (d[last] != d[new])[group]  # in more than one document of this batch
            lead = np.zeros(len(h), bool)
            lead[new] = True
            # The first row of such a group stands for it elsewhere; the others need no comparison any more.
            # Places of anchors known to repeat are written as ~at: one column less to shuffle.
            at = np.where(several, ~at, at).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(T.as_long(h)), pa.array(d, pa.int64()), pa.array(at), pa.array(several & ~lead)],
                ["anchor", "doc_id", "at", "done"],
            )

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows in order of anchor and document, those whose anchor has several documents; one anchor's open rows are held while it has one document."""
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            h, d, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            now = (h, d, np.where(at < 0, ~at, at), at < 0)
            if held:
                now = tuple(np.concatenate(x) for x in zip(held.pop(), now))
            h, d, at, known = now
            same = np.concatenate([[False], (h[1:] == h[:-1])])
            start = np.flatnonzero(~same)
            size = np.diff(np.concatenate([start, [len(h)]]))
            first, last = d[start], d[start + size - 1]
            whole = np.repeat(first != last, size) | known
            tail = start[-1]
            if first[-1] == last[-1]:  # this anchor may go on: hold its rows of one document
                held = [(h[tail:], d[tail:], at[tail:], known[tail:])]
                upto = tail
            else:  # the anchor is repeated: its last row is enough to tell the next batch
                held = [(h[-1:], d[-1:] , at[-1:], known[-1:])]
                upto = len(h) - 1
                held = [(h[-1:], np.full(1, first[-1]), np.full(1, -1, at.dtype), np.zeros(1, bool)), held[0]]
                held = [tuple(np.concatenate(x) for x in zip(*held))]
            keep = np.flatnonzero(whole[:upto] & (at[:upto] >= 0))
            yield pa.RecordBatch.from_arrays([pa.array(d[keep], pa.int64()), pa.array(at[keep], pa.int32())], ["doc_id", "at"])
        for h, d, at, known in held:
            keep = np.flatnonzero((known | (d.min() != d.max())) & (at >= 0))
            yield pa.RecordBatch.from_arrays([pa.array(d[keep], pa.int64()), pa.array(at[keep], pa.int32())], ["doc_id", "at"])

    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.mapInArrow(anchors, "anchor long, doc_id long, at int, done boolean")
    # Finished rows are dealt by themselves, so that no partition gets all rows of a common anchor.
    key = F.when(F.col("done"), F.xxhash64("doc_id", "at")).otherwise(F.col("anchor"))
    dealt = rows.select(key.alias("anchor"), "doc_id", "at").repartition(parts, "anchor").sortWithinPartitions("anchor", "doc_id")
    open_ = dealt.mapInArrow(repeated, "doc_id long, at int")
    marked = open_.groupBy("doc_id").agg(F.collect_set("at").alias("marked")).withColumnRenamed("doc_id", "marked_id")
    marked = materialize(marked, "marked")

    def compacted(chunk: T.Chunk, ids: np.ndarray, lists: pa.Array):
        """Marked paths of a chunk: anchor, body, document, first word, number of edges; and their edges in a row."""
        words = T.cut(chunk, T.BLANKS, lower=False)
        doc, kmer, anchor, by_word = _paths(words, length)
        wanted = np.zeros(len(words.hashes) + 1, bool)
        for i in range(len(chunk)):
            wanted[words.first[i] + lists[chunk.row + i].values.to_numpy(zero_copy_only=False)] = True
        keep = wanted[anchor]
        doc, kmer, anchor = doc[keep], kmer[keep], anchor[keep]
        new = _runs(doc, anchor)
        grams, at = T.ngrams(words, length)
        edges = grams[np.searchsorted(at, kmer)]
        size = np.diff(np.concatenate([new, [len(kmer)]])).astype(np.int64) if len(new) else new
        # The path's words: a hash of its edges, 128 bits with its anchor's own hash.
        inside = np.arange(len(kmer)) - np.repeat(new, size)
        body = edges * T.factors(length)[np.minimum(inside, length - 1)]
        body = T.mix(np.add.reduceat(body, new) + size.astype(np.uint64)) if len(new) else body
        return by_word[anchor[new]], body, ids[chunk.row + doc[new]], kmer[new] - words.first[doc[new]], size, edges

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            runs = T.chunks(batch.column(1))
            while some := list(islice(runs, CHUNKS)):
                anchor, body, doc, start, size, edges = (np.concatenate(x) for x in zip(*(compacted(c, ids, lists) for c in some)))
                if not len(anchor):
                    continue
                # Of paths with the same words, one brings the edges.
                order = np.lexsort((body, anchor))
                lead = np.concatenate([[True], (anchor[order][1:] != anchor[order][:-1]) | (body[order][1:] != body[order][:-1])])
                bare = np.ones(len(anchor), bool)
                bare[order[lead]] = False
                bounds = np.concatenate([[0], np.cumsum(np.where(bare, 0, size))]).astype(np.int32)
                kept = pa.ListArray.from_arrays(pa.array(bounds), pa.array(T.as_long(edges[np.repeat(~bare, size)])), mask=pa.array(bare))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(T.as_long(anchor)), pa.array(T.as_long(body)), pa.array(doc, pa.int64()), pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)), kept],
                    ["anchor", "body", "doc_id", "start", "n", "edges"],
                )

    texts = docs.join(marked, docs["doc_id"] == marked["marked_id"]).select("doc_id", "text", "marked")
    found = materialize(texts.mapInArrow(paths, "anchor long, body long, doc_id long, start int, n int, edges array<long>"), "paths")

    # Paths with the same words become one, with its smallest document as source.
    compact = found.groupBy("anchor", "body").agg(F.min("doc_id").alias("source"), F.first("edges", ignorenulls=True).alias("edges"))
    compact = materialize(compact, "compact")
    places = found.select("anchor", "body", "doc_id", "start", "n").join(
        compact.select("anchor", "body", "source"), ["anchor", "body"]
    )
    later = places.where("doc_id > source").select("doc_id", "start", (F.col("start") + F.col("n") - 1).alias("stop"))
    # Paths that branch: several of one anchor. Their edges are joined one by one.
    branching = compact.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("anchor")
    edges = compact.join(branching, "anchor").select("anchor", "body", "source", F.posexplode("edges").alias("i", "edge"))
    sources = edges.groupBy("edge").agg(F.min("source").alias("least"), F.max("source").alias("most")).where("least < most")
    parts_ = edges.join(sources, "edge").where("least < source").groupBy("anchor", "body", "source").agg(F.collect_set("i").alias("inner"))
    parts_ = materialize(parts_.withColumnRenamed("source", "owner"), "inner")
    own = found.select("anchor", "body", "doc_id", "start").join(parts_, ["anchor", "body"]).where("doc_id = owner")
    own = own.select("doc_id", "start", F.explode("inner").alias("i")).select("doc_id", (F.col("start") + F.col("i")).alias("start"))
    return later.unionByName(own.withColumn("stop", F.col("start")))


def without_repeats(docs: DataFrame, length: int = 13) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept)``: texts without the words of windows that a document with a smaller id has too.

    A window is ``length`` words `[^\\x20\\x09-\\x0D]+`. Null and empty texts have no
    words and keep the empty text. Shorter documents keep all. Rows that repeat a
    doc_id count as one document and each give a row, cut alike. Rows without a doc_id
    are neither smaller nor larger than others: they keep all and cut none. Other columns are
    ignored; an empty table gives no rows. ``kept``: kept words joined by one space.
    """
    docs = docs.select("doc_id", "text")
    spans = repeated_spans(docs, length).groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    spans = materialize(spans.withColumnRenamed("doc_id", "cut_id"), "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, lists = batch.column(0), batch.column(1), batch.column(2)
            marks = lists.is_valid().to_numpy(zero_copy_only=False)
            for chunk in T.chunks(texts):
                words = T.cut(chunk, T.BLANKS, lower=False, hashes=False)
                raw = chunk.data.tobytes()
                n, removed, sha, kept = [], [], [], []
                for i in range(len(chunk)):
                    low, high = int(words.first[i]), int(words.first[i + 1])
                    gone = np.zeros(high - low + 1, np.int64)
                    row = chunk.row + i
                    if marks[row]:
                        cell = lists[row].values
                        np.add.at(gone, cell.field(0).to_numpy(), 1)
                        np.add.at(gone, np.minimum(cell.field(1).to_numpy() + length, high - low), -1)
                    stay = np.flatnonzero(np.cumsum(gone[:-1]) == 0) + low
                    text = b" ".join([raw[a:b] for a, b in zip(words.starts[stay].tolist(), words.ends[stay].tolist())])
                    n.append(high - low)
                    removed.append(high - low - len(stay))
                    sha.append(hashlib.sha256(text).hexdigest())
                    kept.append(text.decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(chunk.row, len(chunk)), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha), pa.array(kept)],
                    ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
                )

    joined = docs.join(spans, docs["doc_id"] == spans["cut_id"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
