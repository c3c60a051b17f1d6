"""Token-id files: documents' ids in ascending doc_id, range-coded in independent checksummed blocks.

A file is a Parquet table of blocks: its part and place, the coded ids (see
``coder``), and for every document that has ids in the block: doc_id, its place in
the part, where its first id here stands, and how many are here. Parts are ranges
of doc_id, so part, block and place give the order of all documents. Parquet carries
the blocks because Spark commits it atomically and reads it from any store; a block
is decoded without any other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from issuerlake.llm import coder
from issuerlake.llm.tokens import remembered

#: The id after each document.
END = 2

_PIECE = pa.struct([("doc_id", pa.int64()), ("place", pa.int64()), ("at", pa.int64()), ("n", pa.int64())])
SCHEMA = "part int, block long, ids long, coded binary, pieces array<struct<doc_id: long, place: long, at: long, n: long>>"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int = END, parts: int | None = None) -> None:
    """Write the ids of all rows of ``docs`` (doc_id, text) to ``path``. Null texts are empty; equal doc_ids stand together."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with open(tokenizer, encoding="utf-8") as f:
        model = f.read()
    sent = spark.sparkContext.broadcast(model)  # one vocabulary file

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), remembered(sent.value)
        held, pieces = [], []  # ids not yet in a whole block; (doc_id, place, at, n) since the last block
        size = at = place = block = 0
        ready: list[tuple[np.ndarray, list]] = []

        def flush() -> pa.RecordBatch:
            nonlocal block, ready
            coded = coder.encode([ids for ids, _ in ready], encoder.vocabulary)
            n = len(ready)
            out = pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array(range(block, block + n), pa.int64()), pa.array([len(i) for i, _ in ready], pa.int64()),
                 pa.array(coded, pa.binary()), pa.array([p for _, p in ready], pa.list_(_PIECE))],
                ["part", "block", "ids", "coded", "pieces"],
            )
            block, ready = block + n, []
            return out

        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                ids, texts = (x.to_pylist() for x in batch.slice(low, 500).columns)
                for doc, got in zip(ids, encoder.encode([t or "" for t in texts])):
                    got, done = np.append(got, np.uint32(end)), 0
                    while done < len(got):
                        some = got[done : done + coder.BLOCK - size]
                        pieces.append((doc, place, at + done, len(some)))
                        held.append(some)
                        size, done = size + len(some), done + len(some)
                        if size == coder.BLOCK:
                            ready.append((np.concatenate(held), [dict(zip(("doc_id", "place", "at", "n"), p)) for p in pieces]))
                            held, pieces, size = [], [], 0
                            if len(ready) == coder.LANES:
                                yield flush()
                    at, place = at + len(got), place + 1
        if size:
            ready.append((np.concatenate(held), [dict(zip(("doc_id", "place", "at", "n"), p)) for p in pieces]))
        if ready:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    rows.mapInArrow(write, SCHEMA).write.option("compression", "none").parquet(path)


_REFLECTED = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo crc32's."""
    out, bit = 0, 1 << 31
    while bit:
        if a & bit:
            out ^= b
        b = (b >> 1) ^ (_REFLECTED if b & 1 else 0)
        bit >>= 1
    return out


@lru_cache(maxsize=1)
def _shifts() -> np.ndarray:
    """x ** (8 * 2 ** k) for every bit k of a length."""
    out = [1 << 23]  # x ** 8
    while len(out) < 62:
        out.append(_times(out[-1], out[-1]))
    return np.array(out, np.int64)


def _products(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """``_times`` of each pair."""
    out = np.zeros(len(a), np.int64)
    b = np.broadcast_to(b, a.shape).astype(np.int64)
    for bit in range(31, -1, -1):
        out ^= b * (a >> bit & 1)
        b = (b >> 1) ^ (_REFLECTED * (b & 1))
    return out


def join_crcs(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``join_crc`` of each of many."""
    out, bit, left = np.asarray(first, np.int64), 0, np.asarray(lengths, np.int64)
    while left.any():
        odd = np.flatnonzero(left & 1)
        if len(odd):
            out = out.copy()
            out[odd] = _products(out[odd], _shifts()[bit])
        left, bit = left >> 1, bit + 1
    return out ^ second


def join_crc(first: int, second: int, length: int) -> int:
    """crc32 of two byte strings together, from that of each and the length of the second."""
    return int(join_crcs(np.array([first]), np.array([second]), np.array([length]))[0])


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), coder.LANES):
                some = batch.slice(low, coder.LANES)
                out = []
                for part, ids, pieces in zip(some.column(0).to_pylist(), coder.decode(some.column(1).to_pylist()), some.column(2).to_pylist()):
                    raw, done = ids.astype("<u4").tobytes(), 0
                    for p in pieces:
                        out.append((part, p["place"], p["doc_id"], p["at"], p["n"], zlib.crc32(raw[4 * done : 4 * (done + p["n"])])))
                        done += p["n"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))],
                    ["part", "place", "doc_id", "at", "n", "crc"],
                )

    blocks = spark.read.schema(SCHEMA).parquet(path).select("part", "coded", "pieces")
    return blocks.mapInArrow(read, "part int, place long, doc_id long, at long, n long, crc long")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document of a file; ``start`` counts the ids of all documents before it."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(4)
            n, crc = (parts.flatten().field(x).to_numpy() for x in ("n", "crc"))
            count = np.diff(parts.offsets.to_numpy())
            begin = np.cumsum(count) - count
            whole, at = crc[begin], 1
            # The second pieces of all documents that have two, then the third, and so on.
            while len(more := np.flatnonzero(count > at)):
                next_ = begin[more] + at
                whole[more] = join_crcs(whole[more], crc[next_], 4 * n[next_])
                at += 1
            crc = whole
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(crc, pa.int64())], ["part", "doc_id", "at", "n_tokens", "ids_crc32"])

    # A document has as many pieces as it fills blocks.
    docs = _pieces(spark, path).groupBy("part", "place", "doc_id").agg(
        F.min("at").alias("at"), F.sum("n").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("parts")
    )
    docs = docs.select("part", "doc_id", "at", "n_tokens", "parts").mapInArrow(joined, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    blocks = spark.read.schema(SCHEMA).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.groupBy("part").agg(F.sum("ids").alias("ids"))  # a row per part
    sizes = sizes.select(F.col("part").alias("own"), F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    return docs.join(sizes, docs["part"] == sizes["own"]).select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def roundtrip(docs: DataFrame, path: str, tokenizer: str) -> DataFrame:
    """Write ``docs`` to ``path`` and read it back (see ``read_tokens``). Repeated rows give a row each; other columns are ignored; an empty table gives no rows."""
    write_tokens(docs, path, tokenizer)
    return read_tokens(docs.sparkSession, path)
