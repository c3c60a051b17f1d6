"""Token counts per document of flat token files without an index.

A flat file is nothing but ids, with a separator after each document. It is read in
blocks that know nothing of document boundaries. In each block one vectorised search
finds the separators; that gives the lengths of the documents that lie inside, the
ids before the first separator (head) and after the last (tail). A prefix scan over
the blocks of a file then carries tails and document numbers across the boundaries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from issuerlake.llm.tokens import Encoder

#: Ids of one block.
BLOCK = 1 << 18
DTYPE = "<u2"


def write_flat(docs: DataFrame, path: str, tokenizer: str, separator: int) -> None:
    """Ids of all rows of ``docs``, a file per task, as blocks ``(file, block, raw)``; ``doc_ids`` of the documents that end in a block stand beside, for checks only."""
    with open(tokenizer, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A separator's own string in a text is ordinary text, so its id ends documents only.
        encoder, file, block = Encoder(sent.value, plain=True), TaskContext.get().partitionId(), 0
        held, ended, size = [], [], 0

        def out(raw: bytes, ids: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([block], pa.int64()), pa.array([raw], pa.binary()), pa.array([ids], pa.list_(pa.int64()))],
                ["file", "block", "raw", "doc_ids"],
            )

        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                ids, texts = (x.to_pylist() for x in batch.slice(low, 500).columns)
                for doc, got in zip(ids, encoder.encode([t or "" for t in texts])):
                    got, done = np.append(got, np.uint32(separator)).astype(DTYPE), 0
                    while done < len(got):
                        some = got[done : done + BLOCK - size]
                        held.append(some)
                        size, done = size + len(some), done + len(some)
                        if done == len(got):
                            ended.append(doc)
                        if size == BLOCK:
                            yield out(np.concatenate(held).tobytes(), ended)
                            held, ended, size, block = [], [], 0, block + 1
        if size:
            yield out(np.concatenate(held).tobytes(), ended)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows.mapInArrow(write, "file int, block long, raw binary, doc_ids array<long>").write.option("compression", "zstd").parquet(path)


def flat_files(spark: SparkSession, path: str, block: int = BLOCK, dtype: str = DTYPE) -> DataFrame:
    """Raw files under ``path`` as blocks ``(file, block, raw)``; one file is read by one task, so keep files below a few hundred MB."""
    width = np.dtype(dtype).itemsize * block
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content", "length")
    at = files.select("file", "content", F.explode(F.expr(f"sequence(0L, greatest(0L, length - 1), {width}L)")).alias("at"))
    return at.select("file", (F.col("at") / width).cast("long").alias("block"), F.expr(f"substring(content, cast(at + 1 as int), {width})").alias("raw"))


def count_tokens(blocks: DataFrame, separator: int, dtype: str = DTYPE) -> DataFrame:
    """``(file, doc_no, start, n_tokens)``: every document of every file, with its number and first id in the file.

    ``n_tokens`` counts the separator. Ids after a file's last separator are no whole
    document and give no row; empty files give none. Blocks are ordered by ``block``.
    """
    file = dict(blocks.dtypes)["file"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, numbers, rows = batch.column(0), batch.column(1), []
            for raw in batch.column(2):
                ids = np.frombuffer(raw.as_buffer() if raw.is_valid else b"", dtype)
                ends = np.flatnonzero(ids == separator) + 1
                rows.append((len(ids), len(ends), int(ends[0]) if len(ends) else len(ids), len(ids) - int(ends[-1]) if len(ends) else len(ids), ends[1:]))
            n, seps, head, tail, ends = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [files, numbers, *(pa.array(x, pa.int64()) for x in (n, seps, head, tail)), pa.array([e.tolist() for e in ends], pa.list_(pa.int32()))],
                ["file", "block", "n", "seps", "head", "tail", "ends"],
            )

    found = blocks.select("file", "block", "raw").mapInArrow(
        scan, f"file {file}, block long, n long, seps long, head long, tail long, ends array<int>"
    )
    # The scan: where a block starts in its file, how many documents ended before it, and where the last of them did.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n").over(before), F.lit(0))
    placed = found.withColumn("base", base).withColumn("number", F.coalesce(F.sum("seps").over(before), F.lit(0)))
    last = F.max(F.when(F.col("seps") > 0, F.col("base") + F.col("n") - F.col("tail"))).over(before)
    placed = placed.withColumn("open", F.coalesce(last, F.lit(0))).where("seps > 0")
    first = placed.select("file", F.col("number").alias("doc_no"), F.col("open").alias("start"), (F.col("base") + F.col("head") - F.col("open")).alias("n_tokens"))
    inner = placed.select("file", "number", "base", "head", "ends", F.posexplode("ends").alias("k", "end"))
    previous = F.when(F.col("k") == 0, F.col("head")).otherwise(F.get("ends", F.col("k") - 1).cast("long"))
    inner = inner.select("file", (F.col("number") + 1 + F.col("k")).alias("doc_no"), (F.col("base") + previous).alias("start"), (F.col("end") - previous).alias("n_tokens"))
    return first.unionByName(inner)


def document_counts(docs: DataFrame, path: str, tokenizer: str, separator: int) -> DataFrame:
    """``(doc_id, file, doc_no, start, n_tokens)``: flat files of ``docs`` are written to ``path`` and counted; ids come from beside the blocks.

    Null and empty texts count their separator only. Repeated rows give a row each.
    """
    spark = docs.sparkSession
    write_flat(docs, path, tokenizer, separator)
    schema = "file int, block long, raw binary, doc_ids array<long>"
    counted = count_tokens(spark.read.schema(schema).parquet(path).select("file", "block", "raw"), separator)
    named = spark.read.schema(schema).parquet(path).select("file", "block", "doc_ids")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    named = named.withColumn("number", F.coalesce(F.sum(F.size("doc_ids")).over(before), F.lit(0))).select(
        F.col("file").alias("f"), "number", F.posexplode("doc_ids").alias("k", "doc_id")
    )
    named = named.select("f", (F.col("number") + F.col("k")).alias("no"), "doc_id")
    return counted.join(named, (counted["file"] == named["f"]) & (counted["doc_no"] == named["no"])).select("doc_id", "file", "doc_no", "start", "n_tokens")
