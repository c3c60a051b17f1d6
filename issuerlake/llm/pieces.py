"""SentencePiece encoding by a table of distinct chunks.

White space becomes marks, and no piece of the model holds anything but marks before a
mark; so a text falls apart before every run of marks, and each part (a chunk) is
segmented alike wherever it stands. Every distinct chunk of the corpus is segmented
once and its ids are joined back by position:

1. Documents are gathered in blocks of bounded size. A block is kept as a list of its
   distinct chunks and, for each document, the chunks' numbers in order.
2. The lists are cut by a hash of the chunk. A partition holds every block's chunks of
   its hashes, segments each distinct one once and answers each block in its order.
3. Answers meet their block again and the numbers become ids.

Only lists of distinct chunks and numbers are shuffled, never texts or single words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuerlake.llm.shared import discard, scratch, shuffles_end

MARK = "▁"
#: Bytes of text in a block, about; a longer document is a block of its own.
BLOCK = 1 << 25
#: Chunks, counted once for each block, that a partition segments, about.
SHARE = 400_000
#: Hash slices of a list of chunks; partitions take runs of slices.
SLICES = 1 << 12
#: The commonest chunks of a block have the smallest numbers: those compress best.
COMMON = 1 << 16
#: Ids in a batch that goes back to Spark, about.
OUT = 1 << 19

_BLOCKS = "kind string, block long, docs array<long>, a binary, b binary, c binary, n long"
_ANSWERS = "block long, bucket int, counts binary, ids binary"


def pack(x: np.ndarray) -> bytes:
    """Numbers compressed byte plane by byte plane."""
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T if len(x) else np.zeros((0, 0), np.uint8)
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).reshape(-1).view(kind)


def pack_numbers(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, small ones shortest: one byte below 192, else a byte of the upper part and two of the lower, or four where that is too little."""
    upper = (x.astype(np.int64) - 192) >> 16
    one = np.where(x < 192, x, np.minimum(192 + upper, 255)).astype(np.uint8)
    two = (x[(one >= 192) & (one < 255)].astype(np.int64) - 192).astype(np.uint16)
    parts = [pack(one), pack(two), pack(x[one == 255].astype(np.uint32))]
    return np.array([len(p) for p in parts], np.uint32).tobytes() + b"".join(parts)


def unpack_numbers(data: bytes) -> np.ndarray:
    ends = 12 + np.cumsum(np.frombuffer(data[:12], np.uint32).astype(np.int64))
    one, two, four = (unpack(data[a:b], kind) for a, b, kind in zip([12, *ends[:-1]], ends, (np.uint8, np.uint16, np.uint32)))
    out = one.astype(np.uint32)
    middle, large = (one >= 192) & (one < 255), one == 255
    out[middle] = ((out[middle] - 192) << 16) + two + np.uint32(192)
    out[large] = four
    return out


def without_prefix(model: bytes) -> bytes:
    """The model without its own leading mark: it then segments a marked chunk as it stands."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    spec = proto.normalizer_spec
    crossing = [p.piece for p in proto.pieces if p.type == 1 and MARK in p.piece.lstrip(MARK)]
    if crossing or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or any(p.type == 4 for p in proto.pieces):
        raise ValueError("pieces of this model cross marks, or it changes texts before it cuts them")
    spec.add_dummy_prefix = False
    return proto.SerializeToString()


def _processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def cut_chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All chunks of marked texts as one binary array, and the number of chunks of each text. Null and empty texts have none."""
    texts = pc.replace_substring(pc.fill_null(texts, "").cast(pa.large_string()), MARK, " ")
    marked = pc.binary_join_element_wise(pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ").cast(pa.large_string()), texts, pa.scalar("", pa.large_string()))
    _, where, data = marked.buffers()
    bounds = np.frombuffer(where, np.int64)[marked.offset : marked.offset + len(marked) + 1]
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    blank = data == 32
    begins = blank.copy()
    begins[1:] &= ~blank[:-1]
    begins[bounds[:-1][np.diff(bounds) > 0]] = True
    starts = np.flatnonzero(begins)
    offsets = np.append(starts, len(data))
    chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return chunks, np.diff(np.searchsorted(starts, bounds))


def _block(ids: pa.Array, texts: pa.Array, block: int) -> list[dict]:
    chunks, counts = cut_chunks(texts)
    coded = chunks.dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy()
    rank = np.empty(len(words), np.int64)
    rank[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
    slices = np.fromiter((zlib.crc32(w) % SLICES for w in words.to_pylist()), np.int64, len(words))
    order = np.lexsort((rank, slices))
    seen = np.bincount(codes, minlength=len(words))
    common = np.argsort(-seen, kind="stable")[:COMMON]
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    number = place + len(common)
    number[common] = np.arange(len(common))
    listed = words.take(pa.array(order))
    sizes = pc.binary_length(listed).to_numpy().astype(np.uint32)
    raw = b"".join(listed.to_pylist())
    held = {"kind": "numbers", "block": block, "docs": ids.to_pylist(), "a": pack_numbers(number[codes].astype(np.uint32)), "b": pack(counts.astype(np.uint32)), "c": pack(place[common].astype(np.uint32)), "n": len(words)}
    asked = {"kind": "chunks", "block": block, "docs": None, "a": zstandard.ZstdCompressor(level=3).compress(raw), "b": pack(sizes), "c": pack(np.bincount(slices, minlength=SLICES).astype(np.uint32)), "n": len(words)}
    return [held, asked]


def _rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("docs", pa.list_(pa.int64())), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("n", pa.int64())])
    block = TaskContext.get().partitionId() << 32
    ids, texts, held = [], [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
        at = 0
        for upto in [*(np.flatnonzero(np.diff((held + np.cumsum(sizes)) // BLOCK)) + 1).tolist(), len(batch)]:
            if upto == at:
                continue
            ids.append(batch.column(0).slice(at, upto - at))
            texts.append(batch.column(1).slice(at, upto - at).cast(pa.large_string()))
            held += int(sizes[at:upto].sum())
            at = upto
            if held >= BLOCK:
                yield _rows(_block(pa.concat_arrays(ids), pa.concat_arrays(texts), block), schema)
                ids, texts, held, block = [], [], 0, block + 1
    if ids:
        yield _rows(_block(pa.concat_arrays(ids), pa.concat_arrays(texts), block), schema)


def _to_buckets(buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("sizes", pa.binary()), ("chunks", pa.binary())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, opener = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                raw, sizes = opener.decompress(row["a"]), unpack(row["b"], np.uint32)
                ends = np.append(0, np.cumsum(sizes.astype(np.int64)))
                slices = np.append(0, np.cumsum(unpack(row["c"], np.uint32).astype(np.int64)))
                out = []
                for k in range(buckets):
                    low, high = (int(slices[-(-SLICES * x // buckets)]) for x in (k, k + 1))
                    if high > low:
                        out.append({"bucket": k, "block": row["block"], "sizes": pack(sizes[low:high]), "chunks": packer.compress(raw[ends[low] : ends[high]])})
                if out:
                    yield _rows(out, schema)

    return split


def _segment(model, kind: type):
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("counts", pa.binary()), ("ids", pa.binary())])

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor, opener = _processor(model.value), zstandard.ZstdDecompressor()
        known: dict[bytes, bytes] = {}  # of this partition's hashes
        size = np.dtype(kind).itemsize
        for batch in batches:
            for row in batch.to_pylist():
                raw, ends = opener.decompress(row["chunks"]), np.cumsum(unpack(row["sizes"], np.uint32).astype(np.int64)).tolist()
                chunks = [raw[a:b] for a, b in zip([0, *ends], ends)]
                new = [c for c in chunks if c not in known]
                for at in range(0, len(new), 1000):
                    some = new[at : at + 1000]
                    known.update(zip(some, (np.array(x, kind).tobytes() for x in processor.encode([c.decode() for c in some], num_threads=1))))
                found = [known[c] for c in chunks]
                counts = np.fromiter(map(len, found), np.uint32, len(found)) // size
                yield _rows([{"block": row["block"], "bucket": row["bucket"], "counts": pack(counts.astype(np.uint32)), "ids": pack(np.frombuffer(b"".join(found), kind))}], schema)

    return segment


def spread(values: np.ndarray, counts: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """The runs of ``values`` (run k has counts[k] of them) that ``picks`` names, one after another."""
    ends = np.cumsum(counts)
    n = counts[picks]
    total = int(n.sum())
    if not total:
        return values[:0]
    step = np.ones(total, np.int64)
    begins = (ends - counts)[picks[n > 0]]
    n = n[n > 0]
    step[0] = begins[0]
    step[np.cumsum(n)[:-1]] = begins[1:] - (begins[:-1] + n[:-1] - 1)
    return values[np.cumsum(step)]


def _answer(model, kind: type, decoded: bool):
    fields = [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), *([("decoded", pa.string())] if decoded else [])]

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = _processor(model.value) if decoded else None

        def ready(docs: list, ids: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            ends = np.append(0, np.cumsum(counts))
            cols = [pa.array(docs, pa.int64()), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))]
            if decoded:
                values = ids.tolist()
                cols.append(pa.array([processor.decode(values[a:b]) if b > a else "" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.string()))
            return pa.RecordBatch.from_arrays(cols, schema=pa.schema(fields))

        for batch in batches:
            for row in batch.to_pylist():
                docs, chunks = row["docs"], unpack(row["b"], np.uint32).astype(np.int64)
                found = sorted(row["answers"] or [], key=lambda x: x["bucket"])
                counts = np.concatenate([np.zeros(0, np.uint32), *[unpack(x["counts"], np.uint32) for x in found]]).astype(np.int64)
                values = np.concatenate([np.zeros(0, kind), *[unpack(x["ids"], kind) for x in found]])
                if len(counts) != row["n"]:
                    raise ValueError("chunks of a block have no ids")
                common = unpack(row["c"], np.uint32)
                picks = np.concatenate([common, np.arange(len(counts), dtype=np.uint32)])[unpack_numbers(row["a"])]
                sums = np.append(0, np.cumsum(counts[picks]))
                upto = np.append(0, np.cumsum(chunks))
                at = 0
                while at < len(docs):
                    end = max(at + 1, int(np.searchsorted(sums[upto], sums[upto[at]] + OUT, "right")) - 1)
                    end = min(end, len(docs))
                    yield ready(docs[at:end], spread(values, counts, picks[upto[at] : upto[end]]), np.diff(sums[upto[at : end + 1]]))
                    at = end

    return answer


def encode(docs: DataFrame, model_path: str, decoded: bool = False) -> DataFrame:
    """Ids of every whole text, as the library gives them without begin or end ids: ``doc_id, ids array<int>``.

    With ``decoded`` also the text that the library's decode(ids) gives. One row for
    each row of ``docs`` (doc_id, text; other columns are ignored), null and repeated
    doc_ids included; null and empty texts have no ids. A text is handled as part of a
    block of about 32 MB, a longer one alone.

    The model is checked: pieces must not cross marks and texts must not be rewritten
    before they are cut, else ValueError.
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        model = f.read()
    bare = spark.sparkContext.broadcast(without_prefix(model))  # one vocabulary file
    whole = spark.sparkContext.broadcast(model)
    kind = np.uint16 if _processor(model).get_piece_size() <= 1 << 16 else np.uint32

    path = scratch(spark, "blocks")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with shuffles_end(spark):
        rows.mapInArrow(_to_blocks, _BLOCKS).write.partitionBy("kind").option("compression", "uncompressed").parquet(path)
    blocks = spark.read.schema(_BLOCKS).parquet(path)
    asked = blocks.where("kind = 'chunks'").select("block", "a", "b", "c", "n")
    total = asked.agg(F.sum("n")).first()[0] or 0
    buckets = int(min(SLICES, max(1, -(-total // SHARE))))
    answers = scratch(spark, "answers")
    with shuffles_end(spark):
        split = asked.mapInArrow(_to_buckets(buckets), "bucket int, block long, sizes binary, chunks binary")
        done = split.repartitionById(buckets, F.col("bucket")).mapInArrow(_segment(bare, kind), _ANSWERS)
        done.write.option("compression", "uncompressed").parquet(answers)
    discard(spark, f"{path}/kind=chunks")
    # An array holds the answers to one block, whose chunks are bounded.
    met = spark.read.schema(_ANSWERS).parquet(answers).groupBy("block").agg(F.collect_list(F.struct("bucket", "counts", "ids")).alias("answers"))
    held = spark.read.schema(_BLOCKS).parquet(path).where("kind = 'numbers'").select("block", "docs", "a", "b", "c", "n")
    schema = "doc_id long, ids array<int>" + (", decoded string" if decoded else "")
    return held.join(met, "block", "left").select("docs", "a", "b", "c", "n", "answers").mapInArrow(_answer(whole, kind, decoded), schema)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, decoded``: the library's text of ``ids``. Null ids give a null text."""
    spark = encoded.sparkSession
    with open(model_path, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = _processor(model.value)
        for batch in batches:
            found = [None if x is None else processor.decode(x) if x else "" for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "decoded"])

    return encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(texts, "doc_id long, decoded string")
