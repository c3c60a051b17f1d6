"""Toxicity of texts: a subword-bag classifier (see ``subword``) fitted on labelled rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuerlake.llm import subword
from issuerlake.llm.shared import Shared

THRESHOLD = 0.7


def held_out(doc_id: Column, of: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of == fold, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, limit: int = subword.SAMPLE) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``.

    Learns from at most ``limit`` rows of ``labels`` (doc_id, toxic) whose
    crc32(doc_id as text) mod 3 is not 1, and from their texts. Score is the
    probability of label 1; null, empty and wordless texts get that of an empty bag.
    Null labels are not learned from; of several labels of one id the smallest
    counts. Without two labels to learn from every score is 0. Repeated rows give a
    row each. Columns other than doc_id, text and toxic are ignored.
    """
    docs = docs.select("doc_id", "text")
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).where(~held_out(F.col("doc_id"), 3, 1))
    model = subword.fit(subword.sample(known, docs, limit))
    toxic = model.classes.index(1) if 1 in model.classes and len(model.classes) > 1 else None
    shared = Shared(docs.sparkSession, model)  # classes x BUCKETS numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = shared.value.scores(batch.column(2))[:, toxic] if toxic is not None else np.zeros(len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"]
            )

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "text")
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")
