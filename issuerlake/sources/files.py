"""Document files (SRC-12..14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest accepted document, and how a PDF starts.
MAX_BYTES = 40 * 1024 * 1024
PDF_MAGIC = "25504446"


def list_documents(spark: SparkSession, root: str, pattern: str = "*.pdf", ordered: bool = False) -> DataFrame:
    """SRC-12: documents below a folder with name, size, content and content hash.

    ``ordered`` sorts by path, which moves every content through a shuffle. Spark's
    file sources pass over empty files, so those never show up here.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    listed = files.select(
        "path", F.regexp_extract("path", r"([^/]+)$", 1).alias("nome_arquivo"), F.col("length").alias("size"),
        F.col("modificationTime").alias("modified_at"), F.md5("content").alias("hash_md5"), "content",
    )
    return listed.orderBy("path") if ordered else listed


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path, size and modification time below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified_at"))


def name_matches(name: str, substrings: Sequence[str]) -> Column:
    low = F.lower(F.col(name))
    match = F.lit(False)
    for s in substrings:
        match = match | F.contains(low, F.lit(s.lower()))
    return match


def select_documents(
    df: DataFrame, substrings: Sequence[str] = (), limit: int | None = None, name: str = "nome_arquivo", order: str = "path"
) -> DataFrame:
    """SRC-13: documents whose name holds any substring, the first ``limit`` by path."""
    out = df.where(name_matches(name, substrings)) if substrings else df
    return out.orderBy(order).limit(limit) if limit else out


def intake(df: DataFrame, name: str = "nome_arquivo", size: str = "size", content: str = "content") -> DataFrame:
    """SRC-14: every upload with its name defaulted and the reason it is refused, null when accepted."""
    magic = F.hex(F.substring(F.col(content).cast("binary"), 1, 4))
    return df.withColumn(name, F.coalesce(F.nullif(F.trim(name), F.lit("")), F.lit("sem_nome.pdf"))).withColumn(
        "reject_reason",
        F.when(F.coalesce(F.col(size), F.lit(0)) == 0, "empty")
        .when(F.col(size) > MAX_BYTES, "too_large")
        .when(magic != PDF_MAGIC, "not_pdf"),
    )


def accept_files(df: DataFrame, pdf_only: bool = False, **columns: str) -> DataFrame:
    """SRC-14: uploads with content; ``pdf_only`` also refuses other formats and oversized files."""
    reason = F.col("reject_reason")
    keep = reason.isNull() if pdf_only else ~reason.eqNullSafe("empty")
    return intake(df, **columns).where(keep).drop("reject_reason")
