"""Seed lists, the company registry and registry-code overrides (SRC-1, SRC-2, SRC-11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuerlake.functions.cleaning import blank_to_null, digits


def text_schema(*columns: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# The columns of the two seed lists, spelled as in the files.
EMISSIONS = text_schema("ticker", "cnpj_emissor", "tipo", "obervacao")
ISSUERS = text_schema("nome", "cnpj", "cod_cvm", "tipo_capital", "ticker_acao", "categoria", "observacao")

# The registry is published in ISO-8859-1, one row per registration.
LATIN = {"sep": ";", "encoding": "ISO-8859-1", "header": True, "quote": '"', "enforceSchema": False}


def read_seed(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = ()) -> DataFrame:
    """SRC-1: a comma-separated UTF-8 list; rows without a required key are dropped ("nan" counts as empty)."""
    df = spark.read.csv(path, schema=schema, header=True, encoding="UTF-8", enforceSchema=False)
    for c in required:
        df = df.where(F.coalesce(blank_to_null(c), F.lit("nan")) != "nan")
    return df.withColumnRenamed("obervacao", "observacao") if "obervacao" in df.columns else df


def file_position() -> list:
    """Where a row stands in its files. Only valid directly on a scan."""
    return [
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
    ]


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2: the company registry with its row order, needed to break ties between registrations."""
    df = spark.read.options(**LATIN).csv(path)
    return df.select("CNPJ_CIA", "CD_CVM", "CATEG_REG", "SIT", "SIT_REG", *file_position()).withColumn(
        "file_order", F.struct("file_path", "block_start", "row_id")
    ).drop("file_path", "block_start", "row_id")


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """SRC-11: manual corrections, one JSON object from issuer id to registry code."""
    text = spark.read.text(path, wholetext=True)
    pairs = F.explode(F.from_json("value", T.MapType(T.StringType(), T.StringType()))).alias("cnpj", "cod_cvm")
    return text.select(pairs).select(digits("cnpj").alias("cnpj"), "cod_cvm")
