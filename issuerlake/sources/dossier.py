"""Dossier files and manual statement files (SRC-9, SRC-10, SNK-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuerlake.functions.cleaning import digits
from issuerlake.operators.aggregates import nest_statements
from issuerlake.operators.documents import PERIOD
from issuerlake.operators.tables import write_partitioned
from issuerlake.sources.seeds import text_schema

DOSSIER = T.StructType([
    *text_schema("cnpj", "cod_cvm", "nome").fields,
    T.StructField("periodos", T.MapType(T.StringType(), PERIOD)),
])


def _read(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    parts = F.split("_metadata.file_path", "/")
    return reader.text(root, wholetext=True).select(
        F.element_at(parts, -2).alias("_folder"),
        F.regexp_replace(F.element_at(parts, -1), r"\.json$", "").alias("_stem"),
        F.from_json("value", DOSSIER).alias("_d"),
    )


def read_dossier(spark: SparkSession, root: str) -> DataFrame:
    """SRC-9: dossiers, being the files named as the folder they lie in."""
    return _read(spark, root, "*.json").where(F.col("_stem") == F.col("_folder")).select(
        F.coalesce(F.nullif(digits("_d.cnpj"), F.lit("")), F.col("_folder")).alias("cnpj"),
        F.col("_d.cod_cvm").alias("cod_cvm"), F.col("_d.nome").alias("nome"), F.col("_d.periodos").alias("periodos"),
    )


def read_manual(spark: SparkSession, root: str, file_name: str = "dados_financeiros.json") -> DataFrame:
    """SRC-10: manual statements, one file per issuer folder."""
    return _read(spark, root, file_name).select(
        F.col("_folder").alias("cnpj"), F.col("_d.periodos").alias("periodos")
    )


def write_dossier(statements: DataFrame, root: str) -> None:
    """SNK-1: long statements as JSON lines in one folder per issuer, one line per period."""
    write_partitioned(nest_statements(statements), root, ["cnpj"], fmt="json")


def read_written_dossier(spark: SparkSession, root: str) -> DataFrame:
    """The periods ``write_dossier`` wrote."""
    schema = T.StructType([
        T.StructField("cnpj", T.StringType()), T.StructField("data_ref", T.StringType()), *PERIOD.fields,
    ])
    return spark.read.schema(schema).json(root)
