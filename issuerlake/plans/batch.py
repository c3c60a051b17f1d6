"""Whole batch jobs: landing files to statements, market tables and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuerlake.functions.cleaning import digits, norm_code
from issuerlake.operators.aggregates import unnest_statements
from issuerlake.operators.filters import keep_codes
from issuerlake.operators.merges import consolidate_price_rows, consolidate_rows, override_periods
from issuerlake.operators.quality import balance_check, validation_totals
from issuerlake.operators.tables import write_partitioned
from issuerlake.sources import dossier, market, statements

STATEMENT_COLUMNS = ["cnpj", "data_ref", "tipo_doc", "demonstracao", "cd_conta", "ds_conta", "valor"]


def issuer_statements(
    spark: SparkSession, path: str, issuers: DataFrame, generation: int = 2, landed: bool = False, depth: int | None = None
) -> DataFrame:
    """Statement files to consolidated long rows of the monitored issuers."""
    codes = issuers.select(digits("cnpj").alias("cnpj"), norm_code("cod_cvm").alias("cod_cvm")).where("cod_cvm <> ''")
    rows = keep_codes(statements.read_statements(spark, path, landed), codes)
    merged = consolidate_rows(rows, generation, depth)
    return merged.join(codes.distinct(), "cod_cvm").select(*STATEMENT_COLUMNS)


def build_dossiers(
    spark: SparkSession, path: str, issuers: DataFrame, out: str, manual: DataFrame | None = None, **options
) -> DataFrame:
    """Consolidate, let manual periods win, write one dossier folder per issuer, and return the checks."""
    rows = issuer_statements(spark, path, issuers, **options)
    if manual is not None:
        rows = override_periods(rows, manual.select(*STATEMENT_COLUMNS))
    dossier.write_dossier(rows, out)
    written = dossier.read_written_dossier(spark, out)
    return validation_totals(balance_check(unnest_statements(written)))


def market_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Landing payloads to characteristics, schedule and daily history, cleaned."""
    instruments = market.clean_characteristics(market.read_characteristics(spark, path))
    return {
        "deb_caracteristicas": instruments,
        "deb_agenda": market.clean_schedule(market.read_schedule(spark, path)),
        "deb_historico_diario": consolidate_price_rows(market.read_price_rows(spark, path)).withColumn(
            "data_referencia", F.try_to_date("data_referencia", "yyyy-MM-dd")
        ),
    }


def compact_payloads(spark: SparkSession, path: str, out: str) -> None:
    """SNK-8: the raw price payloads of every instrument as one history folder each. Inputs stay where they are."""
    write_partitioned(consolidate_price_rows(market.read_price_rows(spark, path)), out, ["ticker_deb"])
