"""How a query of the catalogue is declared.

Each query names the operator it exercises, runs it over whole tables, and may
carry the same question in SQL. Results are flat: dates and arrays as text,
doubles rounded, so that two engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



class Tables:
    """The given tables by name, read when first asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[Tables], DataFrame]):
        if name in CATALOG:
            raise ValueError(f"query registered twice: {name}")
        CATALOG[name] = Query(run, sql.strip() if sql else None)
        return run

    return register


def day(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


# The credit tables as the given tables stand in for them. Keys stay numeric.
ISSUERS_SQL = """(select c_custkey as cnpj, c_name as nome, c_mktsegment as grupo_economico, c_mktsegment as setor,
    case when c_acctbal >= 0 then 'Aberto' else 'Fechado' end as tipo_capital from customer)"""

INSTRUMENTS_SQL = """(select o_orderkey as ticker_deb, o_custkey as cnpj,
    case o_orderstatus when 'F' then 'ativo' when 'O' then 'vencido' else 'resgatado' end as status,
    cast(o_orderdate as date) as data_vencimento, o_totalprice as volume_emissao, o_orderpriority as indexador,
    case when o_orderpriority = '1-URGENT' then 'Sim' else 'Não' end as lei_incentivo from orders)"""

SCHEDULE_SQL = """(select l_orderkey as ticker_deb, cast(l_shipdate as date) as data_evento, l_returnflag as evento,
    l_discount as taxa, l_extendedprice as valor,
    case when l_linestatus = 'O' then 'Previsto' else 'Liquidado' end as status from lineitem)"""


def issuers(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("cnpj"), F.col("c_name").alias("nome"),
        F.col("c_mktsegment").alias("grupo_economico"), F.col("c_mktsegment").alias("setor"),
        F.when(F.col("c_acctbal") >= 0, "Aberto").otherwise("Fechado").alias("tipo_capital"),
    )


def instruments(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    return t.orders.select(
        F.col("o_orderkey").alias("ticker_deb"), F.col("o_custkey").alias("cnpj"),
        F.when(status == "F", "ativo").when(status == "O", "vencido").otherwise("resgatado").alias("status"),
        F.to_date("o_orderdate").alias("data_vencimento"), F.col("o_totalprice").alias("volume_emissao"),
        F.col("o_orderpriority").alias("indexador"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Sim").otherwise("Não").alias("lei_incentivo"),
    )


def schedule(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("ticker_deb"), F.to_date("l_shipdate").alias("data_evento"),
        F.col("l_returnflag").alias("evento"), F.col("l_discount").alias("taxa"), F.col("l_extendedprice").alias("valor"),
        F.when(F.col("l_linestatus") == "O", "Previsto").otherwise("Liquidado").alias("status"),
    )
