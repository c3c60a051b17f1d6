"""Counts, totals, nested forms and cost models (AGG-1..5, AGG-10..17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuerlake.functions.cleaning import ColumnOrName, as_column, strip
from issuerlake.operators.ordering import Order, up
from issuerlake.operators.windows import dedupe, positions

def portfolio_summary(df: DataFrame, volume: str = "volume_emissao", incentive: str = "lei_incentivo") -> DataFrame:
    """AGG-1: operations, total of finite volumes, incentivised and other operations."""
    value = F.col(volume)
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    flagged = F.coalesce(F.col(incentive).cast("string").isin("true", "Sim"), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("total_operacoes"),
        F.coalesce(F.sum(F.when(finite, value)), F.lit(0.0)).alias("total_volume"),
        F.count_if(flagged).alias("incentivadas"),
        F.count_if(~flagged).alias("nao_incentivadas"),
    )


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """AGG-2, AGG-11: exact rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_set(df: DataFrame, key: str, col: str) -> DataFrame:
    """AGG-3: the distinct non-empty values of each key, one row each."""
    return df.where(F.col(col).isNotNull() & (F.col(col).cast("string") != "")).select(key, col).distinct()


def distinct_domain(df: DataFrame, key: str, col: str, name: str) -> DataFrame:
    """AGG-3: sorted array of the values of an enum column per key, collected from distinct pairs."""
    return df.select(key, col).distinct().groupBy(key).agg(F.array_sort(F.collect_list(col)).alias(name))


def nest_statements(df: DataFrame, order: Order | None = None) -> DataFrame:
    """AGG-4: long statement rows as one row per issuer and period.

    The row holds the document type and a map statement -> account -> entry. Rows
    count in listing order: the first document type labels the period and the last
    row of an account wins. Duplicates leave before anything is collected, so a
    group never holds more than the accounts of one period.
    """
    rows = df.where(
        F.col("data_ref").isNotNull()
        & (F.coalesce(F.col("tipo_doc"), F.lit("")) != "")
        & (F.coalesce(F.col("demonstracao"), F.lit("")) != "")
        & (strip("cd_conta") != "")
    ).withColumn("cd_conta", strip("cd_conta"))
    rows = rows.where("cnpj is not null")
    # Accounts, statements and periods are one chain of aggregates over one scan; the period's label goes along in ``_first``.
    entry = F.struct("cd_conta", "ds_conta", "valor")
    if order is None:
        first, pick, entry = F.col("tipo_doc"), F.max, F.min_by(entry, "tipo_doc")
    else:
        first, pick, entry = F.struct(F.struct(*order).alias("at"), "tipo_doc"), F.min, F.max_by(entry, F.struct(*order))
    entries = rows.groupBy("cnpj", "data_ref", "demonstracao", "cd_conta").agg(entry.alias("_entry"), pick(first).alias("_first"))
    # A period's accounts meet once, sorted by statement and code, and its maps are cut from that list.
    account = F.struct("demonstracao", "cd_conta", "_entry")
    periods = entries.groupBy("cnpj", "data_ref").agg(F.array_sort(F.collect_list(account)).alias("_accounts"), pick("_first").alias("_first"))

    def accounts(name: Column) -> Column:
        own = F.filter("_accounts", lambda a: a["demonstracao"] == name)
        return F.map_from_entries(F.transform(own, lambda a: F.struct(a["cd_conta"], a["_entry"])))

    names = F.array_distinct(F.transform("_accounts", lambda a: a["demonstracao"]))
    nested = F.map_from_entries(F.transform(names, lambda n: F.struct(n, accounts(n))))
    tipo = F.col("_first") if order is None else F.col("_first.tipo_doc")
    return periods.select("cnpj", "data_ref", tipo.alias("tipo"), nested.alias("demonstracoes"))


def unnest_statements(df: DataFrame, untyped: str = "skip") -> DataFrame:
    """AGG-5: nested statements as long rows.

    Accepts one row per period (``data_ref``, ``tipo``, ``demonstracoes``) or one
    row per issuer with a ``periodos`` map. A blank account code falls back to
    its map key. Periods without a type are skipped, or labelled "?" with
    ``untyped='mark'``.
    """
    if "periodos" in df.columns:
        df = df.select("cnpj", F.explode("periodos").alias("data_ref", "_period")).select(
            "cnpj", "data_ref", F.col("_period.tipo").alias("tipo"), F.col("_period.demonstracoes").alias("demonstracoes")
        )
    kind = F.nullif("tipo", F.lit(""))
    if untyped == "mark":
        kind = F.coalesce(kind, F.lit("?"))
    elif untyped != "skip":
        raise ValueError(f"untyped must be skip or mark, not {untyped}")
    return (
        df.select("cnpj", "data_ref", kind.alias("tipo_doc"), F.explode("demonstracoes").alias("demonstracao", "_accounts"))
        .where(F.col("tipo_doc").isNotNull())
        .select("cnpj", "data_ref", "tipo_doc", "demonstracao", F.explode("_accounts").alias("_key", "_entry"))
        .select(
            "cnpj", "data_ref", "tipo_doc", "demonstracao",
            strip(F.coalesce(F.nullif(F.col("_entry.cd_conta"), F.lit("")), F.col("_key"))).alias("cd_conta"),
            F.col("_entry.ds_conta").alias("ds_conta"),
            F.col("_entry.valor").alias("valor"),
        )
        .where(F.col("cd_conta") != "")
    )


def extraction_counts(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """AGG-10: periods and accounts of each extraction result."""
    per_period = df.groupBy(*keys, period).agg(F.count(F.lit(1)).alias("_n"))
    return per_period.groupBy(*keys).agg(
        F.count(period).alias("n_periods"), F.sum("_n").alias("n_accounts")
    )


def most_common(df: DataFrame, keys: Sequence[str], col: str, seen: str) -> DataFrame:
    """AGG-12: most frequent value per key; of equals, the one seen first.

    Counted per value first, so only distinct values meet in the second step.
    """
    counted = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(
        F.count(F.lit(1)).alias("n"), F.min(seen).alias("_first")
    )
    return dedupe(counted, list(keys), [F.desc("n"), up("_first"), up(col)]).drop("_first")


def outcome_summary(df: DataFrame, keys: Sequence[str], col: str, groups: dict[str, Sequence[str]]) -> DataFrame:
    """AGG-13: rows per outcome group, all rows, and the share of rows that did not fail, in percent.

    ``groups`` names each output column and the outcomes it counts; a column
    called ``failed`` holds the failures.
    """
    tallies = [
        F.count_if(F.coalesce(F.col(col).isin(list(values)), F.lit(False))).alias(name)
        for name, values in groups.items()
    ]
    out = df.groupBy(*keys).agg(*tallies, F.count(F.lit(1)).alias("total"))
    if "failed" in groups:
        out = out.withColumn(
            "success_rate", F.round(F.try_divide((F.col("total") - F.col("failed")) * 100.0, F.col("total")), 2)
        )
    return out


def ingest_counters(events: DataFrame, job: str = "job_id") -> DataFrame:
    """AGG-14: per job, what each track processed, skipped and failed, and the final status.

    Events carry ``track`` (quant, qual) and ``outcome`` (processed, fallback,
    empty, skipped, failed). Fallback and empty are processed documents with a
    warning; failed ones have their own counter.
    """
    quant, qual = F.col("track") == "quant", F.col("track") == "qual"
    outcome = F.col("outcome")
    return events.groupBy(job).agg(
        F.count_if(quant & (outcome == "processed")).alias("quant_processados"),
        F.count_if(qual & outcome.isin("processed", "fallback", "empty")).alias("qual_processados"),
        F.count_if(qual & (outcome == "fallback")).alias("qual_fallback"),
        F.count_if(qual & (outcome == "empty")).alias("qual_sem_conteudo"),
        F.count_if(quant & (outcome == "skipped")).alias("pulados_quant"),
        F.count_if(qual & (outcome == "skipped")).alias("pulados_qual"),
        F.count_if(outcome == "failed").alias("falhas"),
        F.count_if(outcome.isin("fallback", "empty", "failed")).alias("erros"),
    ).withColumn("status", F.when(F.col("erros") > 0, "concluido_com_erros").otherwise("concluido"))


def chunk_metrics(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-15: chunks, truncated chunks, summed latency, tokens and cost, and how often each finish reason came."""
    per_reason = df.groupBy(*keys, "finish_reason").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if("truncated").alias("_cut"),
        *[F.sum(c).alias(c) for c in ("latency", "tokens_in", "tokens_out", "tokens_thinking", "cost")],
    )
    return per_reason.groupBy(*keys).agg(
        F.sum("_n").alias("n_chunks"),
        F.sum("_cut").alias("n_truncated"),
        F.array_sort(F.collect_list(F.struct(F.col("finish_reason"), F.col("_n").alias("n")))).alias("finish_reasons"),
        F.round(F.sum("latency"), 2).alias("latency"),
        F.sum("tokens_in").alias("tokens_in"),
        F.sum("tokens_out").alias("tokens_out"),
        F.sum("tokens_thinking").alias("tokens_thinking"),
        F.round(F.sum("cost"), 6).alias("cost"),
    )


def call_cost(df: DataFrame, prices: DataFrame, model: str = "model") -> DataFrame:
    """AGG-16: cost of each call: input tokens and generated tokens at the model's prices per million."""
    generated = F.coalesce("tokens_out", F.lit(0)) + F.coalesce("tokens_thinking", F.lit(0))
    return (
        df.join(prices.select(model, "price_in", "price_out"), model)
        .withColumn(
            "cost",
            F.coalesce("tokens_in", F.lit(0)) / 1e6 * F.col("price_in") + generated / 1e6 * F.col("price_out"),
        )
        .drop("price_in", "price_out")
    )


def model_cost(df: DataFrame, prices: DataFrame, model: str = "model") -> DataFrame:
    """AGG-16: tokens and cost per model over all its calls; tokens are summed before prices are joined."""
    tokens = df.groupBy(model).agg(
        *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("tokens_in", "tokens_out", "tokens_thinking")]
    )
    return call_cost(tokens, prices, model).withColumn("cost", F.round("cost", 6))


def nest_children(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], part: ColumnOrName,
    name: str = "items", descending: bool = False,
) -> DataFrame:
    """AGG-17: child rows of each key as sorted arrays, one row per key and part.

    ``part`` is a coarse, order-preserving form of the sort column (the year of a
    date, say). It bounds an array however many rows the key has; reading the
    parts of a key in order gives the whole list.
    """
    fields = [*order, *[c for c in columns if c not in order]]
    items = F.sort_array(F.collect_list(F.struct(*fields)), asc=not descending)
    return df.groupBy(*keys, as_column(part).alias("part")).agg(items.alias(name), F.count(F.lit(1)).alias("n_items"))


def nest_blocks(
    df: DataFrame, keys: Sequence[str], order: Order, columns: Sequence[str], size: int = 1000, name: str = "items"
) -> DataFrame:
    """AGG-17 in blocks of ``size`` rows: child rows of each key as sorted arrays, one row per key and block (``part``, from 0).

    No array is longer than ``size``, whatever the key or the dates of its rows; each
    entry carries its ``position`` in the key.
    """
    placed = positions(df.select(*dict.fromkeys([*keys, *columns])), keys, order)
    items = F.sort_array(F.collect_list(F.struct("position", *columns)))
    block = F.floor(F.col("position") / size).cast("int")
    return placed.groupBy(*keys, block.alias("part")).agg(items.alias(name), F.count(F.lit(1)).alias("n_items"))
