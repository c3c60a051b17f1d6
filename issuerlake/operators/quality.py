"""Balance, gaps, coverage and constraint checks (AGG-6..9, DQ-1..6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuerlake.operators.ordering import null_safe

# The accounts whose totals must agree.
ASSETS = ("BPA", "1")
LIABILITIES = ("BPP", "2")


def _whole(c: Column) -> Column:
    return F.format_number(c, 0)


def compare_totals(df: DataFrame, left: str, right: str, tolerance: float = 0.001) -> DataFrame:
    """Three-valued agreement of two totals, relative to the left one, with a message."""
    a, b = F.col(left), F.col(right)
    gap = F.abs(a - b)
    known = a.isNotNull() & b.isNotNull()
    both = F.concat(F.lit("  Ativo="), _whole(a), F.lit("  P+PL="), _whole(b))
    balanced = F.when(known, gap <= F.abs(a) * tolerance)
    return df.withColumn("balanced", balanced).withColumn(
        "message",
        F.when(~known, "dados insuficientes")
        .when(F.col("balanced"), F.concat(F.lit("OK"), both))
        .otherwise(F.concat(F.lit("DIVERGE"), both, F.lit("  Diff="), _whole(gap))),
    )


def balance_check(df: DataFrame, tolerance: float = 0.001, keys: Sequence[str] = ("cnpj", "data_ref")) -> DataFrame:
    """AGG-6: assets against liabilities and equity per period; null where a side is missing."""

    def total(account: tuple[str, str]) -> Column:
        statement, code = account
        return F.max(F.when((F.col("demonstracao") == statement) & (F.col("cd_conta") == code), F.col("valor")))

    totals = df.groupBy(*keys).agg(total(ASSETS).alias("assets"), total(LIABILITIES).alias("liabilities"))
    return compare_totals(totals, "assets", "liabilities", tolerance)


def year_gaps(df: DataFrame, key: str, date: str) -> DataFrame:
    """AGG-7: years without a period between the first and last one, as a sorted array."""
    year = F.year(F.to_date(date))
    pairs = df.select(key, year.alias("_year")).where("_year is not null").distinct()
    years = pairs.groupBy(key).agg(
        F.min("_year").alias("first_year"), F.max("_year").alias("last_year"), F.collect_list("_year").alias("_years")
    )
    span = F.sequence("first_year", "last_year")
    return years.withColumn("gaps", F.array_sort(F.array_except(span, "_years"))).drop("_years")


def coverage_report(df: DataFrame, key: str = "cnpj", period: str = "data_ref") -> DataFrame:
    """AGG-8: per issuer, number of periods and the first and last of them."""
    periods = df.groupBy(key, period).agg(F.count(F.lit(1)).alias("_n"))
    return periods.groupBy(key).agg(
        F.count(period).alias("n_periods"),
        F.min(period).alias("first_period"),
        F.max(period).alias("last_period"),
        F.sum("_n").alias("n_rows"),
    )


def period_report(df: DataFrame, keys: Sequence[str] = ("cnpj", "data_ref")) -> DataFrame:
    """AGG-8: per issuer and period, document type, sorted statement list and account count."""
    counted = df.groupBy(*keys, "tipo_doc", "demonstracao").agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(*keys).agg(
        F.max("tipo_doc").alias("tipo_doc"),
        F.array_sort(F.collect_set("demonstracao")).alias("demonstracoes"),
        F.sum("_n").alias("n_rows"),
    )


def validation_totals(balances: DataFrame) -> DataFrame:
    """AGG-9: periods checked, divergent ones, and those without enough data."""
    return balances.agg(
        F.count(F.lit(1)).alias("n_periods"),
        F.count_if(~F.col("balanced")).alias("n_divergent"),
        F.count_if(F.col("balanced").isNull()).alias("n_unknown"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], nulls_equal: bool = True) -> DataFrame:
    """DQ-1, DQ-2: keys that occur more than once.

    With ``nulls_equal`` two nulls are the same key (NULLS NOT DISTINCT); without
    it a key holding a null never repeats.
    """
    if not nulls_equal:
        df = df.dropna(subset=list(keys))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-3: child rows whose non-null key has no parent."""
    return child.dropna(subset=list(keys)).join(parent.select(*keys).distinct(), list(keys), "left_anti")


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """DQ-4: one row per required column with its number of nulls; one pass over the data."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in columns])).alias("_r")
    ).select("_r.column", "_r.n_null")


def expected_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """DQ-5: whether each expected column exists, and how many values it holds."""
    have = set(df.columns)
    counts = df.agg(*[(F.count(c) if c in have else F.lit(0).cast("long")).alias(f"c{i}") for i, c in enumerate(expected)])
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit(c in have).alias("present"), F.col(f"c{i}").alias("n_values"))
        for i, c in enumerate(expected)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def missing_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """DQ-5: expected columns the table does not have."""
    return expected_columns(df, expected).where(~F.col("present")).select("column")


def enum_violations(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """DQ-6: values outside the allowed set and how often each occurs; null is not a value."""
    return df.where(~F.col(col).isin(list(allowed))).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def broken_references(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-3: orphan keys with their number of child rows; children are counted before the join."""
    counted = child.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    right = parent.select(*keys).distinct().alias("p")
    return counted.alias("c").join(right, null_safe("c", "p", keys), "left_anti")
