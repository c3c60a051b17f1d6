"""Null placement of the relational store the data comes from: nulls last going up, first going down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuerlake.functions.cleaning import ColumnOrName, as_column

Order = Sequence[ColumnOrName]


def up(c: ColumnOrName) -> Column:
    return as_column(c).asc_nulls_last()


def down(c: ColumnOrName) -> Column:
    return as_column(c).desc_nulls_first()


def order_columns(order: Order) -> list[Column]:
    """Names sort upward; columns keep the direction they carry."""
    return [up(F.col(c)) if isinstance(c, str) else c for c in order]


def null_safe(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equality of two aliased frames on their keys, nulls being equal."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


# Columns of natural keys: they break ties, so that a range sort can split one hot date over tasks.
KEY_COLUMNS = ["cnpj", "ticker_deb", "data_evento", "evento", "data_base", "data_referencia", "hash_md5", "id"]


def ties(df: DataFrame, named: Sequence[str]) -> list[Column]:
    """The key columns a frame has beyond those it is sorted by already, upward."""
    return [up(F.col(c)) for c in KEY_COLUMNS if c in df.columns and c not in named]
