"""Keys, codes, numbers and dates as they arrive in raw files (PRJ-1..10, PRJ-14)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Every character that counts as white space when a text is stripped.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# How infinity is written. A cast also reads type suffixes and
# hexadecimal, which are no plain numbers and are told by these letters.
_INFINITY = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"]
_SUFFIX_OR_HEX = "[dDfFxX]"

# The two ways a remuneration text names its indexer and rate.
_SPREAD_OVER_INDEX = r"([\p{L}\p{N}_]+)\s*\+\s*([0-9.,]+)%"
_SHARE_OF_INDEX = r"(?i)([0-9.,]+)%\s*do\s*([\p{L}\p{N}_]+)"


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnOrName, chars: str = WHITE_SPACE) -> Column:
    return F.btrim(as_column(c), F.lit(chars))


def rstrip(c: ColumnOrName, chars: str = WHITE_SPACE) -> Column:
    return F.rtrim(as_column(c), F.lit(chars))


def blank_to_null(c: ColumnOrName) -> Column:
    """PRJ-14: trimmed text, null when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def upper_key(c: ColumnOrName) -> Column:
    """PRJ-14: a trimmed, upper-case key."""
    return F.upper(strip(c))


def digits(c: ColumnOrName, pad: int | None = None, cut: int | None = None) -> Column:
    """PRJ-1: the digits of a tax id, optionally zero-padded or cut; null gives ''.

    Padding only ever lengthens: ``lpad`` alone would also truncate.
    """
    out = F.regexp_replace(F.coalesce(as_column(c).cast("string"), F.lit("")), "[^0-9]", "")
    if cut is not None:
        out = F.substring(out, 1, cut)
    if pad is not None:
        out = F.when(F.length(out) < pad, F.lpad(out, pad, "0")).otherwise(out)
    return out


def norm_code(c: ColumnOrName) -> Column:
    """PRJ-2: registry code without surrounding blanks or leading zeros."""
    code = strip(c)
    bare = F.coalesce(F.nullif(F.ltrim(code, F.lit("0")), F.lit("")), F.lit("0"))
    return F.when(as_column(c).rlike(r"^[\s\p{Z}]*[0-9]+[\s\p{Z}]*$"), bare).otherwise(code)


def account_level(c: ColumnOrName) -> Column:
    """PRJ-3: depth of an account code, one per dot-separated segment."""
    code = as_column(c)
    return F.length(code) - F.length(F.replace(code, F.lit("."), F.lit(""))) + 1


def _number(c: Column) -> Column:
    text = strip(c)
    plain = ~c.rlike(_SUFFIX_OR_HEX) | F.lower(text).isin(_INFINITY)
    return F.when(plain, text.try_cast("double"))


def parse_money(c: ColumnOrName, style: str = "br") -> Column:
    """PRJ-4: amount as double, null when it does not parse.

    ``br`` drops every dot and reads the comma as decimal mark, so "123.45" is
    12345. ``dot`` reads a plain decimal-dot number.
    """
    text = as_column(c).cast("string")
    if style == "br":
        text = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    elif style != "dot":
        raise ValueError(f"unknown money style: {style}")
    return _number(text)


def parse_decimal(c: ColumnOrName) -> Column:
    """PRJ-5: decimal comma or dot; "1.234,56" has two marks and gives null."""
    return _number(F.replace(as_column(c).cast("string"), F.lit(","), F.lit(".")))


def parse_int(c: ColumnOrName) -> Column:
    """PRJ-6: integer part of a number, truncated toward zero."""
    return _number(as_column(c).cast("string")).try_cast("long")


def date10(c: ColumnOrName) -> Column:
    """PRJ-7: the first ten characters of a date or timestamp text."""
    text = as_column(c).cast("string")
    return F.when(text != "", F.substring(text, 1, 10))


def parse_date(c: ColumnOrName) -> Column:
    return F.try_to_date(date10(c), "yyyy-MM-dd")


def parse_remuneration(text: ColumnOrName, indexer: ColumnOrName) -> Column:
    """PRJ-8: struct(indexer, rate) of "IPCA + 5,5%" or "100% do CDI".

    The text is read only where the structured indexer is missing.
    """
    text = as_column(text)
    given = F.nullif(F.nullif(as_column(indexer), F.lit("")), F.lit("None"))
    spread, share = text.rlike(_SPREAD_OVER_INDEX), text.rlike(_SHARE_OF_INDEX)
    name = (
        F.when(spread, F.upper(F.regexp_extract(text, _SPREAD_OVER_INDEX, 1)))
        .when(share, F.upper(F.regexp_extract(text, _SHARE_OF_INDEX, 2)))
    )
    rate = (
        F.when(spread, parse_decimal(F.regexp_extract(text, _SPREAD_OVER_INDEX, 2)))
        .when(share, parse_decimal(F.regexp_extract(text, _SHARE_OF_INDEX, 1)))
    )
    return F.struct(
        F.coalesce(given, name).alias("indexer"),
        F.when(given.isNull(), rate).alias("rate"),
    )


def unit_price(volume: ColumnOrName, quantity: ColumnOrName) -> Column:
    """PRJ-9: volume per unit, null when either side is null or zero."""
    volume, quantity = as_column(volume), as_column(quantity)
    return F.when(volume != 0, F.try_divide(volume, quantity))


def tenor_years(start: ColumnOrName, end: ColumnOrName) -> Column:
    """PRJ-10: years between two dates, two decimals."""
    return F.round(F.datediff(as_column(end), as_column(start)) / F.lit(365.25), 2)
