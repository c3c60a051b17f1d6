"""Display forms of keys, numbers, dates and labels (PRJ-15..21, PRJ-26)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from issuerlake.functions.cleaning import ColumnOrName, _number, as_column, blank_to_null, digits, strip

DASH = "—"

# Words that stay in capitals inside a label.
ACRONYMS = {"cvm": "CVM", "ia": "IA", "cnpj": "CNPJ", "isin": "ISIN"}

# What each processing stage is called while it runs.
STAGE_LABELS = {
    "identidade": "Identificando emissor na ANBIMA",
    "cvm": "Acessando DFs na CVM",
    "mercado": "Acessando características na ANBIMA",
    "validacao_emissor": "Validando emissor",
    "peek_hashes": "Verificando duplicatas",
    "ia_quant": "Extraindo DFs dos PDFs (IA)",
    "ia_qual": "Transcrevendo PDFs (IA)",
    "finalizado": "Finalizando",
}

# What a finished job is called.
OUTCOME_LABELS = {
    "concluido": "Concluído",
    "concluido_com_erros": "Concluído com avisos",
    "erro": "Falhou",
}

# Texts read as yes and as no.
YES = ["true", "sim", "s", "1"]
NO = ["false", "nao", "não", "n", "0"]


def _lookup(table: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def _or_dash(c: Column) -> Column:
    return F.coalesce(c, F.lit(DASH))


def format_cnpj(c: ColumnOrName) -> Column:
    """PRJ-15: 99.999.999/9999-99; other lengths come back unchanged."""
    c = as_column(c)
    number = digits(c, cut=14)
    masked = F.regexp_replace(number, r"^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$", r"$1.$2.$3/$4-$5")
    return _or_dash(F.when(F.nullif(c, F.lit("")).isNull(), None).when(F.length(number) == 14, masked).otherwise(c))


def mask_cnpj(c: ColumnOrName) -> Column:
    """PRJ-15: the mask as far as the digits reach."""
    number = digits(c, cut=14)
    size = F.length(number)
    return (
        F.when(size <= 2, number)
        .when(size <= 5, F.regexp_replace(number, r"^(\d{2})(\d+)", r"$1.$2"))
        .when(size <= 8, F.regexp_replace(number, r"^(\d{2})(\d{3})(\d+)", r"$1.$2.$3"))
        .when(size <= 12, F.regexp_replace(number, r"^(\d{2})(\d{3})(\d{3})(\d+)", r"$1.$2.$3/$4"))
        .otherwise(F.regexp_replace(number, r"^(\d{2})(\d{3})(\d{3})(\d{4})(\d+)", r"$1.$2.$3/$4-$5"))
    )


def _finite(c: ColumnOrName) -> Column:
    number = _number(as_column(c).cast("string"))
    return F.when(~F.isnan(number) & (F.abs(number) != F.lit(float("inf"))), number)


def _grouped(number: Column, decimals: int) -> Column:
    pattern = "#,##0" + ("." + "#" * decimals if decimals else "")
    text = F.call_function("format_number", F.round(number, decimals), F.lit(pattern))
    return F.translate(text, ",.", ".,")


def fmt_number(c: ColumnOrName) -> Column:
    """PRJ-16: grouping dot, decimal comma, at most three decimals."""
    return _or_dash(_grouped(_finite(c), 3))


def fmt_currency(c: ColumnOrName) -> Column:
    """PRJ-16: whole reais, the sign before the symbol, a no-break space after it."""
    number = _finite(c)
    sign = F.when(number < 0, "-").otherwise("")
    return _or_dash(F.concat(sign, F.lit("R$\u00a0"), _grouped(F.abs(number), 0)))


def fmt_percent(c: ColumnOrName) -> Column:
    """PRJ-16: at most two decimals and a percent sign."""
    return _or_dash(F.concat(_grouped(_finite(c), 2), F.lit("%")))


def fmt_date(c: ColumnOrName) -> Column:
    """PRJ-16: dd/MM/yyyy in UTC."""
    return _or_dash(F.date_format(as_column(c).try_cast("timestamp"), "dd/MM/yyyy"))


def fmt_datetime(c: ColumnOrName) -> Column:
    """PRJ-16: dd/MM/yyyy, HH:mm in the session time zone."""
    return _or_dash(F.date_format(as_column(c).try_cast("timestamp"), "dd/MM/yyyy, HH:mm"))


def fmt_text(c: ColumnOrName) -> Column:
    return _or_dash(blank_to_null(c))


def bool_label(c: ColumnOrName) -> Column:
    """PRJ-17: Sim, Não, a dash for nothing, or the text as given."""
    text = as_column(c).cast("string")
    folded = F.lower(strip(text))
    return (
        F.when(text.isNull() | (text == ""), DASH)
        .when(folded.isin(YES), "Sim")
        .when(folded.isin(NO), "Não")
        .otherwise(text)
    )


def label(c: ColumnOrName) -> Column:
    """PRJ-18: words of an enum value, acronyms in capitals, first word capitalised."""
    words = F.split(F.lower(blank_to_null(c)), r"[\s_]+")
    shown = F.transform(
        words,
        lambda word, i: F.coalesce(
            _lookup(ACRONYMS, word),
            F.when(i == 0, F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, 2, 2_000_000))).otherwise(word),
        ),
    )
    return _or_dash(F.array_join(shown, " "))


def title_label(c: ColumnOrName) -> Column:
    """PRJ-18: every underscore-separated part capitalised, the rest kept."""
    parts = F.transform(
        F.split(as_column(c), "_"),
        lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 2_000_000)),
    )
    return F.array_join(parts, " ")


def stage_label(stage: ColumnOrName, status: ColumnOrName) -> Column:
    """PRJ-19: the outcome of a finished job, else what its stage is doing."""
    key = F.lower(blank_to_null(stage))
    return F.coalesce(
        _lookup(OUTCOME_LABELS, F.lower(strip(status))),
        _lookup(STAGE_LABELS, key),
        label(stage),
    )


def _accent_table() -> tuple[str, str]:
    """Every letter below U+2000 that is one base letter plus combining marks."""
    source, target = [], []
    for code in range(0xC0, 0x2000):
        char = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFD", char) if not "\u0300" <= x <= "\u036f")
        if base != char and len(base) == 1:
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _accent_table()


def fold(c: ColumnOrName) -> Column:
    """PRJ-20: search key without accents, in lower case, trimmed."""
    plain = F.regexp_replace(F.translate(as_column(c), _ACCENTED, _PLAIN), "[\u0300-\u036f]", "")
    return strip(F.lower(plain))


def norm_identifier(c: ColumnOrName) -> Column:
    """PRJ-21: text with letters in capitals; otherwise its digits, at most fourteen."""
    text = strip(c)
    return F.when(text.rlike("[A-Za-z]"), F.upper(text)).otherwise(
        F.coalesce(F.nullif(digits(text, cut=14), F.lit("")), F.upper(text))
    )


def direct_identifier(c: ColumnOrName) -> Column:
    """PRJ-21: a tax id or a code that can be opened without a search, else ''."""
    text = strip(c)
    number = digits(text, cut=14)
    code = F.upper(text)
    return (
        F.when(F.length(number) == 14, number)
        .when(code.rlike("^[A-Z0-9./-]+$"), code)
        .otherwise("")
    )


def identifier_kind(c: ColumnOrName) -> Column:
    """PRJ-21: ``cnpj``, ``code`` or ``text``."""
    text = strip(c)
    return (
        F.when(F.length(digits(text, cut=14)) == 14, "cnpj")
        .when(F.upper(text).rlike("^[A-Z0-9./-]+$"), "code")
        .otherwise("text")
    )


def join_parts(*parts: ColumnOrName, sep: str = " · ") -> Column:
    """PRJ-26: the non-empty parts of a selector label."""
    return F.concat_ws(sep, *[F.nullif(as_column(p).cast("string"), F.lit("")) for p in parts])
