"""Line noise, document names and document types (TXT-1..3, TXT-14, FLT-10, PRJ-27)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from issuerlake.functions.cleaning import WHITE_SPACE, ColumnOrName, as_column, rstrip, strip

# Everything that ends a line, and the marks other than a line feed.
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"
_OTHER_BREAKS = ["\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029"]

# File-name parts of documents without financial statements.
NON_FINANCIAL_NAME_PARTS = [
    "escritura", "ata ", "_ata_", "rating", "garantia", "guarantee", "contrato", "indeniz",
    "aditivo", "alienacao", "alienação", "alienao", "cessao", "cessão", "fiduciaria",
    "fiduciária", "fiduciria", "creditorio", "creditório", "creditor", "direitos",
    "publicitar", "cadastral", "referencia", "referência", "emissao", "emissão", "refi",
    "corporate", "material", "formulario", "formulário", "comunicado", "escritur",
]

# File-name parts of documents with financial statements.
FINANCIAL_NAME_PARTS = [
    "demonstr", "dfp", "itr", "release", "resultado", "financeira", "balanço", "balanco",
    "trimestral", "anual",
]

# Phrases that mark a page as holding statements.
FINANCIAL_PAGE_PHRASES = [
    "ativo total", "ativo circulante", "passivo total", "patrimônio líquido", "receita líquida",
    "receita operacional", "lucro bruto", "ebitda", "fluxo de caixa", "atividades operacionais",
    "prejuízo do exercício", "lucro do exercício", "resultado líquido", "balanço patrimonial",
    "demonstração do resultado", "demonstração dos fluxos", "total assets", "net revenue",
]

# Document types and the pattern that recognises each, first match wins.
DOCUMENT_TYPES = {
    "DFP": r"(demonstra[çc][õo]es\s+financeiras|dfp|demonstra[çc][õo]es\s+completas|financial\s+statements|balan[çc]o(\s+patrimonial)?)",
    "ITR": r"(itr|trimestral|trimestre|quarterly|[1-4]t)",
    "release": r"(release|resultados|earnings|press\s+release)",
    "relatorio_administracao": r"(relat[óo]rio\s+d[ea]\s+administra[çc][ãa]o|ra)",
}

# Explicit years and quarter marks a document may carry.
_PLAIN_YEAR = r"(202[1-5])"
_QUARTER_YEAR = r"[1-4]t(?:20)?(2[1-5])"
UNKNOWN_YEAR = "ano_desconhecido"


def contains_any(c: ColumnOrName, parts: list[str]) -> Column:
    """True when any literal part occurs; one alternation, matched in a single pass."""
    return as_column(c).rlike("|".join(rf"\Q{p}\E" for p in parts))


def split_lines(c: ColumnOrName) -> Column:
    """Lines of a text. Most texts know only the line feed and are split without a pattern."""
    text = as_column(c)
    other = F.lit(False)
    for mark in _OTHER_BREAKS:
        other = other | text.contains(mark)
    return F.split(F.when(other, F.regexp_replace(text, LINE_BREAK, "\n")).otherwise(text), "\n")


def mostly_punct(c: ColumnOrName) -> Column:
    """TXT-1: at least 60 % of the stripped characters are neither letters, digits nor blanks."""
    text = strip(c)
    marks = F.length(F.regexp_replace(text, r"[\p{L}\p{N}\p{Z}\s\x0B\x1C-\x1F\x{85}]", ""))
    return F.coalesce((F.length(text) > 0) & (marks >= 0.6 * F.length(text)), F.lit(False))


def strip_runs(c: ColumnOrName) -> Column:
    """TXT-2: a line without its trailing run of dots or dashes."""

    def cut(line: Column, mark: str) -> Column:
        at = F.instr(line, mark * 8)
        return F.when(at > 0, F.substring(line, F.lit(1), at - 1)).otherwise(line)

    # White space before a run goes with it: stripping once, after both cuts, is enough.
    return rstrip(cut(cut(as_column(c), "."), "-"))


def _only(marks: str) -> str:
    """Pattern of a line that is, once stripped, at least eight of these marks and blanks."""
    blank = "[" + "".join(rf"\x{{{ord(x):x}}}" for x in WHITE_SPACE) + "]*"
    return rf"^{blank}[{marks}][{marks} ]{{6,}}[{marks}]{blank}$"


_RULE, _TABLE_RULE = _only(r".\-_"), _only(r".\-_|:")
_TABLE_ROW = "^[" + "".join(rf"\x{{{ord(x):x}}}" for x in WHITE_SPACE) + r"]*\|"


def is_noise(c: ColumnOrName) -> Column:
    """TXT-3: a rule, a long run of punctuation, or dots in a row."""
    line = as_column(c)
    return line.contains("........") | line.rlike(_RULE) | ((F.length(line) > 200) & (F.length(strip(line)) > 200) & mostly_punct(line))


def is_markdown_noise(raw: ColumnOrName, kept: ColumnOrName, max_length: int = 1200) -> Column:
    """TXT-5: broken table rows and rule lines of generated Markdown."""
    raw, line = as_column(raw), as_column(kept)
    return (
        line.rlike(_TABLE_RULE)
        | (line.rlike(_TABLE_ROW) & raw.rlike(r"[-.]{20,}"))
        | ((F.length(raw) > max_length) & mostly_punct(raw))
    )


def is_financial_name(c: ColumnOrName) -> Column:
    """FLT-10: every name is accepted unless it names another kind of document."""
    return ~contains_any(F.lower(as_column(c)), NON_FINANCIAL_NAME_PARTS)


def financial_name_reason(c: ColumnOrName) -> Column:
    """FLT-10: which rule decided: ``denied``, ``named`` or ``default``."""
    low = F.lower(as_column(c))
    return (
        F.when(contains_any(low, NON_FINANCIAL_NAME_PARTS), "denied")
        .when(contains_any(low, FINANCIAL_NAME_PARTS), "named")
        .otherwise("default")
    )


def document_type(text: ColumnOrName, url: ColumnOrName) -> Column:
    """TXT-14: the first type whose pattern occurs in the link text or URL."""
    both = F.lower(F.concat_ws(" ", F.coalesce(as_column(text), F.lit("")), as_column(url)))
    kind = F.lit("outros")
    for name, pattern in reversed(DOCUMENT_TYPES.items()):
        kind = F.when(both.rlike(pattern), name).otherwise(kind)
    return kind


def document_year(text: ColumnOrName, url: ColumnOrName) -> Column:
    """TXT-14: an explicit recent year, else the year of a quarter mark, else unknown."""
    both = F.lower(F.concat_ws(" ", F.coalesce(as_column(text), F.lit("")), as_column(url)))
    plain = F.nullif(F.regexp_extract(both, _PLAIN_YEAR, 1), F.lit(""))
    quarter = F.nullif(F.regexp_extract(both, _QUARTER_YEAR, 1), F.lit(""))
    return F.coalesce(plain, F.concat(F.lit("20"), quarter), F.lit(UNKNOWN_YEAR))


def token_estimate(c: ColumnOrName) -> Column:
    """PRJ-27: one token per four characters, rounded down."""
    return F.floor(F.length(as_column(c)) / 4)
