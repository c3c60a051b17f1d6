"""File names, URL parts and document titles (PRJ-22..25, FLT-11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from issuerlake.functions.cleaning import ColumnOrName, as_column, strip

# Extensions and host markers of downloadable files.
FILE_EXTENSIONS = [".pdf", ".xlsx", ".xls", ".docx", ".doc", ".pptx", ".zip", ".csv"]
FILE_HOST_MARKERS = ["mzfilemanager", "filemanager-cdn"]

# A slug prefix that names the section, not the page.
SECTION_PREFIXES = ["central-de-resultados-", "central-de-resultados"]

_URL_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
_URL_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_URL_ROOT = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
_LAST_SEGMENT = r"([^/]+)/*$"


def safe_name(c: ColumnOrName, mode: str = "label") -> Column:
    """PRJ-22: ``label`` keeps words apart (100 characters), ``file`` uses underscores (120)."""
    c = as_column(c)
    if mode == "file":
        return F.substring(F.regexp_replace(c, r"[^A-Za-z0-9_.\-]", "_"), 1, 120)
    if mode != "label":
        raise ValueError(f"unknown name mode: {mode}")
    text = F.regexp_replace(c, r"<[^>]+>", "")
    text = F.regexp_replace(text, r'[<>:"/\\|?*\x00-\x1f]', " ")
    text = F.substring(strip(F.regexp_replace(text, r"\s+", " ")), 1, 100)
    return F.when(text == "", "arquivo").otherwise(text)


def url_path(c: ColumnOrName) -> Column:
    return F.regexp_extract(as_column(c), _URL_PATH, 1)


def url_host(c: ColumnOrName) -> Column:
    return F.regexp_extract(as_column(c), _URL_HOST, 1)


def url_root(c: ColumnOrName) -> Column:
    return F.regexp_extract(as_column(c), _URL_ROOT, 1)


def url_file(c: ColumnOrName) -> Column:
    return F.regexp_extract(url_path(c), _LAST_SEGMENT, 1)


def url_slug(c: ColumnOrName) -> Column:
    """PRJ-23: last path segment, else the first host label without ri./www."""
    segment = url_file(c)
    host = F.regexp_extract(F.regexp_replace(url_host(c), r"^(ri\.|www\.)", ""), r"^([^.]*)", 1)
    return F.when(segment != "", segment).when(host != "", host).otherwise("principal")


def title_case(c: ColumnOrName) -> Column:
    """Every run of letters starts with a capital, digits do not count as letters."""
    runs = F.regexp_extract_all(as_column(c), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def slug_label(c: ColumnOrName) -> Column:
    """PRJ-23: slug without its section prefix, as a title."""
    slug = as_column(c)
    for prefix in SECTION_PREFIXES:
        rest = strip(F.substring(slug, len(prefix) + 1, 2_000_000), "-")
        slug = F.when(slug.startswith(prefix) & (rest != ""), rest).otherwise(slug)
    return safe_name(title_case(F.replace(slug, F.lit("-"), F.lit(" "))))


def url_ext(c: ColumnOrName) -> Column:
    """PRJ-23: lower-case extension with its dot, '' when there is none."""
    return F.lower(F.regexp_extract(url_file(c), r"[^.].*?(\.[^.]+)$", 1))


def url_stem(c: ColumnOrName) -> Column:
    return F.regexp_replace(url_file(c), r"(?<=.)\.[^.]+$", "")


def year_from(c: ColumnOrName) -> Column:
    """PRJ-23: the first year of this century in a text."""
    return F.regexp_extract(as_column(c), r"(20\d{2})", 1).try_cast("int")


def doc_name(kind: ColumnOrName, year: ColumnOrName, text: ColumnOrName, url: ColumnOrName) -> Column:
    """PRJ-24: the same document always gets the same file name."""
    shown = F.coalesce(F.nullif(safe_name(text, "file"), F.lit("")), F.lit("pdf"))
    tail = F.substring(F.md5(as_column(url)), 1, 8)
    return F.concat(F.concat_ws("_", as_column(kind), as_column(year).cast("string"), shown, tail), F.lit(".pdf"))


def file_stem(c: ColumnOrName) -> Column:
    name = F.regexp_extract(as_column(c), _LAST_SEGMENT, 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")


def clean_title(raw: ColumnOrName, file_name: ColumnOrName) -> Column:
    """PRJ-25: first line without quotes or heading marks, 80 characters, else the file stem."""
    line = F.regexp_extract(strip(F.coalesce(as_column(raw), F.lit(""))), r"^([^\n\r]*)", 1)
    title = strip(strip(strip(strip(strip(line), '"'), "'"), "#"))
    title = F.substring(strip(F.regexp_replace(title, r"\s+", " ")), 1, 80)
    return F.coalesce(
        F.nullif(title, F.lit("")),
        F.nullif(file_stem(file_name), F.lit("")),
        F.nullif(as_column(file_name), F.lit("")),
        F.lit("Documento"),
    )


def is_file_url(c: ColumnOrName) -> Column:
    """FLT-11: a known file host, or a path that ends in a known extension."""
    low = F.lower(as_column(c))
    marked = F.lit(False)
    for marker in FILE_HOST_MARKERS:
        marked = marked | low.contains(marker)
    return marked | url_ext(c).isin(FILE_EXTENSIONS)
