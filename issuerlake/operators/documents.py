"""Page text, Markdown, links and extraction answers (TXT-4..18).

Pages are rows (document, page number, text); documents are rows with a text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuerlake.functions.cleaning import ColumnOrName, as_column, strip
from issuerlake.functions.naming import is_file_url, safe_name, slug_label, url_ext, url_host, url_path, url_root, url_slug, url_stem
from issuerlake.functions.text import (
    FINANCIAL_PAGE_PHRASES, contains_any, is_markdown_noise, is_noise, split_lines, strip_runs,
)
from issuerlake.operators.ordering import up
from issuerlake.operators.spread import spread
from issuerlake.operators.windows import dedupe

# Words that mark a sub-page worth visiting.
SUBPAGE_WORDS = [
    "demonstracoes", "demonstrações", "financeiras", "resultados", "itr", "dfp", "relatorio",
    "relatório", "administracao", "administração", "release", "earnings", "transparencia",
    "transparência", "publicacoes", "publicações", "documentos",
]

# Limits of page selection and chunking.
FINANCIAL_PAGES_PER_DOCUMENT = 30
FINANCIAL_PAGE_CHARS = 100
READABLE_PAGE_CHARS = 60
TEXT_PAGES_PER_CHUNK = 8
SCANNED_PAGES_PER_CHUNK = 15

# A number as it is printed.
NUMBER = r"(\d[\d.,]*\d|\d)"

# Texts written where the structured extractor gave nothing.
RAW_TEXT_NOTE = "> _Transcricao automatica (texto bruto; o extrator estruturado nao retornou markdown)._"
PLACEHOLDER_NOTE = (
    "> _Nao foi possivel extrair conteudo textual deste PDF (provavel PDF escaneado sem OCR ou falha do "
    "extrator). Reenvie com `force` para reprocessar._"
)


def page_marker(page_no: Column) -> Column:
    return F.concat(F.lit("\n\n--- PÁGINA "), page_no.cast("string"), F.lit(" ---\n"))


def _collapse(lines: Column) -> Column:
    """Lines joined, several blank lines in a row made one, outer blanks removed."""
    return strip(F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n"))


def sanitize_text(df: DataFrame, col: str = "text", removed: str = "removed_lines", key: str | None = None) -> DataFrame:
    """TXT-4: extracted text without noise lines, trailing runs and repeated blank lines. With ``key``, rows are spread by it first."""
    kept = spread(df, key).withColumn("_lines", F.transform(split_lines(col), strip_runs))
    clean = kept.withColumn("_clean", F.filter("_lines", lambda x: ~is_noise(x)))
    return (
        clean.withColumn(removed, F.size("_lines") - F.size("_clean"))
        .withColumn(col, _collapse(F.col("_clean")))
        .drop("_lines", "_clean")
    )


def sanitize_markdown(df: DataFrame, col: str = "markdown", removed: str = "removed_lines", key: str | None = None) -> DataFrame:
    """TXT-5: generated Markdown without broken tables, rule lines and repeated blank lines. With ``key``, rows are spread by it first."""
    kept = spread(df, key).withColumn(
        "_lines", F.transform(split_lines(col), lambda x: F.struct(x.alias("raw"), strip_runs(x).alias("kept")))
    )
    clean = F.filter("_lines", lambda x: ~is_markdown_noise(x["raw"], x["kept"]))
    return (
        kept.withColumn("_clean", F.transform(clean, lambda x: x["kept"]))
        .withColumn(removed, F.size("_lines") - F.size("_clean"))
        .withColumn(col, _collapse(F.col("_clean")))
        .drop("_lines", "_clean")
    )


def financial_pages(
    pages: DataFrame,
    phrases: Sequence[str] = FINANCIAL_PAGE_PHRASES,
    size: int = FINANCIAL_PAGES_PER_DOCUMENT,
    doc: str = "doc_id", page: str = "page_no", text: str = "text",
    min_chars: int = FINANCIAL_PAGE_CHARS,
) -> DataFrame:
    """TXT-6: per document, its pages with a statement phrase, joined under page markers in parts of ``size`` pages; the first part is 0."""
    found = pages.where((F.length(text) > min_chars) & contains_any(F.lower(F.col(text)), list(phrases)))
    place = F.row_number().over(Window.partitionBy(doc).orderBy(page)) - 1
    found = found.withColumn("part", F.floor(place / size).cast("int"))
    part = F.struct(F.col(page).alias("p"), F.concat(page_marker(F.col(page)), F.col(text)).alias("t"))
    ordered = F.array_sort(F.collect_list(part))
    return found.groupBy(doc, "part").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.array_join(F.transform(ordered, lambda x: x["t"]), "").alias(text),
    )


def readable(text: ColumnOrName, track: str = "qualitative") -> Column:
    """Whether a page has text: over 100 characters, or 60 once stripped on the qualitative track."""
    text = F.coalesce(as_column(text), F.lit(""))
    if track == "quantitative":
        return F.length(text) > FINANCIAL_PAGE_CHARS
    return F.length(strip(text)) >= READABLE_PAGE_CHARS


def scanned(pages: DataFrame, track: str = "qualitative", doc: str = "doc_id", text: str = "text") -> DataFrame:
    """TXT-7: documents with text on fewer than a tenth of their pages."""
    return pages.groupBy(doc).agg(
        F.count(F.lit(1)).alias("n_pages"), F.count_if(readable(text, track)).alias("n_readable")
    ).withColumn("is_scanned", F.col("n_readable") < F.col("n_pages") * 0.1)


def chunk_pages(
    pages: DataFrame, n: int = TEXT_PAGES_PER_CHUNK, doc: str = "doc_id", page: str = "page_no", text: str = "text"
) -> DataFrame:
    """TXT-8: readable pages in chunks of ``n``, sanitised, with the page range of each chunk.

    Pages are numbered from 1 and once each, so a chunk holds ``n`` pages at most
    and a long document spreads over many groups. Chunks without text are skipped.
    """
    totals = pages.groupBy(doc).agg(F.count(F.lit(1)).alias("total_pages"))
    body = strip(F.coalesce(F.col(text), F.lit("")))
    part = F.struct(F.col(page).alias("p"), F.concat(page_marker(F.col(page)), body).alias("t"))
    chunk = F.floor((F.col(page) - 1) / n).cast("long")
    chunks = (
        pages.where(readable(text)).groupBy(doc, chunk.alias("chunk_no"))
        .agg(F.array_sort(F.collect_list(part)).alias("_parts"), F.count(F.lit(1)).alias("n_readable"))
        .withColumn(text, strip(F.array_join(F.transform("_parts", lambda x: x["t"]), "")))
        .drop("_parts").join(totals, doc)
    )
    start = F.col("chunk_no") * n + 1
    end = F.least(F.col("chunk_no") * n + n, F.col("total_pages"))
    ranged = chunks.withColumn("first_page", start).withColumn("last_page", end).withColumn(
        "page_range",
        F.concat(F.lit("(Páginas "), start.cast("string"), F.lit(" a "), end.cast("string"), F.lit(" de "),
                 F.col("total_pages").cast("string"), F.lit(")")),
    )
    return sanitize_text(ranged, text)


def chunk_ranges(pages: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """TXT-8: the page ranges each document is sent in: by 8, or by 15 when it is scanned."""
    sized = scanned(pages, doc=doc, text=text).withColumn(
        "_size", F.when(F.col("is_scanned"), SCANNED_PAGES_PER_CHUNK).otherwise(TEXT_PAGES_PER_CHUNK)
    )
    starts = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_pages"), F.col("_size").cast("long")))
    return sized.withColumn("first_page", starts).select(
        doc, "is_scanned", "n_pages", "first_page",
        F.least(F.col("first_page") + F.col("_size") - 1, F.col("n_pages")).alias("last_page"),
    )


def number_tokens(text: ColumnOrName) -> Column:
    """TXT-9: every printed number of a text, in order."""
    return F.regexp_extract_all(F.coalesce(as_column(text), F.lit("")), F.lit(NUMBER), 1)


def number_fidelity(a: DataFrame, b: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """TXT-9: distinct numbers of two versions of each document: counts, differences, intersection."""
    a, b = spread(a.select(key, text), key), spread(b.select(key, text), key)  # the join needs this shuffle anyway
    left = a.select(key, F.array_distinct(number_tokens(text)).alias("_a"))
    right = b.select(key, F.array_distinct(number_tokens(text)).alias("_b"))
    return left.join(right, key).select(
        key,
        F.size("_a").alias("n_a"), F.size("_b").alias("n_b"),
        F.size(F.array_except("_a", "_b")).alias("only_a"),
        F.size(F.array_except("_b", "_a")).alias("only_b"),
        F.size(F.array_intersect("_a", "_b")).alias("common"),
    )


def assemble_markdown(
    df: DataFrame, key: str = "cnpj", position: str = "position", name: str = "nome_arquivo", markdown: str = "markdown",
    blocks_per_part: int = 100,
) -> DataFrame:
    """TXT-10: sanitised documents under their headings, joined in order into the body of each issuer.

    ``position`` numbers the documents of an issuer from 0. A body is delivered in
    parts of ``blocks_per_part`` positions, so an issuer with very many documents
    is not put together in one task; parts in order, joined by a line break, are
    the body.
    """
    blocks = sanitize_markdown(df.withColumn(markdown, strip(markdown)), markdown)
    block = F.concat(F.lit("# "), F.col(name), F.lit("\n\n"), F.col(markdown))
    part = F.floor(F.col(position) / blocks_per_part).cast("long").alias("part")
    # Empty documents drop out while they are collected: a filter would clean every text twice.
    filled = F.col(markdown) != ""
    ordered = F.array_sort(F.collect_list(F.when(filled, F.struct(F.col(position).alias("p"), block.alias("t")))))
    return blocks.groupBy(key, part).agg(
        F.count_if(filled).alias("n_documents"),
        F.array_join(F.transform(ordered, lambda x: x["t"]), "\n").alias("body"),
    ).where("n_documents > 0")


def _unquote(c: Column) -> Column:
    text = strip(c)
    inner = F.replace(
        F.replace(F.substring(text, F.lit(2), F.length(text) - 2), F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\")
    )
    return F.when((F.length(text) >= 2) & text.startswith('"') & text.endswith('"'), inner).otherwise(text)


def _quote(c: Column) -> Column:
    escaped = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def parse_manifest(df: DataFrame, col: str = "markdown") -> DataFrame:
    """TXT-11: ``files`` (name, hash) and ``body`` of a Markdown text with front matter.

    Text without a complete manifest is all body. Entries without a hash are dropped.
    """
    text = F.coalesce(F.col(col), F.lit(""))
    front = F.regexp_extract(text, r"^---\n((?s:.*?))\n---\n", 1)
    has = text.startswith("---\n") & front.rlike(r"^[ \t]*arquivos_processados:[ \t]*(\n|$)")
    entry = r"(?m)(?=^[ \t]*-[ \t]+nome_arquivo:[ \t])"
    entries = F.filter(F.split("_front", entry), lambda e: e.rlike(r"^[ \t]*-[ \t]+nome_arquivo:[ \t]"))
    files = F.transform(
        entries,
        lambda e: F.struct(
            _unquote(F.regexp_extract(e, r"^[ \t]*-[ \t]+nome_arquivo:([^\n]*)", 1)).alias("nome_arquivo"),
            _unquote(F.regexp_extract(e, r"(?s)^.*\n[ \t]+hash_md5:[ \t]+([^\n]*)", 1)).alias("hash_md5"),
        ),
    )
    body = F.ltrim(F.regexp_replace(text, r"^---\n(?s:.*?)\n---\n", ""), F.lit("\n"))
    return (
        df.withColumn("_front", F.when(has, front).otherwise(""))
        .withColumn("files", F.filter(files, lambda f: f["hash_md5"] != ""))
        .withColumn("body", F.when(has, body).otherwise(text))
        .drop("_front")
    )


def render_manifest(df: DataFrame, files: str = "files", body: str = "body", col: str = "markdown") -> DataFrame:
    """TXT-11: the front matter of a file list put before its body."""
    lines = F.transform(
        files,
        lambda f: F.concat(
            F.lit("  - nome_arquivo: "), _quote(f["nome_arquivo"]), F.lit("\n    hash_md5: "), _quote(f["hash_md5"]), F.lit("\n")
        ),
    )
    return df.withColumn(
        col,
        F.concat(F.lit("---\narquivos_processados:\n"), F.array_join(lines, ""), F.lit("---\n"), F.ltrim(F.col(body), F.lit("\n"))),
    )


def best_extraction(
    df: DataFrame, first: str = "structured", second: str = "retried", raw: str = "raw_text", name: str = "nome_arquivo"
) -> DataFrame:
    """TXT-12: the best text of each document and how it was obtained.

    Structured text, a second attempt at it, raw text under a note, a placeholder.
    """
    structured = F.coalesce(F.nullif(strip(first), F.lit("")), F.nullif(strip(second), F.lit("")))
    plain = F.nullif(strip(raw), F.lit(""))
    heading = F.concat(F.lit("# "), F.col(name), F.lit("\n\n"))
    return df.withColumn(
        "extraction_mode", F.when(structured.isNotNull(), "llm").when(plain.isNotNull(), "texto_bruto").otherwise("placeholder")
    ).withColumn(
        "markdown",
        F.coalesce(
            structured,
            F.concat(heading, F.lit(RAW_TEXT_NOTE + "\n\n"), plain),
            F.concat(heading, F.lit(PLACEHOLDER_NOTE)),
        ),
    )


ENTRY = T.StructType([
    T.StructField("cd_conta", T.StringType()), T.StructField("ds_conta", T.StringType()), T.StructField("valor", T.DoubleType()),
])
PERIOD = T.StructType([
    T.StructField("tipo", T.StringType()),
    T.StructField("demonstracoes", T.MapType(T.StringType(), T.MapType(T.StringType(), ENTRY))),
])
ANSWER = T.StructType([T.StructField("periodos", T.MapType(T.StringType(), PERIOD))])


def normalize_answers(df: DataFrame, col: str = "answer") -> DataFrame:
    """TXT-13: ``periodos`` of an answer given as object, or as list whose first item is one.

    Anything else is marked ``rejected``.
    """
    listed = strip(col).startswith("[")
    single = F.from_json(F.when(~listed, F.col(col)), ANSWER)["periodos"]
    many = F.get(F.from_json(F.when(listed, F.col(col)), T.ArrayType(ANSWER)), 0)["periodos"]
    return df.withColumn("periodos", F.coalesce(single, many)).withColumn("rejected", F.col("periodos").isNull())


def absolute_url(base: ColumnOrName, href: ColumnOrName) -> Column:
    """A link joined to the page it stands on."""
    base, href = as_column(base), as_column(href)
    folder = F.concat(url_root(base), F.coalesce(F.nullif(F.regexp_extract(url_path(base), r"^(.*/)", 1), F.lit("")), F.lit("/")))
    joined = (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1), href))
        .when(href.startswith("/"), F.concat(url_root(base), href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .when(href.startswith("?"), F.concat(url_root(base), url_path(base), href))
        .otherwise(F.concat(folder, href))
    )
    return _without_dots(joined)


def _without_dots(url: Column) -> Column:
    """A URL with the segments "." and ".." of its path resolved; ".." at the root goes nowhere."""
    root, path = url_root(url), F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)", 1)
    rest = F.regexp_extract(url, r"^[^?#]*(.*)$", 1)
    segments = F.split(F.regexp_replace(path, r"/\.{1,2}$", "$0/"), "/")
    empty = F.array().cast("array<string>")

    def step(kept: Column, x: Column) -> Column:
        up = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(x == "..", up).when(x == ".", kept).otherwise(F.concat(kept, F.array(x)))

    resolved = F.concat(root, F.array_join(F.aggregate(segments, empty, step), "/"), rest)
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), resolved).otherwise(url)


_ANCHOR = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']+)["'][^>]*>(.*?)</a>"""
_HREF = r"""href=["']([^"']+)["']"""
_PLAIN_HREF = r"""href=["']([^"'#?]+)["']"""


def page_links(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Anchors of each page in order: href, absolute URL and text without tags."""
    pattern = F.lit(_ANCHOR)
    anchors = F.arrays_zip(
        F.regexp_extract_all(html, pattern, 1).alias("href"), F.regexp_extract_all(html, pattern, 2).alias("text")
    )
    links = pages.select(page, F.col(url).alias("page_url"), F.posexplode(anchors).alias("pos", "_a"))
    return links.select(
        page, "page_url", "pos", F.col("_a.href").alias("href"),
        absolute_url("page_url", F.col("_a.href")).alias("url"),
        strip(F.regexp_replace(F.regexp_replace(F.col("_a.text"), r"<[^>]*>", ""), r"\s+", " ")).alias("text"),
    )


def extract_file_links(
    pages: DataFrame, keys: Sequence[str] = ("page_id",), page: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """TXT-15: file links of each page, once per URL, titled by their text or file name."""
    links = page_links(pages, page, url, html).where(is_file_url("url"))
    first = dedupe(links, [*keys, "url"], [page, "pos"])
    return first.select(
        page, "url",
        F.when(F.col("text") != "", safe_name("text")).otherwise(url_stem("url")).alias("title"),
        F.lit(None).cast("int").alias("year"),
        url_ext("url").alias("ext"),
    )


def static_file_links(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """TXT-15: file links from every ``href`` of the raw HTML, titled by file name."""
    links = pages.select(
        page, F.col(url).alias("page_url"), F.posexplode(F.regexp_extract_all(html, F.lit(_HREF), 1)).alias("pos", "href")
    ).withColumn("url", absolute_url("page_url", "href")).where(is_file_url("url"))
    return dedupe(links, [page, "url"], ["pos"]).select(
        page, "url", safe_name(url_stem("url")).alias("title"), F.lit(None).cast("int").alias("year"), url_ext("url").alias("ext")
    )


def sibling_links(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """TXT-16: the page itself and the pages one level below its parent path on the same host, once each."""
    own = url_path(url)
    trimmed = F.regexp_replace(own, r"/+$", "")
    parent = F.concat(F.coalesce(F.regexp_extract(trimmed, r"^(.*)/[^/]*$", 1), F.lit("")), F.lit("/"))
    based = pages.select(
        page, F.col(url).alias("page_url"), url_root(url).alias("_root"), url_host(url).alias("_host"),
        F.regexp_replace(parent, "/+", "/").alias("_parent"), html,
    )
    links = based.select(
        page, "page_url", "_root", "_host", "_parent",
        F.posexplode(F.regexp_extract_all(html, F.lit(_PLAIN_HREF), 1)).alias("pos", "_href"),
    ).withColumn(
        "_full", F.when(F.col("_href").startswith("/"), F.concat("_root", "_href")).when(F.col("_href").startswith("http"), F.col("_href"))
    )
    path = F.concat(F.regexp_replace(url_path("_full"), r"/+$", ""), F.lit("/"))
    children = links.where(url_host("_full") == F.col("_host")).withColumn("_path", path).where(
        F.startswith("_path", "_parent")
    ).withColumn(
        "slug", strip(F.substring("_path", F.length("_parent") + 1, F.length("_path")), "/")
    ).where((F.col("slug") != "") & ~F.col("slug").contains("/")).select(
        page, "page_url", (F.col("pos") + 1).alias("pos"), "slug", F.concat("_root", "_path").alias("url")
    )
    itself = pages.select(
        page, F.col(url).alias("page_url"), F.lit(0).alias("pos"),
        F.coalesce(F.nullif(F.regexp_extract(own, r"([^/]+)/*$", 1), F.lit("")), F.lit("principal")).alias("slug"),
        F.col(url).alias("url"),
    )
    unique = dedupe(itself.unionByName(children), [page, "url"], ["pos"])
    return unique.select(page, "pos", "slug", slug_label("slug").alias("label"), "url")


def candidate_links(
    pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", words: Sequence[str] = SUBPAGE_WORDS,
) -> DataFrame:
    """TXT-17: the page and its sub-pages that name documents, on the same domain; ``pos`` orders them, -1 being the page itself."""
    links = page_links(pages, page, url, html)
    low = F.lower(F.col("href"))
    is_download = low.endswith(".pdf") | low.contains("download")
    named = contains_any(low, list(words)) | contains_any(F.lower(F.col("text")), list(words))
    domain = F.replace(url_host("page_url"), F.lit("www."), F.lit(""))
    found = links.where(~is_download & named & F.endswith(url_host("url"), domain))
    itself = pages.select(page, F.col(url).alias("url"), F.lit(-1).alias("pos"))
    return dedupe(itself.unionByName(found.select(page, "url", "pos")), [page, "url"], ["pos"])


def _versions(*fields: str) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in fields]))


LINK_DOCUMENT = T.StructType(
    [T.StructField(f, T.StringType()) for f in (
        "year", "date", "publishDate", "id", "fileId", "uuid", "path", "url", "fileUrl", "file_url", "link",
        "title", "name", "filename",
    )]
    + [T.StructField(f, _versions("path", "url", "fileUrl")) for f in ("versions", "files")]
)


def normalize_link_docs(
    docs: DataFrame, base: ColumnOrName, col: str = "doc", tab: str = "tab", low: int | None = None, high: int | None = None
) -> DataFrame:
    """TXT-18: platform documents (JSON) as standard link rows.

    The first filled field gives the URL, then the first filled version, then the
    id. The year comes from its own field or the start of a date; unknown years stay.
    ``base`` is put before relative URLs.
    """
    # Generated, so that the filters below do not parse the document once per field they look at.
    d = docs.select("*", F.explode(F.array(F.from_json(col, LINK_DOCUMENT))).alias("_d"))

    def filled(c: Column) -> Column:
        return F.when(strip(c) != "", c)

    def first(prefix: str, *fields: str) -> Column:
        return F.coalesce(*[filled(F.col(f"{prefix}.{f}")) for f in fields])

    versions = F.coalesce(F.when(F.size("_d.versions") > 0, F.col("_d.versions")), F.col("_d.files"))
    paths = F.filter(
        F.transform(versions, lambda v: F.coalesce(filled(v["path"]), filled(v["url"]), filled(v["fileUrl"]))),
        lambda p: p.isNotNull(),
    )
    fid = first("_d", "id", "fileId", "uuid")
    found = F.coalesce(first("_d", "path", "url", "fileUrl", "file_url", "link"), F.get(paths, 0))
    root = F.concat(as_column(base), F.lit("/"))
    link = F.coalesce(
        F.when(found.startswith("http"), found).when(found.isNotNull(), F.concat(root, found)),
        F.concat(root, fid, F.lit("?origin=2")),
    )
    date = F.substring(F.coalesce(filled(F.col("_d.date")), filled(F.col("_d.publishDate"))), 1, 4)
    year = F.coalesce(F.col("_d.year").try_cast("int"), F.when(date.rlike("^[0-9]{4}$"), date.try_cast("int")))
    title = strip(first("_d", "title", "name", "filename"))
    rows = d.select(
        *[c for c in docs.columns if c not in (col, tab)],
        link.alias("url"),
        F.when(title != "", safe_name(title)).otherwise(F.coalesce(fid, F.lit("arquivo"))).alias("title"),
        F.col(tab).alias("tab"), year.alias("year"),
    ).where(F.col("url").isNotNull())
    if low is not None:
        rows = rows.where(F.col("year").isNull() | (F.col("year") >= low))
    if high is not None:
        rows = rows.where(F.col("year").isNull() | (F.col("year") <= high))
    return rows.withColumn("ext", F.coalesce(F.nullif(url_ext("url"), F.lit("")), F.lit(".pdf")))
