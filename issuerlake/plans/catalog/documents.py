"""Text and document operators (TXT-*, SRC-13, SRC-14) over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from issuerlake.functions import text as S
from issuerlake.operators import documents as X
from issuerlake.plans.catalog.base import query
from issuerlake.sources import files as SRC

LINES = r"'\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]'"
_WS = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"


def strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def rstrip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '{_WS}+$', '')"


def runs_sql(x: str) -> str:
    once = rstrip_sql(rf"regexp_replace({x}, '\.{{8,}}.*$', '')")
    return rstrip_sql(rf"regexp_replace({once}, '-{{8,}}.*$', '')")


def punct_sql(x: str) -> str:
    y = strip_sql(x)
    return (
        rf"(length({y}) > 0 and length(regexp_replace({y}, '[\p{{L}}\p{{N}}\p{{Z}}\s\x0B\x1C-\x1F\x{{85}}]', '', 'g')) >= 0.6 * length({y}))"
    )


def noise_sql(x: str) -> str:
    y = strip_sql(x)
    return rf"(regexp_full_match({y}, '[.\-_ ]{{8,}}') or (length({y}) > 200 and {punct_sql(x)}) or contains({y}, '........'))"


def sanitize_sql(x: str) -> tuple[str, str]:
    """(clean text, number of removed lines) of a text expression."""
    lines = f"list_transform(regexp_split_to_array({x}, {LINES}), lambda l: {runs_sql('l')})"
    clean = strip_sql(rf"regexp_replace(array_to_string(list_filter({lines}, lambda l: not {noise_sql('l')}), chr(10)), '\n{{3,}}', e'\n\n', 'g')")
    return clean, f"cast(len(list_filter({lines}, lambda l: {noise_sql('l')})) as integer)"


# Document texts with the noise of extracted PDF text put between their lines.
_NOISY_SQL = r"concat(replace(text, chr(10), e'\n \n\n----------\n'), e'\nReceita ............ 12\n', text, e'\nAtivo Total --------- x\n\n\n\n', repeat('%&!*', 60), e'\n_ _ _ _ _\nTotal: 12,5')"


def _noisy(t):
    text = F.concat(
        F.replace("text", F.lit("\n"), F.lit("\n \n\n----------\n")), F.lit("\nReceita ............ 12\n"), F.col("text"),
        F.lit("\nAtivo Total --------- x\n\n\n\n"), F.lit("%&!*" * 60), F.lit("\n_ _ _ _ _\nTotal: 12,5"),
    )
    return t.documents.select("doc_id", text.alias("text"))


_CLEAN, _REMOVED = sanitize_sql("text")


@query("sanitized_texts", f"""
with n as (select doc_id, {_NOISY_SQL} as text from documents) select doc_id, md5({_CLEAN}) as clean, {_REMOVED} as removed_lines from n
""")
def _(t):
    return X.sanitize_text(_noisy(t), key="doc_id").select("doc_id", F.md5("text").alias("clean"), "removed_lines")


def _markdown_sql(x: str) -> tuple[str, str]:
    lines = f"regexp_split_to_array({x}, {LINES})"
    kept = strip_sql(runs_sql("l"))
    bad = rf"((length(l) > 1200 and {punct_sql('l')}) or (starts_with({kept}, '|') and regexp_matches(l, '[-.]{{20,}}')) or regexp_full_match({kept}, '[.\-_|: ]{{8,}}'))"
    good = f"list_transform(list_filter({lines}, lambda l: not {bad}), lambda l: {runs_sql('l')})"
    clean = strip_sql(rf"regexp_replace(array_to_string({good}, chr(10)), '\n{{3,}}', e'\n\n', 'g')")
    return clean, f"cast(len(list_filter({lines}, lambda l: {bad})) as integer)"


_MD_SQL = r"concat(replace(text, chr(10), e'\n\n\n|---|:---|----|\n'), e'\n| x | -------------------- |\n', repeat('|*.', 500), e'\n', text, e'\n|a|b|')"
_MD_CLEAN, _MD_REMOVED = _markdown_sql("text")


def _markdown(t):
    text = F.concat(
        F.replace("text", F.lit("\n"), F.lit("\n\n\n|---|:---|----|\n")), F.lit("\n| x | -------------------- |\n"), F.lit("|*." * 500),
        F.lit("\n"), F.col("text"), F.lit("\n|a|b|"),
    )
    return t.documents.select("doc_id", text.alias("markdown"))


@query("sanitized_markdown", f"""
with n as (select doc_id, {_MD_SQL} as text from documents) select doc_id, md5({_MD_CLEAN}) as clean, {_MD_REMOVED} as removed_lines from n
""")
def _(t):
    return X.sanitize_markdown(_markdown(t), key="doc_id").select("doc_id", F.md5("markdown").alias("clean"), "removed_lines")


@query("line_noise", f"""
with n as (select unnest(regexp_split_to_array({_NOISY_SQL}, {LINES})) as l from documents)
select {punct_sql('l')} as punctuation, {noise_sql('l')} as noise, l <> {runs_sql('l')} as has_run, count(*) as n from n group by 1, 2, 3
""")
def _(t):
    lines = _noisy(t).select(F.explode(S.split_lines("text")).alias("line"))
    return lines.groupBy(
        S.mostly_punct("line").alias("punctuation"), S.is_noise("line").alias("noise"), (F.col("line") != S.strip_runs("line")).alias("has_run")
    ).agg(F.count("*").alias("n"))


def pages(t):
    """Conversation turns as the pages of a document."""
    return t.conversations.select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).alias("page_no"), "text")


_PAGES_SQL = "(select conv_id as doc_id, turn + 1 as page_no, text from conversations)"
_MARK = "concat(e'\\n\\n--- PÁGINA ', page_no, e' ---\\n', {})"


@query("financial_pages", f"""
select doc_id, cast((rn - 1) // 2 as integer) as part, count(*) as n_pages, md5(string_agg({_MARK.format('text')}, '' order by page_no)) as text from (
  select *, row_number() over (partition by doc_id order by page_no) as rn from {_PAGES_SQL}
  where length(text) > 100 and (contains(lower(text), 'que') or contains(lower(text), 'the ') or contains(lower(text), 'der'))) group by 1, 2
""")
def _(t):
    rows = X.financial_pages(pages(t), phrases=["que", "the ", "der"], size=2)
    return rows.withColumn("text", F.md5("text"))


@query("scanned_documents", f"""
select doc_id, count(*) as n_pages, count(*) filter (where length({strip_sql('text')}) >= 60) as n_readable,
  count(*) filter (where length({strip_sql('text')}) >= 60) < count(*) * 0.1 as is_scanned from {_PAGES_SQL} group by 1
""")
def _(t):
    return X.scanned(pages(t))


@query("scanned_documents_quantitative", f"""
select doc_id, count(*) as n_pages, count(*) filter (where length(text) > 100) as n_readable,
  count(*) filter (where length(text) > 100) < count(*) * 0.1 as is_scanned from {_PAGES_SQL} group by 1
""")
def _(t):
    return X.scanned(pages(t), track="quantitative")


_CHUNK_CLEAN, _CHUNK_REMOVED = sanitize_sql("raw")


@query("page_chunks", f"""
with p as (select doc_id, page_no, {strip_sql('text')} as text, count(*) over (partition by doc_id) as total from {_PAGES_SQL}),
c as (select doc_id, (page_no - 1) // 3 as chunk_no, count(*) as n_readable, max(total) as total_pages, {strip_sql(f"string_agg({_MARK.format('text')}, '' order by page_no)")} as raw
  from p where length(text) >= 60 group by 1, 2)
select doc_id, chunk_no, n_readable, concat('(Páginas ', chunk_no * 3 + 1, ' a ', least(chunk_no * 3 + 3, total_pages), ' de ', total_pages, ')') as page_range,
  md5({_CHUNK_CLEAN}) as text, {_CHUNK_REMOVED} as removed_lines from c
""")
def _(t):
    rows = X.chunk_pages(pages(t), 3)
    return rows.select("doc_id", "chunk_no", "n_readable", "page_range", F.md5("text").alias("text"), "removed_lines")


@query("chunk_ranges", f"""
with s as (select doc_id, count(*) as n, case when count(*) filter (where length({strip_sql('text')}) >= 60) < count(*) * 0.1 then 15 else 8 end as size from {_PAGES_SQL} group by 1)
select doc_id, size = 15 as is_scanned, n as n_pages, a as first_page, least(a + size - 1, n) as last_page from s, lateral (select unnest(range(1, n + 1, size)) as a)
""")
def _(t):
    return X.chunk_ranges(pages(t))


_NUMBERS = r"list_distinct(regexp_extract_all({}, '\d[\d.,]*\d|\d'))"
_NUMBERED_SQL = "concat(text, ' ', n_chars, ' ', doc_id, ',5')"


@query("number_fidelity", f"""
with v as (select doc_id, {_NUMBERS.format(_NUMBERED_SQL)} as a, {_NUMBERS.format("concat(text, ' ', n_chars + 1, ' 12.5')")} as b from documents)
select doc_id, cast(len(a) as integer) as n_a, cast(len(b) as integer) as n_b, cast(len(list_filter(a, lambda x: not list_contains(b, x))) as integer) as only_a,
  cast(len(list_filter(b, lambda x: not list_contains(a, x))) as integer) as only_b, cast(len(list_filter(a, lambda x: list_contains(b, x))) as integer) as common from v
""")
def _(t):
    a = t.documents.select("doc_id", F.concat("text", F.lit(" "), "n_chars", F.lit(" "), "doc_id", F.lit(",5")).alias("text"))
    b = t.documents.select("doc_id", F.concat("text", F.lit(" "), F.col("n_chars") + 1, F.lit(" 12.5")).alias("text"))
    return X.number_fidelity(a, b)


_BODY_CLEAN, _ = _markdown_sql(strip_sql("text"))


@query("assembled_markdown", f"""
with b as (select source, doc_id, concat('# ', source, '-', doc_id, e'\\n\\n', c) as block from (select *, {_BODY_CLEAN} as c from documents) where c <> '')
select source, doc_id // 400 as part, count(*) as n_documents, md5(string_agg(block, chr(10) order by doc_id)) as body from b group by 1, 2
""")
def _(t):
    rows = t.documents.select("source", "doc_id", F.concat_ws("-", "source", "doc_id").alias("name"), F.col("text").alias("markdown"))
    return X.assemble_markdown(rows, "source", "doc_id", "name", "markdown", 400).withColumn("body", F.md5("body"))


def _with_files(t):
    entry = lambda name, digest: F.struct(name.alias("nome_arquivo"), digest.alias("hash_md5"))
    first = entry(F.concat("source", F.lit(' "v"\\'), "doc_id"), F.md5("text"))
    second = entry(F.concat("lang", F.lit(".pdf")), F.when(F.col("lang") == "en", "").otherwise(F.md5("lang")))
    return t.documents.select("doc_id", F.array(first, second).alias("files"), F.col("text").alias("body"))


@query("manifests", """
select doc_id, concat(source, ' "v"\\', doc_id, '=', md5(text), case when lang = 'en' then '' else concat('|', lang, '.pdf=', md5(lang)) end) as files,
  md5(ltrim(text, chr(10))) as body from documents
""")
def _(t):
    written = X.render_manifest(_with_files(t)).select("doc_id", "markdown")
    shown = F.transform("files", lambda f: F.concat_ws("=", f["nome_arquivo"], f["hash_md5"]))
    return X.parse_manifest(written).select("doc_id", F.array_join(shown, "|").alias("files"), F.md5("body").alias("body"))


@query("best_extractions", f"""
with m as (select doc_id, lang, {strip_sql('text')} as s from documents) select doc_id,
  case lang when 'en' then 'llm' when 'fr' then 'llm' when 'de' then 'texto_bruto' else 'placeholder' end as extraction_mode,
  md5(case when lang in ('en', 'fr') then s when lang = 'de' then concat('# ', doc_id, e'\\n\\n', '{X.RAW_TEXT_NOTE}', e'\\n\\n', s)
    else concat('# ', doc_id, e'\\n\\n', '{X.PLACEHOLDER_NOTE}') end) as markdown from m
""")
def _(t):
    lang = F.col("lang")
    rows = t.documents.select(
        "doc_id", F.when(lang == "en", F.col("text")).alias("structured"), F.when(lang == "fr", F.col("text")).otherwise(" ").alias("retried"),
        F.when(lang == "de", F.col("text")).otherwise("").alias("raw_text"), F.col("doc_id").cast("string").alias("nome_arquivo"),
    )
    return X.best_extraction(rows).select("doc_id", "extraction_mode", F.md5("markdown").alias("markdown"))


@query("normalized_answers", """
select event_id, event_type in ('purchase', 'error') as rejected, case when event_type in ('click', 'view') then 1 when event_type = 'signup' then 0 end as n_periods,
  case when event_type in ('click', 'view') then value end as valor from events
""")
def _(t):
    kind = F.col("event_type")
    body = F.concat(
        F.lit('{"periodos": {"2024-12-31": {"tipo": "DFP", "demonstracoes": {"BPA": {"1": {"cd_conta": "1", "ds_conta": "Ativo", "valor": '),
        F.col("value").cast("string"), F.lit("}}}}}}"),
    )
    answer = (
        F.when(kind == "click", body).when(kind == "view", F.concat(F.lit(" ["), body, F.lit("]")))
        .when(kind == "signup", '{"periodos": {}}').when(kind == "purchase", '[{"x": 1}]').otherwise('{"periodos": [')
    )
    rows = X.normalize_answers(t.events.select("event_id", answer.alias("answer")))
    value = F.try_element_at(F.try_element_at(F.try_element_at("periodos", F.lit("2024-12-31"))["demonstracoes"], F.lit("BPA")), F.lit("1"))
    return rows.select(
        "event_id", "rejected", F.when(~F.col("rejected"), F.size("periodos")).alias("n_periods"), value["valor"].alias("valor")
    )


@query("classified_documents", """
select case event_type when 'click' then 'DFP' when 'view' then 'ITR' when 'purchase' then 'release' when 'signup' then 'relatorio_administracao' else 'outros' end as kind,
  case when event_type = 'view' then '2024' when user_id < 5 then cast(2021 + user_id as varchar) else 'ano_desconhecido' end as doc_year, count(*) as n from events group by 1, 2
""")
def _(t):
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", "Demonstrações  Financeiras").when(kind == "view", "Informe 3T24").when(kind == "purchase", "Press Release")
        .when(kind == "signup", "Relatório da Administração").otherwise("documento")
    )
    year = F.when((kind != "view") & (F.col("user_id") < 5), (F.col("user_id") + 2021).cast("string")).otherwise("x")
    links = t.events.select(text.alias("text"), F.concat(F.lit("/d/"), year).alias("url"))
    return links.groupBy(S.document_type("text", "url").alias("kind"), S.document_year("text", "url").alias("doc_year")).agg(F.count("*").alias("n"))


# Every href of a page once more as a file: the pages link to no files themselves.
_HREFS_SQL = r"""select page_id, url, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) as href, generate_subscripts(regexp_extract_all(html, 'href="([^"]+)"', 1), 1) as pos from pages"""
_ROOT_SQL = r"regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1)"


def _pages_with_files(t):
    html = F.regexp_replace("html", r'href="(/[^"]+)"', 'href="$1.pdf"')
    return t.pages.select("page_id", "url", html.alias("html"))


@query("file_links", f"""
select page_id, concat({_ROOT_SQL}, href, '.pdf') as link, substr(href, 2) as title, '.pdf' as ext from ({_HREFS_SQL}) group by all
""")
def _(t):
    return X.extract_file_links(_pages_with_files(t)).select("page_id", F.col("url").alias("link"), "title", "ext")


@query("static_file_links", f"""
select page_id, concat({_ROOT_SQL}, href, '.pdf') as link, substr(href, 2) as title from ({_HREFS_SQL}) group by all
""")
def _(t):
    return X.static_file_links(_pages_with_files(t)).select("page_id", F.col("url").alias("link"), "title")


_PARENT = r"regexp_extract(regexp_replace(regexp_extract(url, '^(?:[A-Za-z]+:)?//[^/?#]*([^?#]*)', 1), '/+$', ''), '^(.*)/[^/]*$', 1)"


@query("sibling_links", f"""
with c as (select page_id, {_ROOT_SQL} as root, substr(href, 2) as slug from ({_HREFS_SQL}) where href not like '%#%' and href not like '%?%')
select page_id, root || '/' || slug || '/' as link, slug from c group by all
union all select page_id, url, regexp_extract(regexp_extract(url, '^(?:[A-Za-z]+:)?//[^/?#]*([^?#]*)', 1), '([^/]+)/*$', 1) from pages
""")
def _(t):
    flat = t.pages.select("page_id", "url", "html", F.concat(X.url_root("url"), F.lit("/inicio")).alias("start"))
    rows = X.sibling_links(flat.select("page_id", F.col("start").alias("url"), "html"))
    own = t.pages.select("page_id", "url")
    named = rows.join(own.withColumnRenamed("url", "own"), "page_id")
    slug = F.regexp_extract(X.url_path("own"), r"([^/]+)/*$", 1)
    return named.select(
        "page_id", F.when(F.col("pos") == 0, F.col("own")).otherwise(F.col("url")).alias("link"),
        F.when(F.col("pos") == 0, slug).otherwise(F.col("slug")).alias("slug"),
    )


@query("candidate_links", f"""
with l as (select page_id, pos - 1 as pos, concat({_ROOT_SQL}, href) as link from ({_HREFS_SQL}) where contains(lower(href), 'th') or contains(lower(href), 'en')),
u as (select page_id, link, min(pos) as pos from (select * from l union all select page_id, -1, url from pages) group by 1, 2)
select page_id, link, cast(pos as integer) as pos from u
""")
def _(t):
    return X.candidate_links(t.pages, words=["th", "en"]).select("page_id", F.col("url").alias("link"), F.col("pos").cast("int").alias("pos"))


@query("link_documents", """
select event_id, case event_type when 'click' then concat('http://h/', event_id, '.PDF') when 'view' then concat('https://api/u1/p', event_id, '.xlsx')
    when 'purchase' then concat('https://api/u1/v', event_id) else concat('https://api/u1/', event_id, '?origin=2') end as link,
  case event_type when 'click' then concat('Doc ', event_id) else cast(event_id as varchar) end as title,
  case event_type when 'click' then 2024 when 'view' then 2023 end as year, case event_type when 'click' then '.pdf' when 'view' then '.xlsx' else '.pdf' end as ext
from events where event_type <> 'error'
""")
def _(t):
    kind, n = F.col("event_type"), F.col("event_id").cast("string")
    doc = (
        F.when(kind == "click", F.concat(F.lit('{"path": " ", "url": "http://h/'), n, F.lit('.PDF", "year": 2024, "title": " Doc: '), n, F.lit('"}')))
        .when(kind == "view", F.concat(F.lit('{"id": "'), n, F.lit('", "fileUrl": "p'), n, F.lit('.xlsx", "publishDate": "2023-05-01"}')))
        .when(kind == "purchase", F.concat(F.lit('{"id": '), n, F.lit(', "versions": [{"path": ""}, {"url": "v'), n, F.lit('"}], "date": "s/d"}')))
        .when(kind == "signup", F.concat(F.lit('{"uuid": "'), n, F.lit('"}')))
        .otherwise(F.concat(F.lit('{"id": "'), n, F.lit('", "year": 2019}')))
    )
    docs = t.events.select("event_id", doc.alias("doc"), F.lit("Geral").alias("tab"))
    rows = X.normalize_link_docs(docs, F.lit("https://api/u1"), low=2022)
    return rows.select("event_id", F.col("url").alias("link"), "title", "year", "ext")


def _files(t):
    body = F.when(F.col("lang") == "en", F.concat(F.lit("%PDF-1.7 "), "text")).when(F.col("lang") == "fr", "").otherwise(F.col("text"))
    return t.documents.select(
        "doc_id", F.when(F.col("lang") == "de", "").otherwise(F.concat("source", F.lit(".pdf"))).alias("nome_arquivo"),
        F.octet_length(body).alias("size"), body.cast("binary").alias("content"),
    )


@query("document_uploads", """
select doc_id, case when lang = 'de' then 'sem_nome.pdf' else concat(source, '.pdf') end as nome_arquivo,
  case lang when 'en' then null when 'fr' then 'empty' else 'not_pdf' end as reject_reason from documents
""")
def _(t):
    return SRC.intake(_files(t)).select("doc_id", "nome_arquivo", "reject_reason")


@query("selected_documents", "select doc_id from documents where source like '%src1%' or source like '%src7%' order by doc_id limit 20")
def _(t):
    return SRC.select_documents(t.documents.withColumnRenamed("source", "nome_arquivo"), ["SRC1", "src7"], 20, order="doc_id").select("doc_id")
