"""Column functions (PRJ-*) over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from issuerlake.functions import cleaning as C
from issuerlake.functions import display as D
from issuerlake.functions import jobs as J
from issuerlake.functions import naming as N
from issuerlake.functions.text import token_estimate
from issuerlake.plans.catalog.base import query


@query("tax_id_digits", """
select c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') as digits,
       lpad(cast(c_custkey as varchar), 14, '0') as padded,
       substr(regexp_replace(c_name, '[^0-9]', '', 'g'), 1, 5) as cut
from customer
""")
def _(t):
    return t.customer.select(
        "c_custkey", C.digits("c_name").alias("digits"), C.digits("c_custkey", pad=14).alias("padded"),
        C.digits("c_name", cut=5).alias("cut"),
    )


@query("registry_codes", """
select c_custkey, cast(c_custkey as varchar) as code, regexp_replace(c_name, '^ +| +$', '', 'g') as name_code
from customer
""")
def _(t):
    padded = F.concat(F.lit(" "), F.lpad(F.col("c_custkey").cast("string"), 9, "0"), F.lit(" "))
    return t.customer.select("c_custkey", C.norm_code(padded).alias("code"), C.norm_code("c_name").alias("name_code"))


_CODES_SQL = """case l_returnflag when 'A' then cast(l_linenumber as varchar)
  when 'N' then concat(l_linenumber, '.', l_suppkey) else concat(l_linenumber, '.', l_suppkey, '.', l_partkey) end"""


def _account_code():
    return (
        F.when(F.col("l_returnflag") == "A", F.col("l_linenumber").cast("string"))
        .when(F.col("l_returnflag") == "N", F.concat_ws(".", "l_linenumber", "l_suppkey"))
        .otherwise(F.concat_ws(".", "l_linenumber", "l_suppkey", "l_partkey"))
    )


@query("account_levels", f"""
select cast(length(code) - length(replace(code, '.', '')) + 1 as integer) as level, count(*) as n
from (select {_CODES_SQL} as code from lineitem) group by 1
""")
def _(t):
    return t.lineitem.groupBy(C.account_level(_account_code()).alias("level")).agg(F.count("*").alias("n"))


@query("money_values", """
select l_returnflag, round(sum(cast(replace(cast(cast(l_extendedprice as decimal(15,2)) as varchar), '.', '') as decimal(20,0)))::double, 2) as br,
       round(sum(cast(l_extendedprice as decimal(15,2)))::double, 2) as dot
from lineitem group by 1
""")
def _(t):
    text = F.col("l_extendedprice").cast("decimal(15,2)").cast("string")
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.sum(C.parse_money(text).cast("decimal(20,0)")).cast("double"), 2).alias("br"),
        F.round(F.sum(C.parse_money(text, "dot").cast("decimal(15,2)")).cast("double"), 2).alias("dot"),
    )


@query("decimal_and_integer_values", """
select event_id, case when event_type = 'view' then null else value end as decimal_value,
       case when event_type = 'error' then null else cast(trunc(value) as bigint) end as integer_value
from events
""")
def _(t):
    value = F.col("value").cast("decimal(12,2)").cast("string")
    comma = F.when(F.col("event_type") == "view", F.concat(F.lit("1."), F.replace(value, F.lit("."), F.lit(",")))).otherwise(
        F.replace(value, F.lit("."), F.lit(","))
    )
    return t.events.select(
        "event_id", C.parse_decimal(comma).alias("decimal_value"),
        C.parse_int(F.when(F.col("event_type") == "error", "n/d").otherwise(value)).alias("integer_value"),
    )


@query("date_prefixes", "select strftime(ts, '%Y-%m-%d') as day, count(*) as n from events group by 1")
def _(t):
    return t.events.groupBy(C.date10("ts").alias("day")).agg(F.count("*").alias("n"))


@query("remuneration_terms", """
select event_id,
  case event_type when 'purchase' then 'IGPM' when 'click' then 'IPCA' when 'view' then 'CDI' end as indexer,
  case when event_type in ('click', 'view') then value end as rate
from events
""")
def _(t):
    kind = F.col("event_type")
    comma = F.replace(F.col("value").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(","))
    text = (
        F.when(kind == "click", F.concat(F.lit("ipca + "), comma, F.lit("%")))
        .when(kind == "view", F.concat(comma, F.lit("% DO cdi")))
        .when(kind == "purchase", F.concat(F.lit("IPCA + "), comma, F.lit("%")))
        .otherwise("a definir")
    )
    given = F.when(kind == "purchase", "IGPM").when(kind == "error", "None")
    return t.events.withColumn("_p", C.parse_remuneration(text, given)).select(
        "event_id", F.col("_p.indexer").alias("indexer"), F.col("_p.rate").alias("rate")
    )


@query("unit_prices", """
select l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') as day, l_extendedprice / l_quantity as price,
  case when l_discount = 0 then null else l_discount / l_quantity end as rate_price
from lineitem
""")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
        C.unit_price("l_extendedprice", "l_quantity").alias("price"),
        C.unit_price("l_discount", "l_quantity").alias("rate_price"),
    )


@query("tenors", """
select o_orderkey, round(date_diff('day', cast(o_orderdate as date), date '2010-06-30') / 365.25, 2)::double as years from orders
""")
def _(t):
    return t.orders.select("o_orderkey", C.tenor_years("o_orderdate", F.lit("2010-06-30").cast("date")).alias("years"))


@query("clean_keys", """
select p_partkey, upper(p_name) as key, case when p_size > 25 then p_type end as text from part
""")
def _(t):
    padded = F.when(F.col("p_size") > 25, F.concat(F.lit("\t"), "p_type", F.lit(" \n"))).otherwise("   ")
    return t.part.select(
        "p_partkey", C.upper_key(F.concat(F.lit(" "), "p_name", F.lit("\r\n"))).alias("key"), C.blank_to_null(padded).alias("text")
    )


@query("tax_id_masks", """
select c_custkey,
  regexp_replace(lpad(cast(c_custkey as varchar), 14, '0'), '^(\\d{2})(\\d{3})(\\d{3})(\\d{4})(\\d{2})$', '\\1.\\2.\\3/\\4-\\5') as full_mask,
  regexp_replace(regexp_replace(c_name, '[^0-9]', '', 'g'), '^(\\d{2})(\\d{3})(\\d{3})(\\d+)', '\\1.\\2.\\3/\\4') as partial_mask,
  c_name as unmasked
from customer
""")
def _(t):
    return t.customer.select(
        "c_custkey", D.format_cnpj(C.digits("c_custkey", pad=14)).alias("full_mask"),
        D.mask_cnpj("c_name").alias("partial_mask"), D.format_cnpj("c_name").alias("unmasked"),
    )


@query("display_numbers", """
select o_orderkey,
  concat('R$', chr(160), replace(format('{:,}', cast(round(cast(o_totalprice as decimal(15,2))) as bigint)), ',', '.')) as currency,
  concat(replace(format('{:,}', cast(floor(o_totalprice) as bigint)), ',', '.'),
    rtrim(rtrim(concat(',', lpad(cast(cast(round(o_totalprice * 100) as bigint) % 100 as varchar), 2, '0')), '0'), ','), '%') as percent,
  concat(replace(format('{:,}', cast(floor(o_totalprice) as bigint)), ',', '.'),
    rtrim(rtrim(concat(',', lpad(cast(cast(round(o_totalprice * 100) as bigint) % 100 as varchar), 2, '0')), '0'), ',')) as number,
  strftime(o_orderdate, '%d/%m/%Y') as date, strftime(o_orderdate, '%d/%m/%Y, %H:%M') as moment, '—' as nothing
from orders
""")
def _(t):
    return t.orders.select(
        "o_orderkey", D.fmt_currency("o_totalprice").alias("currency"), D.fmt_percent("o_totalprice").alias("percent"),
        D.fmt_number("o_totalprice").alias("number"), D.fmt_date("o_orderdate").alias("date"),
        D.fmt_datetime("o_orderdate").alias("moment"), D.fmt_number(F.nullif("o_orderpriority", "o_orderpriority")).alias("nothing"),
    )


@query("boolean_labels", """
select case event_type when 'click' then 'Sim' when 'view' then 'Não' when 'purchase' then '—' when 'signup' then 'Sim' else 'error' end as flag,
  count(*) as n from events group by 1
""")
def _(t):
    kind = F.col("event_type")
    raw = F.when(kind == "click", " TRUE ").when(kind == "view", "não").when(kind == "purchase", "").when(kind == "signup", "S").otherwise(kind)
    return t.events.groupBy(D.bool_label(raw).alias("flag")).agg(F.count("*").alias("n"))


@query("enum_labels", """
select p_partkey,
  concat(upper(substr(p_name, 1, 1)), lower(substr(p_name, 2))) as name_label,
  concat('CVM ', lower(p_type), ' ISIN') as type_label,
  concat('Cvm ', p_type) as title
from part
""")
def _(t):
    return t.part.select(
        "p_partkey", D.label("p_name").alias("name_label"),
        D.label(F.concat(F.lit("cvm_"), "p_type", F.lit(" isin"))).alias("type_label"),
        D.title_label(F.concat(F.lit("cvm_"), "p_type")).alias("title"),
    )


@query("stage_labels", """
select case o_orderstatus when 'F' then 'Concluído' when 'P' then 'Falhou' else
  case o_orderpriority when '1-URGENT' then 'Acessando DFs na CVM' when '2-HIGH' then 'Verificando duplicatas' when '3-MEDIUM' then '—'
  else concat(substr(o_orderpriority, 1, 1), lower(substr(o_orderpriority, 2))) end end as label, count(*) as n
from orders group by 1
""")
def _(t):
    status = F.when(F.col("o_orderstatus") == "F", "concluido").when(F.col("o_orderstatus") == "P", "erro").otherwise("rodando")
    priority = F.col("o_orderpriority")
    stage = F.when(priority == "1-URGENT", "CVM").when(priority == "2-HIGH", "peek_hashes").when(priority == "3-MEDIUM", " ").otherwise(priority)
    return t.orders.groupBy(D.stage_label(stage, status).alias("label")).agg(F.count("*").alias("n"))


@query("folded_texts", "select doc_id, md5(trim(lower(strip_accents(text)))) as folded from documents")
def _(t):
    return t.documents.select("doc_id", F.md5(D.fold("text")).alias("folded"))


@query("identifiers", """
select c_custkey, upper(c_name) as name_id, lpad(cast(c_custkey as varchar), 14, '0') as number_id,
  lpad(cast(c_custkey as varchar), 14, '0') as direct, '' as direct_name, 'cnpj' as kind, 'text' as name_kind
from customer
""")
def _(t):
    masked = D.format_cnpj(C.digits("c_custkey", pad=14))
    return t.customer.select(
        "c_custkey", D.norm_identifier("c_name").alias("name_id"), D.norm_identifier(masked).alias("number_id"),
        D.direct_identifier(masked).alias("direct"), D.direct_identifier("c_name").alias("direct_name"),
        D.identifier_kind(masked).alias("kind"), D.identifier_kind("c_name").alias("name_kind"),
    )


_PATH_SQL = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
_HOST_SQL = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)"


@query("safe_names", r"""
select page_id,
  left(trim(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[<>:"/\\|?*\x00-\x1f]', ' ', 'g'), '\s+', ' ', 'g')), 100) as label,
  left(regexp_replace(url, '[^A-Za-z0-9_.\-]', '_', 'g'), 120) as file
from pages
""")
def _(t):
    return t.pages.select("page_id", N.safe_name("html").alias("label"), N.safe_name("url", "file").alias("file"))


@query("url_parts", rf"""
select page_id,
  coalesce(nullif(regexp_extract({_PATH_SQL}, '([^/]+)/*$', 1), ''), split_part(regexp_replace({_HOST_SQL}, '^(ri\.|www\.)', ''), '.', 1)) as slug,
  regexp_replace(coalesce(nullif(regexp_extract({_PATH_SQL}, '([^/]+)/*$', 1), ''), 'x'), '^(\d+)\.html$', '\1.Html') as label,
  lower(regexp_extract(regexp_extract({_PATH_SQL}, '([^/]+)/*$', 1), '[^.].*?(\.[^.]+)$', 1)) as ext,
  cast(nullif(regexp_extract(url, '20\d\d'), '') as integer) as year
from pages
""")
def _(t):
    slug = N.url_slug("url")
    return t.pages.select(
        "page_id", slug.alias("slug"), N.slug_label(F.concat(F.lit("central-de-resultados-"), slug)).alias("label"),
        N.url_ext("url").alias("ext"), N.year_from("url").alias("year"),
    )


@query("document_names", r"""
select page_id, concat('DFP_', page_id, '_', left(regexp_replace(url, '[^A-Za-z0-9_.\-]', '_', 'g'), 120), '_', left(md5(url), 8), '.pdf') as name
from pages
""")
def _(t):
    return t.pages.select("page_id", N.doc_name(F.lit("DFP"), "page_id", "url", "url").alias("name"))


@query("document_titles", r"""
select doc_id, coalesce(nullif(left(trim(regexp_replace(trim(trim(trim(trim(regexp_extract(trim(text, e' \n\r\t'), '^([^\n\r]*)', 1)), '"'), ''''), '#'), '\s+', ' ', 'g')), 80), ''),
  concat(source, '-', doc_id)) as title
from documents
""")
def _(t):
    return t.documents.select(
        "doc_id", N.clean_title("text", F.concat("source", F.lit("-"), "doc_id", F.lit(".pdf"))).alias("title")
    )


@query("option_labels", """
select c_custkey, concat_ws(' · ', c_name, c_custkey, case when c_acctbal < 0 then null else c_mktsegment end) as label from customer
""")
def _(t):
    return t.customer.select(
        "c_custkey", D.join_parts("c_name", "c_custkey", F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment"))).alias("label")
    )


@query("token_estimates", "select lang, cast(sum(length(text) // 4) as bigint) as tokens from documents group by 1")
def _(t):
    return t.documents.groupBy("lang").agg(F.sum(token_estimate("text")).alias("tokens"))


_FLOWS_SQL = """(values ('t', 0, 'identidade', null), ('t', 1, 'cvm', 'cvm_pulado'), ('t', 2, 'mercado', null),
  ('d', 0, 'validacao_emissor', null), ('d', 1, 'peek_hashes', null), ('d', 2, 'ia_quant', null), ('d', 3, 'ia_qual', null),
  ('d', 4, 'finalizado', null)) as f(flow, idx, key, skip)"""


def _jobs(t):
    """Orders as jobs: the status by order status, the stage and done steps by priority."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey",
        F.when(status == "F", "concluido").when(status == "P", "erro").otherwise("rodando").alias("status"),
        F.when(priority == "1-URGENT", "CVM ").when(priority == "2-HIGH", "ia_quant").when(priority == "3-MEDIUM", "mercado").alias("stage"),
        F.when(priority == "5-LOW", C.digits("o_custkey", pad=14)).otherwise(F.concat(F.lit("DEB"), "o_custkey")).alias("target"),
        F.when(priority == "1-URGENT", F.array(F.lit("identidade"), F.lit("cvm_pulado"))).when(priority == "2-HIGH", F.array(F.lit("VALIDACAO_EMISSOR"))).alias("done"),
        F.when(priority == "5-LOW", F.concat(F.lit("Emissor "), "o_custkey")).alias("issuer_name"),
    )


@query("job_stages", f"""
with jobs as (
  select o_orderkey, case o_orderstatus when 'F' then 'concluido' when 'P' then 'erro' else 'rodando' end as status,
    case o_orderpriority when '1-URGENT' then 'cvm' when '2-HIGH' then 'ia_quant' when '3-MEDIUM' then 'mercado' end as stage,
    case o_orderpriority when '1-URGENT' then ['identidade', 'cvm_pulado'] when '2-HIGH' then ['validacao_emissor'] else [] end as done,
    case when o_orderpriority in ('2-HIGH', '5-LOW') then 'd' else 't' end as flow
  from orders),
steps as (select j.*, f.idx, f.key, f.skip, coalesce((select idx from {_FLOWS_SQL} where f.flow = j.flow and f.key = j.stage), -1) as here
  from jobs j join {_FLOWS_SQL} on f.flow = j.flow),
states as (select key, case
  when skip is not null and list_contains(done, skip) then 'pulada' when list_contains(done, key) then 'concluida'
  when status = 'erro' and stage = key then 'falhou'
  when status in ('concluido', 'erro') then case when here >= 0 and idx <= here then 'concluida' else 'pendente' end
  when stage = key then 'atual' when here < 0 and idx = 0 then 'atual' when here >= 0 and idx < here then 'concluida'
  else 'pendente' end as state from steps)
select key, state, count(*) as n from states group by 1, 2
""")
def _(t):
    jobs = _jobs(t).select(F.explode(J.stage_states("status", "stage", "target", "done")).alias("_s"))
    return jobs.groupBy(F.col("_s.key").alias("key"), F.col("_s.state").alias("state")).agg(F.count("*").alias("n"))


@query("job_targets", """
select o_orderkey, case when o_orderpriority = '5-LOW' then concat('Emissor ', o_custkey) else concat('DEB', o_custkey) end as primary_label,
  case when o_orderpriority = '5-LOW' then regexp_replace(lpad(cast(o_custkey as varchar), 14, '0'), '^(\\d{2})(\\d{3})(\\d{3})(\\d{4})(\\d{2})$', '\\1.\\2.\\3/\\4-\\5') end as secondary_label
from orders
""")
def _(t):
    return _jobs(t).withColumn("_t", J.job_target("target", "issuer_name")).select(
        "o_orderkey", F.col("_t.primary").alias("primary_label"), F.col("_t.secondary").alias("secondary_label")
    )


@query("progress_entries", """
select key, count(*) as n, count(distinct value) as n_values from (
  select 'qual_processados' as key, cast(o_orderkey as varchar) as value from orders
  union all select 'nome_emissor', concat('Emissor ', o_custkey) from orders where o_orderpriority = '5-LOW'
  union all select 'periodos_cvm', o_orderpriority from orders where o_orderpriority <> '5-LOW'
  union all select 'cnpj', cast(o_custkey as varchar) from orders) group by 1
""")
def _(t):
    name = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("Emissor "), "o_custkey")).otherwise("")
    progress = F.create_map(
        F.lit("qual_processados"), F.col("o_orderkey").cast("string"), F.lit("nome_emissor"), name,
        F.lit("periodos_cvm"), F.col("o_orderpriority"), F.lit("cnpj"), C.digits("o_custkey", pad=14),
        F.lit("erros"), F.lit("[]"), F.lit("mensagem_andamento"), F.lit("x"),
    )
    shown = t.orders.select(F.explode(J.progress_entries(progress)).alias("_e"))
    return shown.groupBy(F.col("_e.key").alias("key")).agg(
        F.count("*").alias("n"), F.countDistinct("_e.value").alias("n_values")
    )
