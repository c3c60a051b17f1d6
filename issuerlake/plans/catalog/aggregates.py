"""Counts, totals, nested forms and costs (AGG-1..5, AGG-10..17) over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from issuerlake.operators import aggregates as X
from issuerlake.plans.catalog.base import INSTRUMENTS_SQL, instruments, query


@query("portfolio_summary", f"""
select count(*) as total_operacoes, round(sum(volume_emissao), 2) as total_volume, count(*) filter (where lei_incentivo = 'Sim') as incentivadas,
  count(*) filter (where lei_incentivo <> 'Sim') as nao_incentivadas from {INSTRUMENTS_SQL}
""")
def _(t):
    return X.portfolio_summary(instruments(t)).withColumn("total_volume", F.round("total_volume", 2))


@query("history_counts", "select l_orderkey, count(*) as n from lineitem group by 1")
def _(t):
    return X.count_by(t.lineitem, "l_orderkey")


@query("documents_per_tab", "select source, lang, count(*) as n from documents group by 1, 2")
def _(t):
    return X.count_by(t.documents, "source", "lang")


@query("distinct_sets", "select distinct source as cnpj, md5(text) as hash_md5 from documents")
def _(t):
    return X.distinct_set(t.documents.select(F.col("source").alias("cnpj"), F.md5("text").alias("hash_md5")), "cnpj", "hash_md5")


@query("distinct_domains", "select user_id, string_agg(event_type, ',' order by event_type) as types from (select distinct user_id, event_type from events) group by 1")
def _(t):
    rows = X.distinct_domain(t.events, "user_id", "event_type", "types")
    return rows.withColumn("types", F.array_join("types", ","))


LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "tipo_doc", "l_shipdate"]


def statement_lines(t):
    """Lines as statements: order = issuer, ship year = period, line number = account."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("cnpj"), F.year("l_shipdate").cast("string").alias("data_ref"),
        F.when(F.col("l_linestatus") == "O", "DFP").otherwise("ITR").alias("tipo_doc"),
        F.col("l_returnflag").alias("demonstracao"), F.col("l_linenumber").cast("string").alias("cd_conta"),
        F.col("l_partkey").cast("string").alias("ds_conta"), F.col("l_extendedprice").alias("valor"),
        *[c for c in LINE_ORDER if c != "tipo_doc"],
    )


_UP = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, tipo_doc, l_shipdate"
_DOWN = ", ".join(f"{c} desc" for c in _UP.split(", "))
STATEMENT_LINES_SQL = f"""(select l_orderkey as cnpj, cast(year(l_shipdate) as varchar) as data_ref,
  case l_linestatus when 'O' then 'DFP' else 'ITR' end as tipo_doc, l_returnflag as demonstracao, cast(l_linenumber as varchar) as cd_conta,
  cast(l_partkey as varchar) as ds_conta, l_extendedprice as valor, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate from lineitem)"""
ROUND_TRIP_SQL = f"""
with s as (select * from {STATEMENT_LINES_SQL}),
labels as (select cnpj, data_ref, tipo_doc from (select *, row_number() over (partition by cnpj, data_ref order by {_UP}) as rn from s) where rn = 1),
accounts as (select * from (select *, row_number() over (partition by cnpj, data_ref, demonstracao, cd_conta order by {_DOWN}) as rn from s) where rn = 1)
select a.cnpj, a.data_ref, l.tipo_doc, a.demonstracao, a.cd_conta, a.ds_conta, a.valor from accounts a join labels l on l.cnpj = a.cnpj and l.data_ref = a.data_ref
"""


@query("nested_statements", f"""
with r as ({ROUND_TRIP_SQL}) select cnpj, data_ref, max(tipo_doc) as tipo, string_agg(distinct demonstracao, ',' order by demonstracao) as statements,
  cast(count(*) as bigint) as n_accounts from r group by 1, 2
""")
def _(t):
    rows = X.nest_statements(statement_lines(t), order=LINE_ORDER)
    sizes = F.transform(F.map_values("demonstracoes"), lambda m: F.size(m).cast("long"))
    return rows.select(
        "cnpj", "data_ref", "tipo", F.array_join(F.array_sort(F.map_keys("demonstracoes")), ",").alias("statements"),
        F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_accounts"),
    )


@query("unnested_statements", ROUND_TRIP_SQL)
def _(t):
    return X.unnest_statements(X.nest_statements(statement_lines(t), order=LINE_ORDER))


@query("extraction_counts", """
select l_suppkey, count(distinct year(l_shipdate)) as n_periods, count(*) as n_accounts from lineitem group by 1
""")
def _(t):
    rows = t.lineitem.select("l_suppkey", F.year("l_shipdate").alias("period"))
    return X.extraction_counts(rows, ["l_suppkey"], "period")


@query("most_common", """
select user_id, event_type, n from (select *, row_number() over (partition by user_id order by n desc, first_id) as rn from (
  select user_id, event_type, count(*) as n, min(event_id) as first_id from events group by 1, 2)) where rn = 1
""")
def _(t):
    return X.most_common(t.events, ["user_id"], "event_type", "event_id").select("user_id", "event_type", "n")


@query("outcome_summary", """
select user_id, count(*) filter (where event_type in ('purchase', 'signup')) as ok, count(*) filter (where event_type = 'click') as cached,
  count(*) filter (where event_type = 'error') as failed, count(*) as total,
  round((count(*) - count(*) filter (where event_type = 'error')) * 100.0::double / count(*), 2) as success_rate from events group by 1
""")
def _(t):
    return X.outcome_summary(
        t.events, ["user_id"], "event_type", {"ok": ["purchase", "signup"], "cached": ["click"], "failed": ["error"]}
    )


@query("ingest_counters", """
with e as (select user_id as job_id, value < 50 as quant, event_type as o from events)
select job_id, count(*) filter (where quant and o = 'click') as quant_processados, count(*) filter (where not quant and o in ('click', 'purchase', 'signup')) as qual_processados,
  count(*) filter (where not quant and o = 'purchase') as qual_fallback, count(*) filter (where not quant and o = 'signup') as qual_sem_conteudo,
  count(*) filter (where quant and o = 'view') as pulados_quant, count(*) filter (where not quant and o = 'view') as pulados_qual,
  count(*) filter (where o = 'error') as falhas, count(*) filter (where o in ('purchase', 'signup', 'error')) as erros,
  case when count(*) filter (where o in ('purchase', 'signup', 'error')) > 0 then 'concluido_com_erros' else 'concluido' end as status from e group by 1
""")
def _(t):
    kind = F.col("event_type")
    events = t.events.select(
        F.col("user_id").alias("job_id"), F.when(F.col("value") < 50, "quant").otherwise("qual").alias("track"),
        F.when(kind == "click", "processed").when(kind == "view", "skipped").when(kind == "purchase", "fallback")
        .when(kind == "signup", "empty").otherwise("failed").alias("outcome"),
    )
    return X.ingest_counters(events)


def calls(t):
    """Events as extraction calls."""
    return t.events.select(
        F.col("user_id").alias("doc_id"), F.col("event_type").alias("model"), "event_id",
        F.when(F.col("value") > 100, "MAX_TOKENS").when(F.col("value") > 50, "STOP").otherwise("OTHER").alias("finish_reason"),
        (F.col("value") > 100).alias("truncated"), F.col("value").alias("latency"),
        F.floor(F.col("value") * 10).alias("tokens_in"), F.floor(F.col("value")).alias("tokens_out"),
        F.get_json_object("props", "$.k").cast("long").alias("tokens_thinking"),
    )


CALLS_SQL = """(select user_id as doc_id, event_type as model, event_id,
  case when value > 100 then 'MAX_TOKENS' when value > 50 then 'STOP' else 'OTHER' end as finish_reason, value > 100 as truncated, value as latency,
  cast(floor(value * 10) as bigint) as tokens_in, cast(floor(value) as bigint) as tokens_out, cast(json_extract_string(props, '$.k') as bigint) as tokens_thinking from events)"""
PRICES = [("click", 0.3, 2.5), ("view", 0.25, 1.5), ("purchase", 1.0, 4.0), ("signup", 0.1, 0.4), ("error", 0.0, 0.0)]
PRICES_SQL = "(values " + ", ".join(f"('{m}', {i}::double, {o}::double)" for m, i, o in PRICES) + ") as p(model, price_in, price_out)"


def prices(t):
    return t.spark.createDataFrame(PRICES, "model string, price_in double, price_out double")


COST_SQL = f"""(select c.*, tokens_in / 1e6 * price_in + (tokens_out + tokens_thinking) / 1e6 * price_out as cost from {CALLS_SQL} c join {PRICES_SQL} on p.model = c.model)"""


@query("chunk_metrics", f"""
with r as (select doc_id, model, finish_reason, count(*) as n from {CALLS_SQL} group by 1, 2, 3),
f as (select doc_id, model, string_agg(concat(finish_reason, ':', n), ',' order by finish_reason) as reasons from r group by 1, 2)
select c.doc_id, c.model, count(*) as n_chunks, count(*) filter (where truncated) as n_truncated, max(reasons) as reasons, round(sum(latency), 2) as latency,
  cast(sum(tokens_in) as bigint) as tokens_in, cast(sum(tokens_out) as bigint) as tokens_out, cast(sum(tokens_thinking) as bigint) as tokens_thinking
from {CALLS_SQL} c join f on f.doc_id = c.doc_id and f.model = c.model group by 1, 2
""")
def _(t):
    rows = X.chunk_metrics(X.call_cost(calls(t), prices(t)), ["doc_id", "model"])
    reasons = F.transform("finish_reasons", lambda r: F.concat_ws(":", r["finish_reason"], r["n"].cast("string")))
    return rows.select(
        "doc_id", "model", "n_chunks", "n_truncated", F.array_join(reasons, ",").alias("reasons"), "latency",
        "tokens_in", "tokens_out", "tokens_thinking",
    )


@query("model_cost", f"""
select t.model, t.tokens_in, t.tokens_out, t.tokens_thinking, round(tokens_in / 1e6 * price_in + (tokens_out + tokens_thinking) / 1e6 * price_out, 6) as cost
from (select model, cast(sum(tokens_in) as bigint) as tokens_in, cast(sum(tokens_out) as bigint) as tokens_out, cast(sum(tokens_thinking) as bigint) as tokens_thinking
  from {CALLS_SQL} group by 1) t join {PRICES_SQL} on p.model = t.model
""")
def _(t):
    return X.model_cost(calls(t), prices(t))


@query("nested_children", """
select l_orderkey, cast(year(l_shipdate) as integer) as part, string_agg(concat(strftime(l_shipdate, '%Y-%m-%d'), '/', l_linenumber), ',' order by l_shipdate, l_linenumber) as items,
  count(*) as n_items from lineitem group by 1, 2
""")
def _(t):
    rows = X.nest_children(t.lineitem, ["l_orderkey"], ["l_shipdate", "l_linenumber"], [], F.year("l_shipdate"))
    shown = F.transform("items", lambda x: F.concat_ws("/", F.date_format(x["l_shipdate"], "yyyy-MM-dd"), x["l_linenumber"].cast("string")))
    return rows.withColumn("items", F.array_join(shown, ","))


@query("nested_blocks", """
with p as (select l_returnflag, strftime(l_shipdate, '%Y-%m-%d') as d, l_orderkey, l_linenumber, l_partkey,
  row_number() over (partition by l_returnflag order by l_shipdate, l_orderkey, l_linenumber, l_partkey) - 1 as pos from lineitem)
select l_returnflag, cast(pos // 1000 as integer) as part, count(*) as n_items,
  md5(string_agg(concat(d, '/', l_orderkey, '/', l_linenumber, '/', l_partkey), ',' order by pos)) as items from p group by 1, 2
""")
def _(t):
    names = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    rows = X.nest_blocks(t.lineitem, ["l_returnflag"], names, names, 1000)
    shown = F.transform("items", lambda x: F.concat_ws("/", F.date_format(x["l_shipdate"], "yyyy-MM-dd"), *[x[c].cast("string") for c in names[1:]]))
    return rows.withColumn("items", F.md5(F.array_join(shown, ",")))
