"""Joins, look-ups and set operations (JOIN-*, SET-*) over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from issuerlake.functions.cleaning import digits
from issuerlake.operators import joins as X
from issuerlake.plans.catalog.base import (
    INSTRUMENTS_SQL, ISSUERS_SQL, SCHEDULE_SQL, day, instruments, issuers, query, schedule,
)


@query("active_portfolio", f"""
select o.ticker_deb, e.grupo_economico, e.setor, e.tipo_capital, strftime(o.data_vencimento, '%Y-%m-%d') as data_vencimento,
  o.volume_emissao, o.indexador, o.lei_incentivo, o.status
from {INSTRUMENTS_SQL} o join {ISSUERS_SQL} e on e.cnpj = o.cnpj where o.status = 'ativo'
""")
def _(t):
    rows = X.active_portfolio(instruments(t), issuers(t))
    return rows.withColumn("data_vencimento", day("data_vencimento"))


@query("upcoming_payments", f"""
select strftime(a.data_evento, '%Y-%m-%d') as data_evento, a.ticker_deb, e.nome as emissor, e.grupo_economico, a.evento,
  a.taxa, a.valor, a.status, date_diff('day', date '1998-10-01', a.data_evento)::integer as dias_para_evento
from {SCHEDULE_SQL} a join {INSTRUMENTS_SQL} o on o.ticker_deb = a.ticker_deb join {ISSUERS_SQL} e on e.cnpj = o.cnpj
where a.data_evento >= date '1998-10-01' and a.status = 'Previsto'
""")
def upcoming(t):
    rows = X.upcoming_payments(schedule(t), instruments(t), issuers(t), F.lit("1998-10-01").cast("date"))
    return rows.withColumn("data_evento", day("data_evento"))


@query("issuer_instruments", f"""
select e.cnpj, e.nome, e.grupo_economico, e.tipo_capital, d.ticker_deb, d.status, d.indexador,
  strftime(d.data_vencimento, '%Y-%m-%d') as data_vencimento, d.lei_incentivo
from {ISSUERS_SQL} e join {INSTRUMENTS_SQL} d on d.cnpj = e.cnpj
""")
def _(t):
    return X.issuer_instruments(issuers(t), instruments(t)).withColumn("data_vencimento", day("data_vencimento"))


def registry(t):
    """Orders as registrations: several per customer, some of them active."""
    status = F.col("o_orderstatus")
    return t.orders.select(
        F.lpad(F.col("o_custkey").cast("string"), 14, "0").alias("CNPJ_CIA"),
        F.col("o_orderkey").cast("string").alias("CD_CVM"), F.col("o_orderpriority").alias("CATEG_REG"),
        F.when(status == "F", "FASE OPERACIONAL").when(status == "P", "FASE PRÉ-OPERACIONAL").otherwise("CANCELADA").alias("SIT"),
        F.lit("INATIVO").alias("SIT_REG"), F.col("o_orderkey").alias("file_order"),
    )


def overrides(t):
    """Suppliers as manual corrections; every other code is not registered."""
    return t.supplier.select(
        F.lpad(F.col("s_suppkey").cast("string"), 14, "0").alias("cnpj"),
        F.when(F.col("s_acctbal") > 5000, F.col("s_suppkey").cast("string")).otherwise(F.concat(F.lit("X"), "s_suppkey")).alias("cod_cvm"),
    )


REGISTRY_SQL = """(select lpad(cast(o_custkey as varchar), 14, '0') as cnpj, cast(o_orderkey as varchar) as code, o_orderpriority as category,
  case o_orderstatus when 'F' then 'FASE OPERACIONAL' when 'P' then 'FASE PRÉ-OPERACIONAL' else 'CANCELADA' end as sit, o_orderkey as pos from orders)"""
OVERRIDES_SQL = """(select lpad(cast(s_suppkey as varchar), 14, '0') as cnpj,
  case when s_acctbal > 5000 then cast(s_suppkey as varchar) else concat('X', s_suppkey) end as code from supplier)"""
RESOLVED_SQL = f"""
forced as (select c.cnpj, coalesce(r.code, v.code) as code, coalesce(r.category, 'FORCED_OVERRIDE') as category, r.sit, 'override' as matched_by
  from (select distinct lpad(cast(c_custkey as varchar), 14, '0') as cnpj from customer) c
  join {OVERRIDES_SQL} v on v.cnpj = c.cnpj left join {REGISTRY_SQL} r on r.code = v.code),
plain as (select cnpj, code, category, sit, 'cnpj' as matched_by from (
  select r.*, row_number() over (partition by cnpj order by case when sit = 'FASE OPERACIONAL' then 0 else 1 end, pos) as rn from {REGISTRY_SQL} r) x
  where rn = 1 and cnpj in (select lpad(cast(c_custkey as varchar), 14, '0') from customer) and cnpj not in (select cnpj from forced)),
resolved as (select * from forced union all select * from plain)"""


def ids(t):
    return t.customer.select(F.lpad(F.col("c_custkey").cast("string"), 14, "0").alias("cnpj"), F.col("c_name").alias("nome"))


@query("registry_matches", f"""
with {RESOLVED_SQL} select cnpj, code as cd_cvm, category as categ_reg, sit, matched_by from resolved
""")
def _(t):
    rows = X.resolve_registry(ids(t), registry(t), overrides(t))
    return rows.select(
        "cnpj", F.col("CD_CVM").alias("cd_cvm"), F.col("CATEG_REG").alias("categ_reg"), F.col("SIT").alias("sit"), "matched_by"
    )


@query("registry_matches_by_substring", """
select cnpj, code as cd_cvm from (
  select lpad(cast(o_custkey as varchar), 14, '0') as cnpj, cast(o_orderkey as varchar) as code,
    row_number() over (partition by o_custkey order by o_orderkey) as rn from orders) where rn = 1
  and cnpj in (select lpad(cast(c_custkey as varchar), 14, '0') from customer)
""")
def _(t):
    return X.resolve_registry(ids(t), registry(t), compat=True).select("cnpj", F.col("CD_CVM").alias("cd_cvm"))


@query("filled_issuers", """
select o_orderkey as ticker, case when o_orderstatus = 'P' then cast(c.o_cust as varchar) else cast(o_custkey as varchar) end as cnpj_emissor
from orders left join (select l_orderkey as k, max(l_suppkey) as o_cust from lineitem where l_returnflag = 'A' group by 1) c on c.k = o_orderkey
""")
def _(t):
    emissions = t.orders.select(
        F.col("o_orderkey").alias("ticker"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_custkey").cast("string")).alias("cnpj_emissor"),
    )
    chars = t.lineitem.where("l_returnflag = 'A'").groupBy(F.col("l_orderkey").alias("ticker")).agg(F.max("l_suppkey").alias("cnpj"))
    return X.fill_issuer(emissions, chars).select("ticker", "cnpj_emissor")


@query("discovered_issuers", """
select cast(c_custkey as varchar) as cnpj, c_name as nome, 'Fechado' as tipo_capital from customer
where c_custkey not in (select s_suppkey from supplier)
""")
def _(t):
    chars = t.customer.select(F.col("c_custkey").alias("cnpj"), F.concat(F.lit(" "), "c_name").alias("nome"))
    known = t.supplier.select(F.col("s_suppkey").alias("cnpj"))
    return X.discover_issuers(chars, known).select("cnpj", "nome", "tipo_capital")


def _documents(t):
    return t.documents.select("doc_id", F.col("source").alias("cnpj"), F.md5("text").alias("hash_md5"))


def _manifest(t):
    return t.documents.join(t.labels, "doc_id", "left_semi").select(F.col("source").alias("cnpj"), F.md5("text").alias("hash_md5"))


MANIFEST_SQL = "(select distinct source, md5(text) as h from documents where doc_id in (select doc_id from labels))"


@query("new_documents", f"""
select doc_id, source as cnpj from documents d where not exists (
  select 1 from {MANIFEST_SQL} m where m.source = d.source and m.h = md5(d.text))
""")
def _(t):
    return X.new_documents(_documents(t), _manifest(t)).select("doc_id", "cnpj")


@query("document_intake", f"""
select d.source as cnpj, cast(count(*) as bigint) as received, cast(sum(case when m.h is null then 1 else 0 end) as bigint) as new,
  cast(sum(case when m.h is null then 0 else 1 end) as bigint) as skipped
from documents d left join {MANIFEST_SQL} m on m.source = d.source and m.h = md5(d.text) group by 1
""")
def _(t):
    return X.document_intake(_documents(t), _manifest(t))


@query("flagged_documents", """
select doc_id, md5(text) in (select md5(text) from documents where doc_id in (select doc_id from labels where quality = 1)) as financeiro from documents
""")
def _(t):
    good = t.documents.join(t.labels.where("quality = 1"), "doc_id", "left_semi").select(F.md5("text").alias("hash_md5"))
    return X.flag_member(_documents(t), good, ["hash_md5"], "financeiro").select("doc_id", "financeiro")


@query("attached_issuers", """
select l_orderkey, l_linenumber, l_partkey, o_orderpriority, o_orderstatus from lineitem left join orders on o_orderkey = l_orderkey
""")
def _(t):
    other = t.orders.withColumnRenamed("o_orderkey", "l_orderkey")
    rows = X.attach(t.lineitem, other, "l_orderkey", ["o_orderpriority", "o_orderstatus"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderpriority", "o_orderstatus")


@query("injected_rates", """
select event_id, coalesce(r.rate, case when event_type = 'view' then value end) as taxa_indicativa from events e
left join (select cast(ts as date) as day, max(value) as rate from events where event_type = 'purchase' and value > 150 group by 1) r on r.day = cast(e.ts as date)
""")
def _(t):
    history = t.events.select(
        "event_id", F.to_date("ts").alias("data_referencia"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("taxa_indicativa"),
    )
    rates = t.events.where("event_type = 'purchase' and value > 150").groupBy(F.to_date("ts").alias("data_referencia")).agg(
        F.replace(F.max("value").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")).alias("taxa_indicativa")
    )
    return X.inject_rates(history, rates).select("event_id", "taxa_indicativa")


@query("mapped_owners", """
select linked, count(*) as n, count(distinct owner) as n_owners from (
  select o_custkey as owner, o_custkey is not null as linked from lineitem left join (select * from orders where o_orderstatus = 'F') on o_orderkey = l_orderkey) group by 1
""")
def _(t):
    keys = t.lineitem.select(F.col("l_orderkey").cast("string").alias("ticker"))
    owners = t.orders.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").cast("string").alias("ticker"), F.col("o_custkey").cast("string").alias("cnpj_emissor")
    )
    return X.map_owner(keys, owners).groupBy("linked").agg(
        F.count("*").alias("n"), F.countDistinct("cnpj_emissor").alias("n_owners")
    )


@query("owner_keys", "select distinct cast(o_custkey as varchar) as cnpj_emissor, o_orderpriority as ticker from orders where o_orderstatus <> 'P'")
def _(t):
    rows = t.orders.select(
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_custkey").cast("string")).alias("cnpj_emissor"),
        F.concat(F.lit(" "), "o_orderpriority").alias("ticker"),
    )
    return X.owner_keys(rows)


@query("ranked_branches", """
select branch_rank, count(*) as n, count(distinct name) as n_names from (
  select 0 as branch_rank, c_name as name from customer union all select 1, s_name from supplier union all select 2, p_name from part) group by 1
""")
def _(t):
    rows = X.union_ranked(
        t.customer.select(F.col("c_name").alias("name")), t.supplier.select(F.col("s_name").alias("name")), t.part.select(F.col("p_name").alias("name"))
    )
    return rows.groupBy("branch_rank").agg(F.count("*").alias("n"), F.countDistinct("name").alias("n_names"))


@query("set_sizes", """
with a as (select distinct l_suppkey as k, l_partkey as v from lineitem where l_returnflag = 'A'),
     b as (select distinct l_suppkey as k, l_partkey as v from lineitem where l_returnflag = 'R'),
     m as (select coalesce(a.k, b.k) as k, a.v as av, b.v as bv from a full join b on a.k = b.k and a.v = b.v)
select k as l_suppkey, cast(count(av) as bigint) as n_a, cast(count(bv) as bigint) as n_b,
  cast(count(*) filter (where bv is null) as bigint) as only_a, cast(count(*) filter (where av is null) as bigint) as only_b,
  cast(count(*) filter (where av is not null and bv is not null) as bigint) as common from m group by 1
""")
def _(t):
    return X.set_compare(t.lineitem.where("l_returnflag = 'A'"), t.lineitem.where("l_returnflag = 'R'"), "l_suppkey", "l_partkey")


@query("wanted_codes", """
select count(*) as n_wanted, count(*) filter (where s_suppkey not in (select l_suppkey from lineitem where l_discount = 0.1)) as n_missing,
  count(*) filter (where s_suppkey not in (select l_suppkey from lineitem where l_discount = 0.1)) = 0 as all_present from supplier
""")
def _(t):
    return X.contains_all(
        t.lineitem.where("l_discount = 0.1").select(F.col("l_suppkey").alias("code")), t.supplier.select(F.col("s_suppkey").alias("code")), "code"
    )
