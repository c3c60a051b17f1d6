"""Precedence merges (MRG-*) over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from issuerlake.operators import merges as X
from issuerlake.plans.catalog.base import query
from issuerlake.plans.catalog.joins import RESOLVED_SQL, overrides, registry

_ROW_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"]


def raw_rows(t):
    """Lines as rows of statement files: supplier = issuer, line status = document type, line number = table."""
    tables = F.array(*[F.lit(x) for x in ("BPA", "BPP", "DRE", "DFC_MD", "DFC_MI", "DVA", "BPA")])
    code = F.concat(F.lit("1."), F.round(F.col("l_discount") * 100).cast("int").cast("string"))
    return t.lineitem.select(
        F.lpad(F.col("l_suppkey").cast("string"), 6, "0").alias("CD_CVM"),
        F.when(F.col("l_linestatus") == "O", "dfp").otherwise("itr").alias("doc_type"),
        F.year("l_shipdate").alias("year"), F.element_at(tables, F.col("l_linenumber")).alias("table"),
        F.concat((F.year("l_shipdate") - F.when(F.col("l_quantity") > 25, 1).otherwise(0)).cast("string"), F.lit("-12-31")).alias("DT_REFER"),
        F.when(F.col("l_tax") == 0.08, F.concat(code, F.lit(".01.01"))).otherwise(code).alias("CD_CONTA"),
        F.col("l_returnflag").alias("DS_CONTA"),
        F.when(F.col("l_tax") == 0.07, "n/d").otherwise(
            F.replace(F.col("l_extendedprice").cast("decimal(15,2)").cast("string"), F.lit("."), F.lit(","))
        ).alias("VL_CONTA"),
        F.when(F.col("l_returnflag") == "R", "PENÚLTIMO").otherwise("ÚLTIMO").alias("ORDEM_EXERC"),
        *[F.col(c) for c in _ROW_ORDER],
    )


def accounts(t):
    return X.statement_accounts(raw_rows(t), 3, _ROW_ORDER)


_DOWN = ", ".join(f"{c} desc" for c in _ROW_ORDER)
_ACCOUNTS_SQL = f"""accounts as (select cod_cvm, doc_type, yr, tbl, data_ref, cd_conta, ds_conta, valor from (
  select *, row_number() over (partition by cod_cvm, doc_type, yr, tbl, data_ref, cd_conta order by {_DOWN}) as rn from (
    select cast(l_suppkey as varchar) as cod_cvm, case l_linestatus when 'O' then 'DFP' else 'ITR' end as doc_type, cast(year(l_shipdate) as integer) as yr,
      ['BPA', 'BPP', 'DRE', 'DFC_MD', 'DFC_MI', 'DVA', 'BPA'][l_linenumber] as tbl,
      concat(year(l_shipdate) - case when l_quantity > 25 then 1 else 0 end, '-12-31') as data_ref,
      concat('1.', cast(round(l_discount * 100) as integer)) as cd_conta, l_returnflag as ds_conta, l_extendedprice as valor, {", ".join(_ROW_ORDER)}
    from lineitem where l_tax <> 0.07::double and l_tax <> 0.08::double and l_returnflag <> 'R')) where rn = 1)"""


@query("statement_accounts", f"""
with {_ACCOUNTS_SQL} select cod_cvm, doc_type, yr as year, tbl as "table", data_ref, cd_conta, ds_conta, valor from accounts
""")
def _(t):
    return accounts(t)


def _consolidated_sql(turn: str, label: str) -> str:
    return f"""
with {_ACCOUNTS_SQL}, turned as (select *, case when tbl like 'DFC%' then 'DFC' else tbl end as demo, {turn} as turn from accounts),
ranked as (select *, min(turn) over w as first_turn, max(turn) over w as last_turn, {label}(turn) over (partition by cod_cvm, data_ref) as label_turn
  from turned window w as (partition by cod_cvm, data_ref, demo)),
labels as (select distinct cod_cvm, data_ref, doc_type from ranked where turn = label_turn)
select r.cod_cvm, r.data_ref, l.doc_type as tipo_doc, r.demo as demonstracao, r.cd_conta, r.ds_conta, r.valor, r.doc_type as source_doc, r.tbl as source_table, r.yr as source_year
from ranked r join labels l on l.cod_cvm = r.cod_cvm and l.data_ref = r.data_ref where r.turn = case when r.demo = 'DFC' then first_turn else last_turn end
"""


@query("consolidated_v2", _consolidated_sql(
    "(9999 - yr) * 100 + case doc_type when 'ITR' then 0 else 10 end + list_position(['BPA', 'BPP', 'DRE', 'DFC_MD', 'DFC_MI', 'DVA'], tbl)", "min"
))
def _(t):
    return X.consolidate_rows(raw_rows(t), 2, 3, _ROW_ORDER)


@query("consolidated_v1", _consolidated_sql(
    "case doc_type when 'DFP' then 0 else 1000000 end + list_position(['BPA', 'BPP', 'DFC_MD', 'DFC_MI', 'DRE', 'DVA'], tbl) * 100000 + yr", "max"
))
def _(t):
    return X.consolidate_rows(raw_rows(t), 1, 3, _ROW_ORDER)


def _long(t, flag: str, kind):
    """Lines of one return flag as long statements with a unique account key."""
    return t.lineitem.where(F.col("l_returnflag") == flag).groupBy(
        F.col("l_suppkey").cast("string").alias("cnpj"), F.year("l_shipdate").cast("string").alias("data_ref"),
        F.col("l_linestatus").alias("demonstracao"), F.col("l_linenumber").cast("string").alias("cd_conta"),
    ).agg(F.max("l_extendedprice").alias("valor")).withColumn("tipo_doc", kind)


def _long_sql(flag: str, kind: str, keep: str = "true") -> str:
    return f"""(select *, {kind} as tipo_doc from (select cast(l_suppkey as varchar) as cnpj, cast(year(l_shipdate) as varchar) as data_ref, l_linestatus as demonstracao,
  cast(l_linenumber as varchar) as cd_conta, max(l_extendedprice) as valor from lineitem where l_returnflag = '{flag}' group by 1, 2, 3, 4) where {keep})"""


_BASE_KIND = "case when data_ref = '1997' then '' else 'DFP' end"
_SPARSE = "valor > 60000 and data_ref <> '1998'"
_NEW_KEEP = "data_ref <> '1996'"


def _base(t):
    return _long(t, "A", F.when(F.col("data_ref") == "1997", "").otherwise("DFP")).where(_SPARSE)


def _new(t):
    return _long(t, "N", F.lit("ITR")).where(_NEW_KEEP)


_PAIR_SQL = f"b as (select * from {_long_sql('A', _BASE_KIND, _SPARSE)}), n as (select * from {_long_sql('N', chr(39) + 'ITR' + chr(39), _NEW_KEEP)})"


@query("overridden_periods", f"""
with {_PAIR_SQL} select cnpj, data_ref, demonstracao, cd_conta, valor, tipo_doc from n union all
select cnpj, data_ref, demonstracao, cd_conta, valor, tipo_doc from b where not exists (select 1 from n where n.cnpj = b.cnpj and n.data_ref = b.data_ref)
""")
def _(t):
    return X.override_periods(_base(t), _new(t))


def _filled_sql(keys: str, label: str, base_label: str) -> str:
    same = " and ".join(f"b2.{k} = n.{k}" for k in keys.split())
    return f"""
with {_PAIR_SQL}, bl as (select cnpj, data_ref, max(nullif(tipo_doc, '')) as kind, true as known from b group by 1, 2), nl as (select distinct cnpj, data_ref from n)
select b.cnpj, b.data_ref, demonstracao, cd_conta, valor, {base_label} as tipo_doc from b left join nl on nl.cnpj = b.cnpj and nl.data_ref = b.data_ref
union all select n.cnpj, n.data_ref, demonstracao, cd_conta, valor, {label} from n left join bl on bl.cnpj = n.cnpj and bl.data_ref = n.data_ref
where not exists (select 1 from b b2 where {same})
"""


@query("filled_accounts", _filled_sql(
    "cnpj data_ref demonstracao cd_conta", "coalesce(bl.kind, tipo_doc)", "case when tipo_doc = '' and nl.cnpj is not null then 'ITR' else tipo_doc end"
))
def _(t):
    return X.merge_fill(_base(t), _new(t))


@query("filled_statements", _filled_sql("cnpj data_ref demonstracao", "case when bl.known then bl.kind else tipo_doc end", "tipo_doc"))
def _(t):
    return X.merge_fill(_base(t), _new(t), level="statement")


@query("new_periods", f"""
with {_PAIR_SQL} select cnpj, count(*) as new_periods from (select cnpj, data_ref from n except select cnpj, data_ref from b) group by 1
""")
def _(t):
    return X.new_period_count(_base(t), _new(t))


def _events_of(t, kind: str, **columns):
    """Events of one type as payload rows; missing fields are null text."""
    names = {
        "click": ["data", "valor_pu_historico", "valor_pu_indicativo"],
        "view": ["data_referencia", "pu_par", "vna", "juros", "prazo_remanescente", "flag_status", "data_ultima_atualizacao"],
        "purchase": [
            "data_referencia", "pu_indicativo", "data_ultima_atualizacao", *X.PRICE_NUMBERS, *X.PRICE_TEXTS,
        ],
        "signup": ["data_referencia", "pu_par", "vna", "juros", "prazo_remanescente"],
    }[kind]
    day = F.date_format("ts", "yyyy-MM-dd")
    fields = [
        (day if n in ("data", "data_referencia") else columns.get(n, F.lit(None).cast("string"))).alias(n) for n in names
    ]
    return t.events.where(F.col("event_type") == kind).select(F.col("user_id").alias("ticker_deb"), F.col("event_id").alias("seq"), *fields)


@query("daily_history", """
with e as (select user_id, event_id, event_type, value, strftime(ts, '%Y-%m-%d') as day from events where event_type <> 'error'),
last as (select * from (select *, row_number() over (partition by user_id, day, event_type order by event_id desc) as rn from e) where rn = 1),
first_pu as (select * from (select *, row_number() over (partition by user_id, day, event_type order by event_id) as rn from e where value > 40) where rn = 1),
k as (select distinct user_id, day from e)
select k.user_id as ticker_deb, k.day as data_referencia,
  coalesce(case when c.value > 60 then c.value end, fv.value, s.value) as pu_par,
  coalesce(case when c.value > 20 then c.value end, fp.value) as pu_indicativo,
  coalesce(v.value, s.value) as vna, cast(trunc(coalesce(v.value, case when s.value > 10 then s.value end)) as bigint) as prazo_remanescente,
  p.value as taxa_indicativa, case when v.value is not null then 'F' end as flag_status,
  case when v.value is not null then v.day when fp.value is not null then fp.day end as data_ultima_atualizacao
from k left join last c on c.user_id = k.user_id and c.day = k.day and c.event_type = 'click'
left join last v on v.user_id = k.user_id and v.day = k.day and v.event_type = 'view'
left join last p on p.user_id = k.user_id and p.day = k.day and p.event_type = 'purchase'
left join last s on s.user_id = k.user_id and s.day = k.day and s.event_type = 'signup'
left join first_pu fv on fv.user_id = k.user_id and fv.day = k.day and fv.event_type = 'view'
left join first_pu fp on fp.user_id = k.user_id and fp.day = k.day and fp.event_type = 'purchase'
""")
def _(t):
    value = F.replace(F.col("value").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(","))
    dotted = F.col("value").cast("decimal(12,2)").cast("string")
    moment = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    above = lambda limit, c=value: F.when(F.col("value") > limit, c)
    rows = X.consolidate_history(
        _events_of(t, "click", valor_pu_historico=above(60), valor_pu_indicativo=above(20)),
        _events_of(t, "view", pu_par=above(40), vna=value, prazo_remanescente=dotted, flag_status=F.lit("F"), data_ultima_atualizacao=moment),
        _events_of(t, "purchase", pu_indicativo=above(40), taxa_indicativa=value, data_ultima_atualizacao=above(40, moment)),
        _events_of(t, "signup", pu_par=value, vna=value, prazo_remanescente=above(10, dotted)),
    )
    return rows.select(
        "ticker_deb", "data_referencia", "pu_par", "pu_indicativo", "vna", "prazo_remanescente", "taxa_indicativa", "flag_status",
        "data_ultima_atualizacao",
    )


def _daily(t, kind: str, rate):
    return t.events.where(F.col("event_type") == kind).groupBy(
        F.col("user_id").alias("ticker_deb"), F.date_format("ts", "yyyy-MM-dd").alias("data_referencia")
    ).agg(F.max("value").alias("pu_par")).withColumn("taxa_indicativa", rate).withColumn("fonte", F.lit(kind))


@query("refreshed_history", """
with o as (select user_id, strftime(ts, '%Y-%m-%d') as day, max(value) as v from events where event_type = 'view' group by 1, 2),
n as (select user_id, strftime(ts, '%Y-%m-%d') as day, max(value) as v from events where event_type = 'click' group by 1, 2)
select coalesce(n.user_id, o.user_id) as ticker_deb, coalesce(n.day, o.day) as data_referencia, coalesce(n.v, o.v) as pu_par,
  case when n.v > 50 then n.v else case when o.v > 10 then o.v end end as taxa_indicativa, case when n.user_id is not null then 'click' else 'view' end as fonte
from o full join n on n.user_id = o.user_id and n.day = o.day
""")
def _(t):
    old = _daily(t, "view", F.when(F.col("pu_par") > 10, F.col("pu_par")))
    new = _daily(t, "click", F.when(F.col("pu_par") > 50, F.col("pu_par")))
    return X.merge_history(old, new)


@query("issuer_identities", f"""
with {RESOLVED_SQL} select concat('T', c_custkey) as ticker, c_name as nome_emissor, nullif(c.cnpj, '') as cnpj_emissor, r.code as cod_cvm, r.category as categoria_cvm,
  case when r.cnpj is null or coalesce(r.sit, '') like '%CANCELAD%' then 'Fechado' else 'Aberto' end as tipo_capital,
  case when c.cnpj = '' then 'ERRO_ANBIMA_SEM_CNPJ' else 'SUCESSO' end as status
from (select *, case when c_acctbal < 0 then '' else lpad(cast(c_custkey as varchar), 14, '0') end as cnpj from customer) c left join resolved r on r.cnpj = c.cnpj
""")
def _(t):
    characteristics = t.customer.select(
        F.concat(F.lit(" t"), "c_custkey").alias("ticker"), F.col("c_name").alias("nome"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.lpad(F.col("c_custkey").cast("string"), 14, "0")).alias("cnpj"),
    )
    return X.build_identity(characteristics, registry(t), overrides(t))


@query("resolved_codes", """
with r as (select o_custkey, arg_min(o_orderkey, o_orderkey) as code, arg_min(o_orderpriority, o_orderkey) as category from orders group by 1)
select c_name as nome, lpad(cast(c_custkey as varchar), 14, '0') as cnpj, case when c_acctbal > 0 then 'known' else cast(r.code as varchar) end as cod_cvm,
  case when c_acctbal > 0 then 'Misto' when r.code is null then 'Fechado' else 'Aberto' end as tipo_capital,
  case when c_acctbal > 0 or r.code is null then 'X' else r.category end as categoria
from customer left join r on r.o_custkey = c_custkey
""")
def _(t):
    known = F.when(F.col("c_acctbal") > 0, "known")
    issuers = t.customer.select(
        F.col("c_name").alias("nome"), F.lpad(F.col("c_custkey").cast("string"), 14, "0").alias("cnpj"), known.alias("cod_cvm"),
        F.lit("Misto").alias("tipo_capital"), F.lit("X").alias("categoria"),
    )
    return X.resolve_missing_codes(issuers, registry(t))
