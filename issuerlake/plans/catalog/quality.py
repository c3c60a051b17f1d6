"""Balances, gaps, coverage and constraint checks (AGG-6..9, DQ-*) over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from issuerlake.operators import quality as X
from issuerlake.plans.catalog.base import day, query


def balances(t):
    """Order totals against the sum of their lines, as assets against liabilities."""
    assets = t.orders.select(
        F.col("o_orderkey").alias("cnpj"), F.lit("BPA").alias("demonstracao"), F.lit("1").alias("cd_conta"), F.col("o_totalprice").alias("valor")
    )
    sums = t.lineitem.groupBy(F.col("l_orderkey").alias("cnpj")).agg(F.round(F.sum("l_extendedprice"), 2).alias("valor"))
    liabilities = sums.select("cnpj", F.lit("BPP").alias("demonstracao"), F.lit("2").alias("cd_conta"), "valor")
    return X.balance_check(assets.unionByName(liabilities), tolerance=0.25, keys=["cnpj"])


_BALANCES_SQL = """(select o_orderkey as cnpj, o_totalprice as assets, s as liabilities,
  case when s is not null then abs(o_totalprice - s) <= abs(o_totalprice) * 0.25 end as balanced
  from orders left join (select l_orderkey, round(sum(l_extendedprice), 2) as s from lineitem group by 1) on l_orderkey = o_orderkey)"""


@query("balance_checks", f"""
select cnpj, assets, liabilities, balanced, case when balanced is null then 'dados insuficientes'
  else concat(case when balanced then 'OK' else 'DIVERGE' end, format('  Ativo={{:,.0f}}  P+PL={{:,.0f}}', assets, liabilities),
    case when balanced then '' else format('  Diff={{:,.0f}}', abs(assets - liabilities)) end) end as message from {_BALANCES_SQL}
""")
def _(t):
    return balances(t)


@query("validation_totals", f"""
select count(*) as n_periods, count(*) filter (where not balanced) as n_divergent, count(*) filter (where balanced is null) as n_unknown from {_BALANCES_SQL}
""")
def _(t):
    return X.validation_totals(balances(t))


@query("year_gaps", """
with y as (select distinct o_custkey as k, cast(year(o_orderdate) as integer) as y from orders), s as (select k, min(y) as a, max(y) as b from y group by 1),
g as (select s.k, u.y from s, lateral (select unnest(range(a, b + 1)) as y) u where not exists (select 1 from y where y.k = s.k and y.y = u.y))
select s.k as o_custkey, a as first_year, b as last_year, coalesce((select string_agg(cast(g.y as varchar), ',' order by g.y) from g where g.k = s.k), '') as gaps from s
""")
def _(t):
    return X.year_gaps(t.orders, "o_custkey", "o_orderdate").withColumn("gaps", F.array_join("gaps", ","))


@query("coverage_report", """
select o_custkey, count(distinct o_orderdate) as n_periods, strftime(min(o_orderdate), '%Y-%m-%d') as first_period,
  strftime(max(o_orderdate), '%Y-%m-%d') as last_period, count(*) as n_rows from orders group by 1
""")
def _(t):
    rows = X.coverage_report(t.orders, "o_custkey", "o_orderdate")
    return rows.withColumn("first_period", day("first_period")).withColumn("last_period", day("last_period"))


@query("period_report", """
select l_orderkey, cast(year(l_shipdate) as integer) as period, max(l_linestatus) as tipo_doc,
  string_agg(distinct l_returnflag, ',' order by l_returnflag) as demonstracoes, count(*) as n_rows from lineitem group by 1, 2
""")
def _(t):
    rows = t.lineitem.select(
        "l_orderkey", F.year("l_shipdate").alias("period"), F.col("l_linestatus").alias("tipo_doc"), F.col("l_returnflag").alias("demonstracao")
    )
    return X.period_report(rows, ["l_orderkey", "period"]).withColumn("demonstracoes", F.array_join("demonstracoes", ","))


@query("duplicate_keys", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def _(t):
    return X.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


_NULLED = "(select l_orderkey, case when l_returnflag = 'R' then null else l_linenumber end as base from lineitem)"


def _nulled(t):
    return t.lineitem.select("l_orderkey", F.when(F.col("l_returnflag") != "R", F.col("l_linenumber")).alias("base"))


@query("duplicate_keys_nulls_equal", f"select l_orderkey, base, count(*) as n from {_NULLED} group by 1, 2 having count(*) > 1")
def _(t):
    return X.duplicate_keys(_nulled(t), ["l_orderkey", "base"])


@query("duplicate_keys_nulls_distinct", f"select l_orderkey, base, count(*) as n from {_NULLED} where base is not null group by 1, 2 having count(*) > 1")
def _(t):
    return X.duplicate_keys(_nulled(t), ["l_orderkey", "base"], nulls_equal=False)


@query("orphans", "select l_orderkey, l_linenumber, l_partkey from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')")
def _(t):
    parents = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return X.orphans(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), parents, ["l_orderkey"])


@query("broken_references", "select l_suppkey, count(*) as n from lineitem where l_suppkey not in (select s_suppkey from supplier where s_acctbal > 5000) group by 1")
def _(t):
    parents = t.supplier.where("s_acctbal > 5000").select(F.col("s_suppkey").alias("l_suppkey"))
    return X.broken_references(t.lineitem, parents, ["l_suppkey"])


@query("null_violations", """
select 'l_orderkey' as "column", count(*) filter (where l_orderkey is null) as n_null from lineitem union all
select 'l_discount', count(*) filter (where nullif(l_discount, 0) is null) from lineitem union all
select 'l_tax', count(*) filter (where nullif(l_tax, 0) is null) from lineitem
""")
def _(t):
    rows = t.lineitem.select("l_orderkey", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), F.nullif("l_tax", F.lit(0.0)).alias("l_tax"))
    return X.null_violations(rows, ["l_orderkey", "l_discount", "l_tax"])


@query("expected_columns", """
select 'text' as "column", true as present, count(text) as n_values from documents union all
select 'lang', true, count(lang) from documents union all select 'titulo', false, 0 * count(*) from documents
""")
def _(t):
    return X.expected_columns(t.documents, ["text", "lang", "titulo"])


@query("enum_violations", "select event_type, count(*) as n from events where event_type not in ('click', 'view') group by 1")
def _(t):
    return X.enum_violations(t.events, "event_type", ["click", "view"])
