"""Latest rows, pages, top-N, search and listings (WIN-*, SRT-*) over whole tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from issuerlake.operators import windows as X
from issuerlake.operators.ordering import down, up
from issuerlake.plans.catalog.base import day, query


@query("latest_order", """
select o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day, o_totalprice from (
  select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) as rn from orders) where rn = 1
""")
def _(t):
    rows = X.latest_per(t.orders, ["o_custkey"], [down("o_orderdate"), up("o_orderkey")])
    return rows.select("o_custkey", "o_orderkey", day("o_orderdate").alias("day"), "o_totalprice")


_SEEN = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("first_occurrences", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from (select *, row_number() over (
  partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey, l_extendedprice) as rn from lineitem) where rn = 1
""")
def _(t):
    rows = X.dedupe(t.lineitem, ["l_orderkey", "l_linenumber"], _SEEN)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("last_occurrences", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from (select *, row_number() over (
  partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) as rn from lineitem) where rn = 1
""")
def _(t):
    rows = X.dedupe(t.lineitem, ["l_orderkey", "l_linenumber"], _SEEN, keep="last")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("history_page", """
select event_id, user_id, value from events order by ts desc, event_id limit 25 offset 50
""")
def _(t):
    return X.page(t.events, [down("ts"), up("event_id")], 50, 25).select("event_id", "user_id", "value")


@query("history_after", """
select event_id, user_id, value from events where ts < timestamp '2024-01-15 00:00:00' or (ts = timestamp '2024-01-15 00:00:00' and event_id > 500) order by ts desc, event_id limit 25
""")
def _(t):
    after = [datetime(2024, 1, 15), 500]
    return X.page_after(t.events, [("ts", down), ("event_id", up)], after, 25).select("event_id", "user_id", "value")


@query("deep_history_page", """
select l_orderkey, l_linenumber, l_partkey, l_extendedprice from lineitem order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey limit 20 offset 4000
""")
def _(t):
    order = [down("l_extendedprice"), up("l_orderkey"), up("l_linenumber"), up("l_partkey")]
    return X.deep_page(t.lineitem, order, 4000, 20).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("many_top_lines", """
select l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_partkey, cast(rn as integer) as position from (select *, row_number() over (partition by l_returnflag, l_linestatus
  order by l_shipdate desc, l_orderkey, l_linenumber, l_partkey, l_extendedprice) as rn from lineitem) where rn <= 1500
""")
def _(t):
    order = [down("l_shipdate"), up("l_orderkey"), up("l_linenumber"), up("l_partkey"), up("l_extendedprice")]
    return X.top_rows(t.lineitem, ["l_returnflag", "l_linestatus"], order, 1500, rank="position").select("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_partkey", "position")


@query("history_page_info", "select count(*) as total, 50::bigint as offset, 25::bigint as limit, 75 < count(*) as has_more from events".replace(" as offset", ' as "offset"').replace(" as limit", ' as "limit"'))
def _(t):
    return X.page_info(t.events, 50, 25)


@query("page_per_user", """
select user_id, event_id, cast(rn as integer) as position from (
  select *, row_number() over (partition by user_id order by ts desc, event_id) as rn from events) where rn > 5 and rn <= 10
""")
def _(t):
    return X.page_per(t.events, ["user_id"], [down("ts"), up("event_id")], 5, 5).select("user_id", "event_id", "position")


@query("top_orders_per_customer", """
select o_custkey, o_orderkey, o_totalprice, cast(rn as integer) as position, total, total > 3 as has_more from (
  select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn, count(*) over (partition by o_custkey) as total from orders) where rn <= 3
""")
def _(t):
    rows = X.top_n_per(t.orders, ["o_custkey"], [down("o_totalprice"), up("o_orderkey")], 3)
    return rows.select("o_custkey", "o_orderkey", "o_totalprice", "position", "total", "has_more")


@query("recent_jobs", "select o_orderkey, o_orderstatus from orders order by o_orderdate desc, o_orderkey limit 100")
def _(t):
    return X.recent_jobs(t.orders, order=[down("o_orderdate"), up("o_orderkey")]).select("o_orderkey", "o_orderstatus")


def _assets(t):
    return t.orders.select(
        F.concat(F.lit("DEB"), "o_orderkey").alias("ticker_deb"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("nome_emissor"),
        F.lpad(F.col("o_custkey").cast("string"), 14, "0").alias("cnpj"),
    )


def _owners(t):
    return t.customer.select(
        F.lpad(F.col("c_custkey").cast("string"), 14, "0").alias("cnpj"), F.col("c_name").alias("nome"),
        F.concat(F.lit("ac"), "c_custkey").alias("ticker_acao"),
    )


_ASSETS_SQL = """(select concat('DEB', o_orderkey) as ticker, concat('Customer#', lpad(cast(o_custkey as varchar), 9, '0')) as nome,
  lpad(cast(o_custkey as varchar), 14, '0') as cnpj from orders)"""
_OWNERS_SQL = "(select lpad(cast(c_custkey as varchar), 14, '0') as cnpj, c_name as nome, concat('AC', c_custkey) as acao from customer)"
_ASSET_SQL = "concat('ativo-', ticker) as id, ticker as value, concat(nome, ' · ', cnpj) as secondary"
_OWNER_SQL = "concat('emissor-', cnpj) as id, acao as value, concat(cnpj, ' · ', acao) as secondary"


@query("search_by_code", f"""
select id, value, secondary from (
  (select 0 as b, ticker as k, {_ASSET_SQL} from {_ASSETS_SQL} where ticker like 'DEB12%' order by ticker limit 12)
  union all (select 1, ticker, {_ASSET_SQL} from {_ASSETS_SQL} where cnpj like '12%' order by ticker limit 12)
  union all (select 2, cnpj, {_OWNER_SQL} from {_OWNERS_SQL} where cnpj like '12%' order by cnpj limit 12)) order by b, k limit 12
""")
def _(t):
    return X.search_options(_assets(t), _owners(t), " deb12 ").select("id", "value", "secondary")


@query("search_by_name", f"""
select id, value, secondary from (
  (select 1 as b, nome as k, ticker as k2, {_ASSET_SQL} from {_ASSETS_SQL} where nome like 'Cust%' order by nome, ticker limit 20)
  union all (select 3, nome, cnpj, {_OWNER_SQL} from {_OWNERS_SQL} where nome like 'Cust%' order by nome limit 20)) order by b, k, k2 limit 20
""")
def _(t):
    return X.search_options(_assets(t), _owners(t), "cust", limit=20).select("id", "value", "secondary")


@query("search_by_tax_id", f"""
select id, value, secondary from (
  (select 1 as b, ticker as k, {_ASSET_SQL} from {_ASSETS_SQL} where cnpj like '000000000001%' order by ticker limit 6)
  union all (select 2, cnpj, {_OWNER_SQL} from {_OWNERS_SQL} where cnpj like '000000000001%' order by cnpj limit 6)) order by b, k limit 6
""")
def _(t):
    return X.search_options(_assets(t), _owners(t), "00.000.000/0001", limit=6).select("id", "value", "secondary")


_SCORE_SQL = """(select c_name as id, case when lower(c_name) = 'customer#000000012' then 120 + 115 else 0 end
  + case when lower(c_name) like 'customer#000000012%' then 90 + 82 else 0 end + case when lower(c_mktsegment) like 'customer#000000012%' then 74 else 0 end
  + case when lower(c_name) like '%customer#000000012%' then 64 + 44 else 0 end + 8 as score from customer)"""


@query("scored_options", f"select id, cast(score as integer) as score from {_SCORE_SQL}")
def _(t):
    return X.with_score(_options(t), "Cústomer#000000012", "issuer").select("id", "score")


@query("best_option", f"select id, cast(score as integer) as score from {_SCORE_SQL} order by score desc, id limit 1")
def _(t):
    return X.score_options(_options(t), "Cústomer#000000012", "issuer").select("id", "score")


def _options(t):
    return t.customer.select(
        F.col("c_name").alias("id"), F.col("c_name").alias("value"), F.col("c_name").alias("primary"),
        F.col("c_mktsegment").alias("secondary"), F.lit("emissor").alias("tipo"),
    )


@query("ordered_statements", """
select l_orderkey, strftime(l_shipdate, '%Y-%m-%d') as data_ref, l_returnflag as tipo_doc, l_linestatus as demonstracao, l_linenumber as cd_conta from lineitem
""")
def _(t):
    rows = t.lineitem.select(
        "l_orderkey", day("l_shipdate").alias("data_ref"), F.col("l_returnflag").alias("tipo_doc"),
        F.col("l_linestatus").alias("demonstracao"), F.col("l_linenumber").alias("cd_conta"),
    )
    return X.order_statements(rows)


@query("ordered_history", "select event_id, strftime(ts, '%Y-%m-%d') as day from events")
def _(t):
    rows = t.events.select("event_id", F.to_date("ts").alias("data_referencia"))
    return X.order_listing(rows, "history", ["event_id"]).select("event_id", day("data_referencia").alias("day"))
