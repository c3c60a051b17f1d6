"""Row selections (FLT-*) over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from issuerlake.functions.naming import is_file_url, url_root
from issuerlake.functions.text import document_year, financial_name_reason, is_financial_name
from issuerlake.operators import filters as X
from issuerlake.plans.catalog.base import day, query


@query("monitored_codes", """
select l_returnflag, count(*) as n, round(sum(l_quantity), 2) as quantity from lineitem
where l_suppkey in (select s_suppkey from supplier where s_acctbal > 5000) group by 1
""")
def _(t):
    codes = t.supplier.where("s_acctbal > 5000").select(F.concat(F.lit(" "), "s_suppkey").alias("cod_cvm"))
    rows = t.lineitem.select("l_returnflag", "l_quantity", F.lpad(F.col("l_suppkey").cast("string"), 6, "0").alias("CD_CVM"))
    return X.keep_codes(rows, codes).groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query("shallow_accounts", """
select l_linestatus, count(*) as n from lineitem where l_returnflag in ('A', 'N') group by 1
""")
def _(t):
    flag = F.col("l_returnflag")
    code = F.when(flag == "A", F.concat_ws(".", "l_linenumber", "l_suppkey")).when(
        flag == "N", F.concat_ws(".", "l_linenumber", "l_suppkey", "l_partkey")
    ).otherwise(F.when(F.col("l_linestatus") == "F", " ").otherwise("1.2.3.4"))
    return X.max_level(t.lineitem.select("l_linestatus", code.alias("CD_CONTA")), 3).groupBy("l_linestatus").agg(F.count("*").alias("n"))


@query("current_periods", "select event_type, count(*) as n from events where event_type <> 'error' group by 1")
def _(t):
    kind = F.col("event_type")
    order = F.when(kind == "error", "PENÚLTIMO").when(kind == "click", "ÚLTIMO").when(kind == "view", "")
    return X.current_period_only(t.events.withColumn("ORDEM_EXERC", order)).groupBy("event_type").agg(F.count("*").alias("n"))


@query("known_or_unknown_years", """
select year, year_inferred, count(*) as n from (
  select case when o_orderstatus = 'P' then null else cast(year(o_orderdate) as integer) end as year,
    o_orderstatus <> 'P' as year_inferred from orders) where year is null or year between 1997 and 1999 group by 1, 2
""")
def _(t):
    years = t.orders.select(F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate")).alias("year"))
    return X.year_between(years, 1997, 1999).groupBy("year", "year_inferred").agg(F.count("*").alias("n"))


@query("recent_documents", """
select doc_year, count(*) as n from (
  select case when year(o_orderdate) + 24 between 2021 and 2025 then cast(year(o_orderdate) + 24 as varchar) else 'ano_desconhecido' end as doc_year,
    o_orderstatus from orders) where doc_year <> 'ano_desconhecido' or o_orderstatus = 'P' group by 1
""")
def _(t):
    year = F.when(F.col("o_orderstatus") == "P", F.lit("novo")).otherwise((F.year("o_orderdate") + 24).cast("string"))
    text = F.when(F.year("o_orderdate") + 24 > 2020, F.concat(F.lit("Release "), (F.year("o_orderdate") + 24).cast("string"))).otherwise(
        F.concat(F.lit("Release "), year)
    )
    links = t.orders.select(text.alias("text"), F.lit("/docs/arquivo.pdf").alias("url"))
    links = links.withColumn("doc_year", document_year("text", "url"))
    return X.drop_old(links).groupBy("doc_year").agg(F.count("*").alias("n"))


@query("missing_rates", """
select user_id, strftime(ts, '%Y-%m-%d') as day, count(*) as n from events
where event_type = 'error' and ts >= timestamp '2024-01-10' and value > 20
  and cast(ts as date) in (select distinct cast(ts as date) from events where event_type = 'purchase' and value > 150)
group by 1, 2
""")
def _(t):
    history = t.events.select(
        "user_id", F.to_date("ts").alias("data_referencia"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("taxa_indicativa"),
        F.when(F.col("value") > 20, F.col("value")).alias("pu_indicativo"),
    )
    wanted = t.events.where("event_type = 'purchase' and value > 150").select(F.to_date("ts").alias("data_referencia"))
    rows = X.missing_rates(history, "2024-01-10", wanted)
    return rows.groupBy("user_id", day("data_referencia").alias("day")).agg(F.count("*").alias("n"))


@query("statement_search", """
select p_partkey, p_name, p_type from part where p_type = 'ECONOMY'
  and lower(concat_ws(' ', p_name, p_brand, p_type)) like '%ring brand#1%'
""")
def _(t):
    rows = X.search_rows(t.part, "  Ring BRAND#1", ["p_name", "p_brand", "p_type"], "ECONOMY", "p_type")
    return rows.select("p_partkey", "p_name", "p_type")


@query("rows_by_key", """
select o_orderkey, o_totalprice from orders where o_orderpriority = '1-URGENT' and o_custkey = 12
""")
def _(t):
    urgent = X.by_key(t.orders, "o_orderpriority", " 1-urgent ", kind="ticker")
    return X.by_key(urgent, "o_custkey", "1-2", kind="cnpj").select("o_orderkey", "o_totalprice")


@query("financial_names", """
select case event_type when 'view' then 'named' when 'signup' then 'default' else 'denied' end as reason,
  event_type in ('view', 'signup') as accepted, count(*) as n from events group by 1, 2
""")
def _(t):
    kind = F.col("event_type")
    name = (
        F.when(kind == "click", "Escritura de emissão DFP ").when(kind == "view", "DFP Anual ").when(kind == "error", "ata de reuniao ")
        .when(kind == "purchase", "RATING_").otherwise("documento ")
    )
    names = t.events.select(F.concat(name, F.col("event_id").cast("string"), F.lit(".pdf")).alias("name"))
    return names.groupBy(financial_name_reason("name").alias("reason"), is_financial_name("name").alias("accepted")).agg(
        F.count("*").alias("n")
    )


@query("file_urls", r"""
select page_id, false as page_is_file, true as pdf_is_file, true as cdn_is_file from pages
""")
def _(t):
    root = url_root("url")
    return t.pages.select(
        "page_id", is_file_url("url").alias("page_is_file"),
        is_file_url(F.concat(root, F.lit("/docs/"), "page_id", F.lit(".PDF?v=1"))).alias("pdf_is_file"),
        is_file_url(F.concat(F.lit("https://filemanager-cdn.example/"), "page_id")).alias("cdn_is_file"),
    )


@query("freshness", """
select user_id, strftime(max(ts), '%Y-%m-%d') as last_day, max(cast(ts as date)) >= date '2024-01-29' as fresh from events group by 1
""")
def _(t):
    rows = X.is_fresh(t.events, "user_id", "ts", F.lit("2024-01-30").cast("date"))
    return rows.select("user_id", day("last_date").alias("last_day"), "fresh")


@query("stale_inputs", """
select event_type, count(*) as n from events where ts <= timestamp '2024-01-20 12:00:00' group by 1
""")
def _(t):
    listing = t.events.withColumnRenamed("ts", "modified_at")
    return X.stale_files(listing, F.lit("2024-01-21 12:00:00").cast("timestamp")).groupBy("event_type").agg(F.count("*").alias("n"))
