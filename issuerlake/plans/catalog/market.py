"""Statement files and market payloads (SRC-3..8, PRJ-11..13): the given tables written as lines and JSON texts, parsed and typed.

One field is an object in some rows and a plain value in others; dates carry times,
numbers decimal commas, and some are not numbers at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuerlake.operators.merges import consolidate_price_rows
from issuerlake.plans.catalog.base import query
from issuerlake.session import ensure_checkpoint_dir
from issuerlake.sources import market as X
from issuerlake.sources import statements as S


def _json(*parts: Column | str) -> Column:
    """Text from constant parts and columns; a null column becomes ``null``."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null")) for p in parts])


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c.cast("string"), F.lit('"'))


def _comma(c: Column) -> Column:
    return F.replace(c.cast("decimal(15,2)").cast("string"), F.lit("."), F.lit(","))


def _characteristics(t) -> DataFrame:
    k, c, p = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice").cast("decimal(15,2)")
    issued, due = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format(F.date_add("o_orderdate", 3650), "yyyy-MM-dd")
    level = F.substring("o_orderpriority", 1, 1)
    pay = F.when(level == "1", "IPCA + 5,5%").when(level == "2", "100% do CDI").when(level == "3", "texto livre")
    rate = F.when(k % 3 == 0, '"7,1"').when(k % 3 == 1, '"1.234,5"').otherwise("4.25")
    indexer = F.when(c % 4 == 0, '{"nome": "DI"}').when(c % 4 == 1, '"IGPM"').when(c % 4 == 2, "null").otherwise('{}')
    law = F.when(k % 5 == 0, '"12.431"').when(k % 5 == 1, "false").when(k % 5 == 2, "null").when(k % 5 == 3, "0").otherwise("true")
    issuer = F.when(c % 6 == 5, "null").otherwise(_json('{"nome": ', _quoted(F.concat(F.lit("E"), c)), ', "cnpj": ', _quoted(F.concat(F.lit("00.0/0-"), c)), "}"))
    lead = _json('{"nome": ', F.when(c % 2 == 0, '""').otherwise(_quoted(F.concat(F.lit("L"), c))), ', "razao_social": ', _quoted(F.concat(F.lit("R"), c)), "}")
    emission = _json(
        '{"numero_emissao": ', _quoted(c % 7), ', "data_emissao": ', _quoted(F.concat(issued, F.when(k % 8 == 0, "T00:00:00").otherwise(""))),
        ', "volume": ', F.when(k % 4 == 0, '"0"').otherwise(_quoted(_comma(F.col("o_totalprice")))), ', "quantidade_emitida": ', k % 11,
        ', "garantia": ', _quoted(F.col("o_orderstatus")), ', "banco_mandatario": ', F.when(c % 3 > 0, _quoted(F.concat(F.lit("M"), c % 3))),
        ', "emissor": ', issuer, ', "coordenador_lider": ', lead, ', "agente_fiduciario": ', F.when(c % 3 == 0, lead), "}",
    )
    value = _json(
        '{"isin": ', _quoted(F.concat(F.lit("BR"), k)), ', "numero_serie": ', k % 10, ', "data_vencimento": ', F.when(F.col("o_orderstatus") == "P", '""').otherwise(_quoted(due)),
        ', "remuneracao": ', _quoted(pay), ', "taxa_emissao": ', rate, ', "volume": ', p, ', "lei": ', law, ', "indexador": ', indexer, ', "outro": [1], "emissao": ', emission, "}",
    )
    return t.orders.select(F.concat(F.lit(" t"), k).alias("ticker"), value.alias("value"))


@query("market_characteristics", """
with o as (select *, o_orderkey as k, o_custkey as c, cast(o_orderdate as date) as d, substr(o_orderpriority, 1, 1) as p,
  case o_custkey % 4 when 0 then 'DI' when 1 then 'IGPM' end as given from orders),
x as (select *, coalesce(given, case p when '1' then 'IPCA' when '2' then 'CDI' end) as indexador, case when given is null then case p when '1' then 5.5::double when '2' then 100.0::double end end as rate from o)
select concat('T', k) as ticker_deb, case when c % 6 <> 5 then concat('0000', c) end as cnpj, case when c % 6 <> 5 then concat('E', c) end as nome_emissor, 'debenture' as tipo,
  concat('BR', k) as isin, cast(k % 10 as varchar) as serie, c % 7 as numero_emissao, strftime(d, '%Y-%m-%d') as data_emissao,
  case when o_orderstatus <> 'P' then strftime(d + interval 3650 day, '%Y-%m-%d') end as data_vencimento,
  case when o_orderstatus <> 'P' and k % 8 <> 0 then round(3650 / 365.25::double, 2) end as prazo_anos, o_totalprice as volume_emissao,
  case when k % 11 <> 0 then round(o_totalprice / (k % 11), 6) end as valor_unitario_emissao, k % 11 as quantidade_debentures, indexador,
  coalesce(rate, case k % 3 when 0 then 7.1::double when 2 then 4.25::double end) as taxa_prefixada, o_orderstatus as especie, case when k % 5 in (0, 4) then 'Sim' else 'Não' end as lei_incentivo,
  case when c % 2 = 0 then concat('R', c) else concat('L', c) end as banco_coordenador, case when c % 3 = 0 then case when c % 2 = 0 then concat('R', c) else concat('L', c) end end as agente_fiduciario,
  case when c % 3 > 0 then concat('M', c % 3) end as banco_liquidante, 'ativo' as status from x
""")
def _(t):
    found = X.clean_characteristics(X.parse_characteristics(_characteristics(t)))
    days = {c: F.date_format(c, "yyyy-MM-dd") for c in ("data_emissao", "data_vencimento")}
    return found.withColumns(days | {"valor_unitario_emissao": F.round("valor_unitario_emissao", 6)})


@query("market_schedule", """
select concat('T', l_orderkey) as ticker_deb, strftime(l_shipdate, '%Y-%m-%d') as data_evento, case when l_linenumber > 1 then strftime(l_shipdate, '%Y-%m-%d') end as data_base,
  case when l_returnflag <> 'N' then strftime(l_shipdate + interval 1 day, '%Y-%m-%d') end as data_liquidacao, l_returnflag as evento, case when l_linenumber > 2 then 'arc' end as evento_arc,
  l_discount as taxa, case when l_tax <> 0.08::double then l_extendedprice end as valor, case l_linestatus when 'O' then 'Previsto' else 'Liquidado' end as status,
  case l_linestatus when 'O' then concat('G', l_linenumber) end as grupo_status from lineitem where l_quantity <= 45
""")
def _(t):
    """Lines as events of their order: objects with ``content`` for even orders, bare arrays for odd ones. Events without a date go."""
    day, after = F.date_format("l_shipdate", "yyyy-MM-dd"), F.date_format(F.date_add("l_shipdate", 1), "yyyy-MM-dd")
    n = F.col("l_linenumber")
    event = _json(
        '{"data_evento": ', F.when(F.col("l_quantity") > 45, '""').otherwise(_quoted(F.concat(day, F.lit("T03:00:00")))), ', "data_base": ', F.when(n > 1, _quoted(day)),
        ', "data_liquidacao": ', F.when(F.col("l_returnflag") != "N", _quoted(after)).otherwise('"n/d"'), ', "evento": ', _quoted(F.col("l_returnflag")), ', "evento_arc": ', F.when(n > 2, '"arc"'),
        ', "taxa": ', _quoted(_comma(F.col("l_discount"))), ', "valor": ', F.when(F.col("l_tax") == 0.08, '"1.234,56"').otherwise(F.col("l_extendedprice").cast("decimal(15,2)").cast("string")),
        ', "status": ', F.when(F.col("l_linestatus") == "O", _json('{"status": "Previsto", "grupo_status": "G', n, '"}')).otherwise('"Liquidado"'), "}",
    )
    lists = t.lineitem.select(F.col("l_orderkey"), event.alias("e")).groupBy("l_orderkey").agg(F.array_join(F.collect_list("e"), ",").alias("e"))
    value = F.when(F.col("l_orderkey") % 2 == 0, _json('{"content": [', F.col("e"), '], "pagina": 1}')).otherwise(_json(" [", F.col("e"), "]"))
    found = X.clean_schedule(X.parse_schedule(lists.select(F.concat(F.lit("t"), "l_orderkey", F.lit(" ")).alias("ticker"), value.alias("value"))))
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("data_evento", "data_base", "data_liquidacao")})


def _by_day(t, row: Column, name: Column) -> DataFrame:
    """Events of a user, day and type as one JSON list; day by day, so that no list grows with a user."""
    rows = t.events.select("user_id", F.to_date("ts").alias("d"), name.alias("name"), "event_id", row.alias("row")).where("name is not null")
    lists = rows.groupBy("user_id", "d", "name").agg(F.sort_array(F.collect_list(F.struct("event_id", "row"))).alias("rows"))
    return lists.select("user_id", "name", F.array_join(F.col("rows.row"), ",").alias("list"))


@query("price_payloads", """
with e as (select user_id, event_id, event_type, value, strftime(ts, '%Y-%m-%d') as day, strftime(ts, '%Y-%m-%d %H:%M:%S') as moment, cast(props->>'$.k' as bigint) as n from events where event_type <> 'error'),
last as (select * from (select *, row_number() over (partition by user_id, day, event_type order by event_id desc) as rn from e) where rn = 1),
k as (select distinct user_id, day from e),
fv as (select * from (select *, row_number() over (partition by user_id, day order by event_id) as rn from e where event_type = 'view' and value > 40) where rn = 1),
fp as (select * from (select *, row_number() over (partition by user_id, day order by event_id) as rn from e where event_type = 'purchase' and value > 40) where rn = 1)
select k.user_id as ticker_deb, k.day as data_referencia, coalesce(case when c.value > 60 then c.value end, fv.value, s.value) as pu_par, coalesce(case when c.value > 20 then c.value end, fp.value) as pu_indicativo,
  coalesce(v.value, s.value) as vna, coalesce(cast(v.n as double), cast(s.n as double)) as juros, cast(trunc(coalesce(v.value, case when s.value > 10 then s.value end)) as bigint) as prazo_remanescente, p.value as taxa_indicativa,
  cast(p.n as double) as duration_dias_uteis, case when p.n % 2 = 0 then concat('R', p.n) end as reune, case when p.n is not null then 'ok' end as pu_indicativo_status,
  case when v.value is not null then 'F' end as flag_status, case when v.value is not null then v.day when fp.value is not null then fp.day end as data_ultima_atualizacao
from k left join last c on c.user_id = k.user_id and c.day = k.day and c.event_type = 'click' left join last v on v.user_id = k.user_id and v.day = k.day and v.event_type = 'view'
left join last p on p.user_id = k.user_id and p.day = k.day and p.event_type = 'purchase' left join last s on s.user_id = k.user_id and s.day = k.day and s.event_type = 'signup'
left join fv on fv.user_id = k.user_id and fv.day = k.day left join fp on fp.user_id = k.user_id and fp.day = k.day
""")
def _(t):
    """Clicks as chart, views as curve, purchases as prices, signups as the last price of a file: all kinds from one tagged union."""
    kind, n = F.col("event_type"), F.get_json_object("props", "$.k")
    value, plain = _quoted(_comma(F.col("value"))), F.col("value").cast("decimal(12,2)").cast("string")
    day, moment = _quoted(F.date_format("ts", "yyyy-MM-dd'T'HH:mm")), _quoted(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    above = lambda x, c=value: F.when(F.col("value") > x, c)
    row = (
        F.when(kind == "click", _json('{"data": ', day, ', "valor_pu_historico": ', above(60), ', "valor_pu_indicativo": ', above(20, plain), "}"))
        .when(kind == "view", _json('{"data_referencia": ', day, ', "pu_par": ', above(40), ', "vna": ', value, ', "juros": ', n, ', "prazo_remanescente": ', plain, ', "flag_status": "F", "data_ultima_atualizacao": ', moment, "}"))
        .when(kind == "purchase", _json(
            '{"data_referencia": ', day, ', "pu_indicativo": ', above(40), ', "taxa_indicativa": ', value, ', "duration": ', n, ', "reune": ', F.when(n.cast("int") % 2 == 0, _quoted(F.concat(F.lit("R"), n))),
            ', "pu_indicativo_status": "ok", "data_ultima_atualizacao": ', above(40, moment), "}"))
        .when(kind == "signup", _json('{"data_referencia": ', day, ', "pu_par": ', value, ', "vna": ', plain, ', "juros": ', n, ', "prazo_remanescente": ', above(10, plain), "}"))
    )
    lists = _by_day(t, row, F.when(kind != "error", kind))
    file = F.when(F.col("name") == "click", "grafico_pu.json").when(F.col("name") == "view", "pu_historico.json").otherwise("precos.json")
    # The file with a single last price has one object, that of the day's last signup.
    single = F.element_at(F.split("list", r"(?<=\}),"), -1)
    value = (
        F.when(F.col("name") == "click", _json('{"pus": [', F.col("list"), '], "content": [{"data_referencia": "1900-01-01"}]}'))
        .when(F.col("name") == "view", _json('{"content": [', F.col("list"), "]}"))
        .when(F.col("name") == "purchase", _json('{"precos": [', F.col("list"), '], "pu_historico": null}')).otherwise(_json('{"pu_historico": ', single, "}"))
    )
    payloads = lists.select(F.col("user_id").alias("ticker_deb"), file.alias("name"), value.alias("value"))
    return consolidate_price_rows(X.price_rows(payloads)).select(
        "ticker_deb", "data_referencia", "pu_par", "pu_indicativo", "vna", "juros", "prazo_remanescente", "taxa_indicativa", "duration_dias_uteis", "reune",
        "pu_indicativo_status", "flag_status", "data_ultima_atualizacao",
    )


# Numbers of the history row: the event's value plus their place in this list.
_NUMBERS_SQL = ", ".join(f"round(value + {i}, 4) as {c}" for i, c in enumerate(X.HISTORY_NUMBERS))


@query("market_history", f"""
select concat('U', user_id) as ticker_deb, strftime(ts, '%Y-%m-%d') as data_referencia, {_NUMBERS_SQL},
  cast(props->>'$.k' as bigint) as prazo_remanescente, cast(trunc(value) as bigint) as quantidade_negocios, cast(null as bigint) as quantidade_titulos,
  case when event_type = 'click' then concat('N', event_id) end as referencia_ntnb, event_type as reune, 'ok' as pu_indicativo_status, cast(null as varchar) as taxa_indicativa_status, 'F' as flag_status,
  strftime(ts, '%Y-%m-%d') as data_ultima_atualizacao from events where event_type <> 'error'
""")
def _(t):
    """Events as rows of consolidated history files: bare arrays for even users, objects with ``dados`` for odd ones; errors have no date."""
    value, moment = F.col("value").cast("decimal(12,2)"), _quoted(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    numbers = [x for i, c in enumerate(X.HISTORY_NUMBERS) for x in (f', "{c}": ', _quoted(_comma(value + i)) if i % 2 else (value + i).cast("string"))]
    row = _json(
        '{"data_referencia": ', F.when(F.col("event_type") != "error", moment), *numbers, ', "prazo_remanescente": ', F.get_json_object("props", "$.k"), ', "quantidade_negocios": ', _quoted(value),
        ', "quantidade_titulos": "n/d", "referencia_ntnb": ', F.when(F.col("event_type") == "click", _quoted(F.concat(F.lit("N"), "event_id"))), ', "reune": ', _quoted(F.col("event_type")),
        ', "pu_indicativo_status": "ok", "flag_status": "F", "data_ultima_atualizacao": ', moment, "}",
    )
    lists = _by_day(t, row, F.lit("dados"))
    value = F.when(F.col("user_id") % 2 == 0, _json("[", F.col("list"), "]")).otherwise(_json('{"dados": [', F.col("list"), "]}"))
    found = X.clean_history(X.parse_history(lists.select(F.concat(F.lit("u"), "user_id").alias("ticker_deb"), value.alias("value"))))
    return found.withColumns({c: F.round(c, 4) for c in X.HISTORY_NUMBERS} | {"data_referencia": F.date_format("data_referencia", "yyyy-MM-dd")})


@query("statement_lines", """
select lpad(cast(l_suppkey as varchar), 6, '0') as "CD_CVM", strftime(l_shipdate, '%Y-%m-%d') as "DT_REFER", case when l_linenumber % 3 = 0 then null else l_returnflag end as "ORDEM_EXERC",
  cast(l_linenumber as varchar) as "CD_CONTA", concat('conta; ', l_orderkey) as "DS_CONTA", cast(cast(l_extendedprice as decimal(15,2)) as varchar) as "VL_CONTA", concat('f', l_linenumber, l_linestatus) as file_path from lineitem
""")
def _(t):
    """Lines of files with three layouts: columns permuted, columns added, and rows that end early."""
    n = F.col("l_linenumber")
    of = {
        "CD_CVM": F.lpad(F.col("l_suppkey").cast("string"), 6, "0"), "DT_REFER": F.date_format("l_shipdate", "yyyy-MM-dd"), "ORDEM_EXERC": F.col("l_returnflag"),
        "CD_CONTA": n.cast("string"), "DS_CONTA": F.concat(F.lit("conta; "), "l_orderkey"), "VL_CONTA": F.col("l_extendedprice").cast("decimal(15,2)").cast("string"), "GRUPO": F.lit("x"),
    }
    # In the first layout rows stop before the last column of the header.
    layouts = [["GRUPO", "CD_CVM", "DT_REFER", "CD_CONTA", "DS_CONTA", "VL_CONTA", "ORDEM_EXERC"], list(of), ["GRUPO", "GRUPO", *reversed(list(of)[:6])]]

    def line(values) -> Column:
        pick = None
        for k, layout in enumerate(layouts):
            row = F.array(*[values(c) for c in layout])
            if k == 0:
                row = F.slice(row, 1, len(layout) - 1)
            pick = F.when(n % 3 == k, row) if pick is None else pick.when(n % 3 == k, row)
        return pick

    file = F.concat(F.lit("f"), n, "l_linestatus").alias("file_path")
    rows = t.lineitem.select(file, line(lambda c: of[c]).alias("fields"))
    header = None
    for k, layout in enumerate(layouts):
        some = F.when(n % 3 == k, F.array(*[F.lit(c) for c in layout]))
        header = some if header is None else F.coalesce(header, some)
    headers = t.lineitem.select(file, header.alias("fields")).distinct()
    return S.map_columns(rows.unionByName(headers))


@query("statement_file_choice", """
with f as (select distinct case l_linestatus when 'O' then 'DFP' else 'ITR' end as doc_type, ['BPA', 'BPP', 'DRE', 'DFC_MD', 'DFC_MI', 'DVA', 'BPA'][l_linenumber] as tbl,
  case when l_suppkey % 7 = 0 then 'con' else 'ind' end as scope, cast(year(l_shipdate) as integer) as year, l_suppkey % 5 as folder from lineitem where l_suppkey % 7 <> 0 or l_linenumber > 3)
select doc_type, tbl as "table", scope, year, concat('file:/a/', folder, '/', lower(doc_type), '_cia_aberta_', tbl, '_', scope, '_', year, '.csv') as path from f
where scope = 'con' or not exists (select 1 from f g where g.scope = 'con' and g.doc_type = f.doc_type and g.tbl = f.tbl and g.year = f.year)
""")
def _(t):
    """A listing of files of both scopes in several folders; some tables have no consolidated one."""
    tables = F.array(*[F.lit(x) for x in ("BPA", "BPP", "DRE", "DFC_MD", "DFC_MI", "DVA", "BPA")])
    scope = F.when(F.col("l_suppkey") % 7 == 0, "con").otherwise("ind")
    stem = F.concat_ws("_", F.when(F.col("l_linestatus") == "O", "dfp").otherwise("itr"), F.lit("cia_aberta"), F.element_at(tables, F.col("l_linenumber")), scope, F.year("l_shipdate"))
    name = F.concat(F.lit("file:/a/"), F.col("l_suppkey") % 5, F.lit("/"), F.when((scope == "con") & (F.col("l_linenumber") <= 3), "leia").otherwise(stem), F.lit(".csv"))
    # The listing is written once: else its names would be parsed for every line that they are made of, not for every file.
    ensure_checkpoint_dir(t.spark)
    return S.preferred_files(S.describe_files(t.lineitem.select(name.alias("path")).distinct().checkpoint()))
