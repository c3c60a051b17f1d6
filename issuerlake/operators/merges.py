"""Precedence merges of competing sources (MRG-1..8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuerlake.functions.cleaning import blank_to_null, date10, digits, norm_code, parse_decimal, parse_int, parse_money, strip
from issuerlake.operators.filters import current_period_only, max_level
from issuerlake.operators.joins import resolve_registry
from issuerlake.operators.ordering import null_safe
from issuerlake.operators.spread import spread
from issuerlake.operators.tables import last_update_wins
from issuerlake.operators.windows import dedupe

# Statement tables in processing order, and the statement each one fills.
TABLE_ORDER = ["BPA", "BPP", "DRE", "DFC_MD", "DFC_MI", "DVA"]
STATEMENT_OF_TABLE = {
    "BPA": "BPA", "BPP": "BPP", "DRE": "DRE", "DFC_MD": "DFC", "DFC_MI": "DFC", "DVA": "DVA",
}
FIRST_STAYS = "DFC"

# Where a row stands in the files, in reading order.
FILE_ORDER = ["file_path", "block_start", "row_id"]

ACCOUNT_KEY = ["cnpj", "data_ref", "demonstracao", "cd_conta"]


def _look_up(table: dict, c: Column) -> Column:
    """The value of a key in a constant map; the key is computed once."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c)


def _statement(c: Column) -> Column:
    return _look_up(STATEMENT_OF_TABLE, c)


def account_rows(rows: DataFrame, depth: int = 3, order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """MRG-1: cleaned rows of statement files: depth, current period and numeric value only."""
    dealt = spread(rows, "CD_CVM", "DT_REFER", "CD_CONTA", "VL_CONTA")  # many patterns a row follow
    return current_period_only(max_level(dealt, depth)).select(
        norm_code("CD_CVM").alias("cod_cvm"),
        F.upper("doc_type").alias("doc_type"),
        F.col("year").cast("int").alias("year"),
        F.upper("table").alias("table"),
        strip("DT_REFER").alias("data_ref"),
        strip("CD_CONTA").alias("cd_conta"),
        strip("DS_CONTA").alias("ds_conta"),
        parse_money("VL_CONTA").alias("valor"),
        *order,
    ).where(F.col("valor").isNotNull())


SOURCE_ACCOUNT = ["cod_cvm", "doc_type", "year", "table", "data_ref", "cd_conta"]


def statement_accounts(rows: DataFrame, depth: int = 3, order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """MRG-1: accounts of each source and period; of repeated ones the last row in the files wins."""
    return dedupe(account_rows(rows, depth, order), SOURCE_ACCOUNT, list(order), keep="last").drop(*order)


def _turn_v2() -> Column:
    table = _look_up({name: i for i, name in enumerate(TABLE_ORDER)}, F.col("table"))
    document = _look_up({"ITR": 0, "DFP": 1}, F.upper("doc_type"))
    return (F.lit(9999) - F.col("year")) * 100 + document * 10 + table


def _turn_v1() -> Column:
    table = _look_up({name: i for i, name in enumerate(sorted(TABLE_ORDER))}, F.col("table"))
    document = _look_up({"DFP": 0, "ITR": 1}, F.upper("doc_type"))
    return document * 1_000_000 + table * 100_000 + F.col("year")


def _consolidate(
    accounts: DataFrame, turn: Column, label_of_last: bool, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Whole statements by turn: the last source stays, for cash flow the first one.

    One aggregate over one scan settles, in the map tasks first, which source and row each
    account would come from and which source labels it. An account whose best source is not
    that of its statement is one that the winning source lacks. Lists hold one row per
    account of a period, however often a period's rows repeat.
    """
    keys = list(keys)
    turned = accounts.withColumn("demonstracao", _statement(F.col("table"))).withColumn("_turn", turn)
    turned = turned.where(F.col("demonstracao").isNotNull() & F.col("_turn").isNotNull())
    place = F.when(F.col("demonstracao") == FIRST_STAYS, -F.col("_turn")).otherwise(F.col("_turn")).alias("place")
    later = [F.struct(*order).alias("order")] if order else []
    pick = F.max if label_of_last else F.min
    best = turned.groupBy(*keys, "demonstracao", "cd_conta").agg(
        F.max(F.struct(place, *later, "ds_conta", "valor", "doc_type", "table", "year")).alias("_best"),
        pick(F.struct("_turn", "doc_type")).alias("_label"),
    )
    statements = best.groupBy(*keys, "demonstracao").agg(
        F.collect_list(F.struct("cd_conta", "_best")).alias("_rows"), F.max("_best.place").alias("_winner"), pick("_label").alias("_label")
    ).withColumn("_rows", F.filter("_rows", lambda r: r["_best"]["place"] == F.col("_winner")))
    periods = statements.groupBy(*keys).agg(
        F.collect_list(F.struct("demonstracao", "_rows")).alias("_statements"), pick("_label")["doc_type"].alias("tipo_doc")
    )
    rows = periods.select(*keys, "tipo_doc", F.inline("_statements")).select(*keys, "tipo_doc", "demonstracao", F.inline("_rows"))
    return rows.select(
        *keys, "tipo_doc", "demonstracao", "cd_conta", "_best.ds_conta", "_best.valor",
        F.col("_best.doc_type").alias("source_doc"), F.col("_best.table").alias("source_table"), F.col("_best.year").alias("source_year"),
    )


def consolidate_v2(
    accounts: DataFrame, keys: Sequence[str] = ("cod_cvm", "data_ref"), order: Sequence[str] = ()
) -> DataFrame:
    """MRG-2: years down, ITR before DFP, tables in list order.

    A later source replaces a whole statement; the first cash-flow statement
    stays; the first source labels the period. Of repeated accounts of a source the
    last one by ``order`` stays.
    """
    return _consolidate(accounts, _turn_v2(), False, keys, order)


def consolidate_v1(
    accounts: DataFrame, keys: Sequence[str] = ("cod_cvm", "data_ref"), order: Sequence[str] = ()
) -> DataFrame:
    """MRG-3: DFP before ITR, tables by name, years up; the last source labels the period."""
    return _consolidate(accounts, _turn_v1(), True, keys, order)


def consolidate_rows(
    rows: DataFrame, generation: int = 2, depth: int | None = None, order: Sequence[str] = FILE_ORDER
) -> DataFrame:
    """MRG-1 and MRG-2 (generation 2) or MRG-3 (generation 1) in one plan over raw statement rows."""
    consolidate, default_depth = {1: (consolidate_v1, 2), 2: (consolidate_v2, 3)}[generation]
    depth = depth or default_depth
    return consolidate(account_rows(rows, depth, order), order=order)


def override_periods(base: DataFrame, manual: DataFrame, keys: Sequence[str] = ("cnpj", "data_ref")) -> DataFrame:
    """MRG-4: periods of the manual source replace the same periods of the base."""
    replaced = manual.select(*keys).distinct()
    return base.join(replaced, list(keys), "left_anti").unionByName(manual)


# Numeric and text columns each payload of daily prices fills.
PRICE_NUMBERS = {
    "taxa_indicativa": "taxa_indicativa", "taxa_compra": "taxa_compra", "taxa_venda": "taxa_venda",
    "duration": "duration_dias_uteis", "percentual_pu_par": "percentual_pu_par",
    "percentual_vne": "percentual_vne", "desvio_padrao": "desvio_padrao",
    "intervalo_indicativo_minimo": "intervalo_indicativo_min",
    "intervalo_indicativo_maximo": "intervalo_indicativo_max", "percentual_reune": "percentual_reune",
}
PRICE_TEXTS = {
    "reune": "reune", "data_referencia_ntnb": "referencia_ntnb",
    "pu_indicativo_status": "pu_indicativo_status", "taxa_indicativa_status": "taxa_indicativa_status",
}
NEVER_FILLED = {
    "spread_indicativo": "double", "volume_financeiro": "double", "quantidade_negocios": "long",
    "quantidade_titulos": "long", "taxa_media_negocios": "double", "pu_medio_negocios": "double",
}


# The date column of each payload's rows.
PRICE_DATES = {"chart": "data", "curve": "data_referencia", "prices": "data_referencia", "last": "data_referencia"}


def _price_columns(kind: str, at: str = "") -> dict[str, Column]:
    """Typed columns of a payload's row, whose raw fields lie under ``at``."""
    raw = lambda c: F.col(at + c)
    if kind == "chart":
        return {"pu_par": parse_decimal(raw("valor_pu_historico")), "pu_indicativo": parse_decimal(raw("valor_pu_indicativo"))}
    if kind == "prices":
        return {
            **{out: parse_decimal(raw(c)) for c, out in PRICE_NUMBERS.items()},
            **{out: raw(c).cast("string") for c, out in PRICE_TEXTS.items()},
            "pu_indicativo": parse_decimal(raw("pu_indicativo")),
            "data_ultima_atualizacao": date10(raw("data_ultima_atualizacao")),
        }
    curve = {c: parse_decimal(raw(c)) for c in ("pu_par", "vna", "juros")} | {"prazo_remanescente": parse_int(raw("prazo_remanescente"))}
    if kind == "curve":
        curve |= {"flag_status": raw("flag_status").cast("string"), "data_ultima_atualizacao": date10(raw("data_ultima_atualizacao"))}
    return curve


def _price_struct(kind: str, at: str = "") -> Column:
    return F.struct(*[c.alias(out) for out, c in _price_columns(kind, at).items()])


def consolidate_history(
    chart: DataFrame, curve: DataFrame, prices: DataFrame, last: DataFrame, key: str = "ticker_deb", seq: str = "seq"
) -> DataFrame:
    """MRG-5: one row per instrument and date from four payloads, column by column.

    Within a payload the last row of a date wins (``seq`` is its position); across
    payloads each column has its own order of preference. The four frames are
    stacked and meet in a single grouped aggregate: one shuffle, shrunk map-side.
    """
    stacked = None
    for kind, frame in {"chart": chart, "curve": curve, "prices": prices, "last": last}.items():
        rows = frame.select(
            F.col(key), date10(PRICE_DATES[kind]).alias("data_referencia"), F.col(seq).alias("_seq"), _price_struct(kind).alias(kind)
        )
        stacked = rows if stacked is None else stacked.unionByName(rows, allowMissingColumns=True)
    return _consolidated_days(stacked, key)


def consolidate_price_rows(rows: DataFrame, key: str = "ticker_deb") -> DataFrame:
    """MRG-5 over the tagged union of all payloads (``sources.market.price_rows``): its input is read once."""
    dates = F.coalesce(*[F.col(f"{kind}.{c}") for kind, c in PRICE_DATES.items()])
    structs = [F.when(F.col("kind") == kind, _price_struct(kind, f"{kind}.")).alias(kind) for kind in PRICE_DATES]
    return _consolidated_days(rows.select(key, date10(dates).alias("data_referencia"), F.col("seq").alias("_seq"), *structs), key)


def _consolidated_days(stacked: DataFrame, key: str) -> DataFrame:
    def final(source: str) -> Column:
        return F.max_by(source, F.when(F.col(source).isNotNull(), F.col("_seq"))).alias(source)

    def first_known(source: str, field: str) -> Column:
        value = F.col(f"{source}.{field}")
        return F.min_by(value, F.when(value.isNotNull(), F.col("_seq")))

    dated = stacked.where(F.coalesce("data_referencia", F.lit("")) != "")
    grouped = dated.groupBy(key, "data_referencia").agg(
        final("chart"), final("curve"), final("prices"), final("last"),
        first_known("curve", "pu_par").alias("_curve_pu"),
        first_known("prices", "pu_indicativo").alias("_price_pu"),
        first_known("prices", "data_ultima_atualizacao").alias("_price_updated"),
    )
    return grouped.select(
        key, "data_referencia",
        F.coalesce("chart.pu_par", "_curve_pu", "last.pu_par").alias("pu_par"),
        F.coalesce("curve.vna", "last.vna").alias("vna"),
        F.coalesce("curve.juros", "last.juros").alias("juros"),
        F.coalesce("curve.prazo_remanescente", "last.prazo_remanescente").alias("prazo_remanescente"),
        F.coalesce("chart.pu_indicativo", "_price_pu").alias("pu_indicativo"),
        *[F.col(f"prices.{out}").alias(out) for out in [*PRICE_NUMBERS.values(), *PRICE_TEXTS.values()]],
        *[F.lit(None).cast(kind).alias(c) for c, kind in NEVER_FILLED.items()],
        F.col("curve.flag_status").alias("flag_status"),
        F.coalesce("curve.data_ultima_atualizacao", "_price_updated").alias("data_ultima_atualizacao"),
    )


def merge_fill(base: DataFrame, new: DataFrame, level: str = "account") -> DataFrame:
    """MRG-6: rows of ``new`` fill what ``base`` lacks and change nothing it has.

    ``account`` adds missing accounts; ``statement`` adds only statements that are
    missing as a whole. An existing period keeps its document type, and takes the
    new one where it has none (at account level). Both sides are stacked and
    ranked: a row of ``new`` stands where no row of ``base`` ranks before it.
    """
    keys = {"account": ACCOUNT_KEY, "statement": ACCOUNT_KEY[:3]}[level]
    period = ACCOUNT_KEY[:2]
    both = base.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    place = F.rank().over(Window.partitionBy(*keys).orderBy("_side"))
    kept = both.withColumn("_place", place).where("_place = 1")

    given = F.nullif("tipo_doc", F.lit(""))
    kinds = both.select(*period, "_side", "tipo_doc").distinct().groupBy(*period).agg(
        F.max(F.when(F.col("_side") == 0, given)).alias("_base"),
        F.max(F.when(F.col("_side") == 1, given)).alias("_new"),
        F.min("_side").alias("_first"),
    )
    mine, in_base = F.col("_side") == 0, F.col("_first") == 0
    if level == "account":
        label = F.when(mine, F.coalesce(given, "_new", "tipo_doc")).otherwise(F.coalesce("_base", "tipo_doc"))
    else:
        label = F.when(~mine & in_base, F.col("_base")).otherwise(F.col("tipo_doc"))
    return kept.join(kinds, period).withColumn("tipo_doc", label).select(*base.columns)


def new_period_count(base: DataFrame, new: DataFrame, keys: Sequence[str] = ("cnpj", "data_ref")) -> DataFrame:
    """MRG-6: per issuer, how many periods only ``new`` has."""
    fresh = new.select(*keys).distinct().join(base.select(*keys).distinct(), list(keys), "left_anti")
    return fresh.groupBy(keys[0]).agg(F.count(F.lit(1)).alias("new_periods"))


def merge_history(
    old: DataFrame, new: DataFrame, keys: Sequence[str] = ("ticker_deb", "data_referencia"),
    sticky: Sequence[str] = ("taxa_indicativa",), order: Sequence[str] = (),
) -> DataFrame:
    """MRG-7: a new row replaces the old one of its date; sticky columns keep a known old value. Of repeated keys, the last by ``order``."""
    old = last_update_wins(old, keys, [c for c in order if c in old.columns])
    new = last_update_wins(new, keys, order).withColumn("_is_new", F.lit(True))
    joined = old.alias("o").join(new.alias("n"), null_safe("o", "n", keys), "full_outer")
    replaced = F.coalesce(F.col("n._is_new"), F.lit(False))

    def merged(c: str) -> Column:
        before, after = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c in keys:
            return F.coalesce(after, before).alias(c)
        if c in sticky:
            after = F.coalesce(after, before)
        return F.when(replaced, after).otherwise(before).alias(c)

    return joined.select(*[merged(c) for c in old.columns])


def build_identity(
    characteristics: DataFrame, registry: DataFrame, overrides: DataFrame | None = None, compat: bool = False
) -> DataFrame:
    """MRG-8: issuer identity per ticker: registry code, category, open or closed, and how it went."""
    named = characteristics.select(
        F.upper(strip("ticker")).alias("ticker"), blank_to_null("nome").alias("nome_emissor"), digits("cnpj").alias("cnpj")
    )
    match = resolve_registry(named, registry, overrides, compat=compat)
    cancelled = F.upper(F.coalesce("SIT", F.lit(""))).contains("CANCELAD")
    return named.join(match, "cnpj", "left").select(
        "ticker", "nome_emissor",
        F.nullif("cnpj", F.lit("")).alias("cnpj_emissor"),
        blank_to_null("CD_CVM").alias("cod_cvm"),
        blank_to_null("CATEG_REG").alias("categoria_cvm"),
        F.when(F.col("matched_by").isNull() | cancelled, "Fechado").otherwise("Aberto").alias("tipo_capital"),
        F.when(F.col("cnpj") == "", "ERRO_ANBIMA_SEM_CNPJ").otherwise("SUCESSO").alias("status"),
    )


def resolve_missing_codes(issuers: DataFrame, registry: DataFrame, compat: bool = True) -> DataFrame:
    """MRG-8, first generation: only issuers without a code are looked up; a match opens them, a miss closes them."""
    open_ended = F.coalesce(blank_to_null("cod_cvm"), F.lit("")) == ""
    match = resolve_registry(issuers.where(open_ended), registry, compat=compat).select(
        "cnpj", strip("CD_CVM").alias("_code"), F.coalesce("CATEG_REG", F.lit("")).alias("_category")
    )
    joined = issuers.withColumn("cnpj", digits("cnpj")).join(match, "cnpj", "left")
    found = open_ended & F.col("_code").isNotNull()
    return joined.select(
        *[
            F.when(found, F.col("_code")).otherwise(F.col("cod_cvm")).alias(c) if c == "cod_cvm"
            else F.when(found, F.col("_category")).otherwise(F.col("categoria")).alias(c) if c == "categoria"
            else F.when(found, "Aberto").when(open_ended, "Fechado").otherwise(F.col(c)).alias(c) if c == "tipo_capital"
            else F.col(c)
            for c in issuers.columns
        ]
    )
