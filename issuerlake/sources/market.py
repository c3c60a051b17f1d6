"""Bond characteristics, schedules and daily prices (SRC-5..8, PRJ-11..13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuerlake.functions.cleaning import (
    date10, digits, parse_date, parse_decimal, parse_int, parse_remuneration, tenor_years, unit_price,
)
from issuerlake.sources.seeds import text_schema

_PARTY = text_schema("nome", "razao_social")
CHARACTERISTICS = T.StructType([
    *text_schema("isin", "numero_serie", "data_vencimento", "remuneracao", "taxa_emissao", "volume").fields,
    T.StructField("lei", T.VariantType()),
    T.StructField("indexador", T.VariantType()),
    T.StructField("emissao", T.StructType([
        *text_schema(
            "numero_emissao", "data_emissao", "volume", "quantidade_emitida", "garantia", "banco_mandatario"
        ).fields,
        T.StructField("emissor", text_schema("nome", "cnpj")),
        T.StructField("coordenador_lider", _PARTY),
        T.StructField("agente_fiduciario", _PARTY),
    ])),
])

EVENT = T.StructType([
    *text_schema("data_evento", "data_base", "data_liquidacao", "evento", "evento_arc", "taxa", "valor").fields,
    T.StructField("status", T.VariantType()),
])

CHART_ROW = text_schema("data", "valor_pu_historico", "valor_pu_indicativo")
CURVE_ROW = text_schema(
    "data_referencia", "pu_par", "vna", "juros", "prazo_remanescente", "flag_status", "data_ultima_atualizacao"
)
PRICE_ROW = text_schema(
    "data_referencia", "taxa_indicativa", "taxa_compra", "taxa_venda", "duration", "percentual_pu_par",
    "percentual_vne", "desvio_padrao", "reune", "intervalo_indicativo_minimo", "intervalo_indicativo_maximo",
    "data_referencia_ntnb", "pu_indicativo_status", "taxa_indicativa_status", "percentual_reune",
    "data_ultima_atualizacao", "pu_indicativo",
)
LAST_ROW = text_schema("data_referencia", "pu_par", "vna", "juros", "prazo_remanescente")

HISTORY_NUMBERS = [
    "pu_par", "vna", "juros", "pu_indicativo", "taxa_indicativa", "taxa_compra", "taxa_venda", "duration_dias_uteis",
    "desvio_padrao", "percentual_pu_par", "percentual_vne", "intervalo_indicativo_min", "intervalo_indicativo_max",
    "spread_indicativo", "volume_financeiro", "taxa_media_negocios", "pu_medio_negocios", "percentual_reune",
]
HISTORY_INTEGERS = ["prazo_remanescente", "quantidade_negocios", "quantidade_titulos"]
HISTORY_TEXTS = [
    "referencia_ntnb", "reune", "pu_indicativo_status", "taxa_indicativa_status", "flag_status",
    "data_ultima_atualizacao",
]
HISTORY_ROW = text_schema("data_referencia", *HISTORY_NUMBERS, *HISTORY_INTEGERS, *HISTORY_TEXTS)


def folder_key() -> Column:
    """The name of the folder a file lies in."""
    return F.regexp_extract(F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")), r"([^/]+)/[^/]+$", 1)


def _whole_files(spark: SparkSession, path: str, key: str, pattern: str) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.text(path, wholetext=True).select(folder_key().alias(key), "value")


def _list_or_field(field: str, row: T.StructType, text: str = "value") -> Column:
    """Items of a bare JSON array, or of ``field`` of a JSON object."""
    bare = F.ltrim(F.col(text)).startswith("[")
    listed = F.from_json(F.when(bare, F.col(text)), T.ArrayType(row))
    wrapped = F.from_json(F.when(~bare, F.col(text)), T.StructType([T.StructField(field, T.ArrayType(row))]))[field]
    return F.coalesce(listed, wrapped)


def parse_characteristics(payloads: DataFrame, key: str = "ticker", text: str = "value") -> DataFrame:
    """SRC-5: JSON texts of characteristics as raw rows.

    ``indexador`` and ``lei`` may be objects or plain values and are kept as VARIANT.
    """
    return payloads.select(key, F.from_json(text, CHARACTERISTICS).alias("_c")).select(key, "_c.*")


def read_characteristics(spark: SparkSession, path: str, key: str = "ticker") -> DataFrame:
    """SRC-5: raw characteristics, one file per instrument folder."""
    return parse_characteristics(_whole_files(spark, path, key, "caracteristicas.json"), key)


def parse_schedule(payloads: DataFrame, key: str = "ticker", text: str = "value") -> DataFrame:
    """SRC-6: raw events of JSON texts, objects with ``content`` or bare arrays, with their position."""
    return payloads.select(key, F.posexplode(_list_or_field("content", EVENT, text)).alias("seq", "_e")).select(key, "seq", "_e.*")


def read_schedule(spark: SparkSession, path: str, key: str = "ticker") -> DataFrame:
    """SRC-6: raw events, one file per instrument folder."""
    return parse_schedule(_whole_files(spark, path, key, "agenda.json"), key)


# File of each price payload, its field, and the kind of its rows.
_CHART_FILE, _CURVE_FILE, _PRICES_FILE = "grafico_pu.json", "pu_historico.json", "precos.json"
PRICE_KINDS = {
    "chart": (_CHART_FILE, "pus", CHART_ROW), "curve": (_CURVE_FILE, "content", CURVE_ROW),
    "prices": (_PRICES_FILE, "precos", PRICE_ROW), "last": (_PRICES_FILE, "pu_historico", LAST_ROW),
}


def price_rows(payloads: DataFrame, key: str = "ticker_deb", name: str = "name", text: str = "value") -> DataFrame:
    """SRC-7: rows of all price payloads as one tagged union: ``key, kind, seq`` and a struct per kind, null but for the row's own.

    Every text is parsed once, by a schema of all payload shapes, and exploded once;
    ``name`` (a file name) tells which fields count. ``seq`` is the position in its list.
    """
    shapes = [T.StructField(field, row if kind == "last" else T.ArrayType(row)) for kind, (_, field, row) in PRICE_KINDS.items()]
    parsed = payloads.select(key, name, F.from_json(text, T.StructType(shapes)).alias("_p"))
    layout = "array<struct<kind: string, seq: int, " + ", ".join(f"{kind}: {row.simpleString()}" for kind, (_, _, row) in PRICE_KINDS.items()) + ">>"

    def tagged(kind: str, row: Column, seq: Column) -> Column:
        fields = [(row if other == kind else F.lit(None).cast(shape)).alias(other) for other, (_, _, shape) in PRICE_KINDS.items()]
        return F.struct(F.lit(kind).alias("kind"), seq.cast("int").alias("seq"), *fields)

    def each(kind: str):
        return lambda row, seq: tagged(kind, row, seq)

    lists = []
    for kind, (file, field, _) in PRICE_KINDS.items():
        here = (F.col(name) == file) & F.col(f"_p.{field}").isNotNull()
        if kind == "last":
            rows = F.array(tagged(kind, F.col(f"_p.{field}"), F.lit(0)))
        else:
            rows = F.transform(f"_p.{field}", each(kind))
        lists.append(F.coalesce(F.when(here, rows).cast(layout), F.array().cast(layout)))
    return parsed.select(key, F.explode(F.concat(*lists)).alias("_r")).select(key, "_r.*")


def read_price_rows(spark: SparkSession, path: str, key: str = "ticker_deb") -> DataFrame:
    """SRC-7: the tagged rows of all price payload files under ``path``; one scan, each file read once."""
    names = sorted({file for file, _, _ in PRICE_KINDS.values()})
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "{" + ",".join(names) + "}")
    file = F.element_at(F.split("_metadata.file_path", "/"), -1).alias("name")
    return price_rows(reader.text(path, wholetext=True).select(folder_key().alias(key), file, "value"), key)


def read_prices(spark: SparkSession, path: str, key: str = "ticker_deb") -> dict[str, DataFrame]:
    """SRC-7: the four kinds of rows as frames of their own, with their position. A job that needs all four takes ``read_price_rows``."""
    rows = read_price_rows(spark, path, key)
    return {kind: rows.where(F.col("kind") == kind).select(key, "seq", f"{kind}.*") for kind in PRICE_KINDS}


def parse_history(payloads: DataFrame, key: str = "ticker_deb", text: str = "value") -> DataFrame:
    """SRC-8: consolidated history rows of JSON texts, bare arrays or objects with ``dados``."""
    return payloads.select(key, F.explode(_list_or_field("dados", HISTORY_ROW, text)).alias("_r")).select(key, "_r.*")


def read_history(spark: SparkSession, path: str, key: str = "ticker_deb") -> DataFrame:
    """SRC-8: consolidated history, one file per instrument folder."""
    return parse_history(_whole_files(spark, path, key, "historico_diario.json"), key)


def _filled(c: str) -> Column:
    """Text that is neither blank nor a plain zero."""
    return F.when(~F.coalesce(F.trim(c), F.lit("")).rlike(r"^(0(\.0*)?)?$"), F.col(c))


def variant_text(c: str, path: str = "$") -> Column:
    return F.try_variant_get(F.col(c), path, "string")


def variant_is_set(c: str) -> Column:
    """Whether a JSON value counts as given: not null, false, zero or empty."""
    return ~F.coalesce(F.to_json(F.col(c)), F.lit("null")).isin("null", "false", "0", "0.0", '""', "[]", "{}")


def variant_name(c: str, field: str) -> Column:
    """``field`` of an object, or the value itself when it is plain."""
    is_object = F.to_json(F.col(c)).startswith("{")
    return F.when(is_object, variant_text(c, f"$.{field}")).otherwise(variant_text(c))


def clean_characteristics(df: DataFrame, key: str = "ticker") -> DataFrame:
    """PRJ-11: one typed row per instrument."""
    indexer = F.when(variant_is_set("indexador"), variant_name("indexador", "nome"))
    volume = parse_decimal(F.coalesce(_filled("emissao.volume"), F.col("volume")))
    quantity = parse_int("emissao.quantidade_emitida")
    issued, due = F.col("emissao.data_emissao"), F.col("data_vencimento")
    rate = F.col("_pay.rate")
    return df.withColumn("_pay", parse_remuneration(F.coalesce("remuneracao", F.lit("")), indexer)).select(
        F.upper(F.trim(key)).alias("ticker_deb"),
        F.nullif(digits("emissao.emissor.cnpj"), F.lit("")).alias("cnpj"),
        F.col("emissao.emissor.nome").alias("nome_emissor"),
        F.lit("debenture").alias("tipo"),
        "isin",
        F.col("numero_serie").alias("serie"),
        parse_int("emissao.numero_emissao").alias("numero_emissao"),
        parse_date(issued).alias("data_emissao"),
        parse_date(due).alias("data_vencimento"),
        tenor_years(F.try_to_date(issued, "yyyy-MM-dd"), F.try_to_date(due, "yyyy-MM-dd")).alias("prazo_anos"),
        volume.alias("volume_emissao"),
        unit_price(volume, quantity).alias("valor_unitario_emissao"),
        quantity.alias("quantidade_debentures"),
        F.col("_pay.indexer").alias("indexador"),
        F.coalesce(F.when(rate != 0, rate), parse_decimal("taxa_emissao")).alias("taxa_prefixada"),
        F.col("emissao.garantia").alias("especie"),
        F.when(variant_is_set("lei"), "Sim").otherwise("Não").alias("lei_incentivo"),
        F.coalesce(F.nullif("emissao.coordenador_lider.nome", F.lit("")), "emissao.coordenador_lider.razao_social").alias("banco_coordenador"),
        F.coalesce(F.nullif("emissao.agente_fiduciario.nome", F.lit("")), "emissao.agente_fiduciario.razao_social").alias("agente_fiduciario"),
        F.col("emissao.banco_mandatario").alias("banco_liquidante"),
        F.lit("ativo").alias("status"),
    )


def clean_schedule(df: DataFrame, key: str = "ticker") -> DataFrame:
    """PRJ-12: dated events; ``status`` is an object with its group, or a plain value."""
    is_object = F.coalesce(F.to_json(F.col("status")).startswith("{"), F.lit(False))
    return df.where(F.coalesce("data_evento", F.lit("")) != "").select(
        F.upper(F.trim(key)).alias("ticker_deb"),
        parse_date("data_evento").alias("data_evento"),
        parse_date("data_base").alias("data_base"),
        parse_date("data_liquidacao").alias("data_liquidacao"),
        "evento", "evento_arc",
        parse_decimal("taxa").alias("taxa"),
        parse_decimal("valor").alias("valor"),
        variant_name("status", "status").alias("status"),
        F.when(is_object, variant_text("status", "$.grupo_status")).alias("grupo_status"),
    )


def clean_history(df: DataFrame, key: str = "ticker_deb") -> DataFrame:
    """PRJ-13: dated history rows with typed columns."""
    return df.where(F.coalesce("data_referencia", F.lit("")) != "").select(
        F.upper(F.trim(key)).alias("ticker_deb"),
        parse_date("data_referencia").alias("data_referencia"),
        *[parse_decimal(c).alias(c) for c in HISTORY_NUMBERS],
        *[parse_int(c).alias(c) for c in HISTORY_INTEGERS],
        *[date10(c).alias(c) if c == "data_ultima_atualizacao" else F.col(c) for c in HISTORY_TEXTS],
    )
