"""Joins, look-ups and set operations (JOIN-1..11, SET-1..3).

No join carries a broadcast hint. The planner broadcasts a side whose measured
size is under ``spark.sql.autoBroadcastJoinThreshold``; beyond it a sort-merge
join runs, and skewed partitions of it are split at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuerlake.functions.cleaning import blank_to_null, digits, parse_decimal, strip
from issuerlake.operators.ordering import ties, up
from issuerlake.operators.tables import last_update_wins
from issuerlake.operators.windows import dedupe

PORTFOLIO_COLUMNS = [
    "ticker_deb", "nome_emissor", "grupo_economico", "setor", "tipo_capital", "tipo", "data_emissao",
    "data_vencimento", "volume_emissao", "indexador", "spread_emissao", "especie", "rating_emissao",
    "agencia_rating", "perspectiva_rating", "lei_incentivo", "agente_fiduciario", "status",
]
ISSUER_INSTRUMENT_COLUMNS = [
    "cnpj", "nome", "grupo_economico", "tipo_capital", "ticker_deb", "status", "indexador",
    "spread_emissao", "data_vencimento", "rating_emissao", "agencia_rating", "lei_incentivo",
]
PAYMENT_COLUMNS = [
    "data_evento", "ticker_deb", "emissor", "grupo_economico", "evento", "evento_arc", "taxa", "valor",
    "status", "dias_para_evento",
]


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def active_portfolio(instruments: DataFrame, issuers: DataFrame, status: str = "ativo") -> DataFrame:
    """JOIN-1: active instruments with issuer attributes, by maturity."""
    side = issuers.select(*_present(issuers, ["cnpj", "grupo_economico", "setor", "tipo_capital"]))
    out = instruments.where(F.col("status") == status).join(side, "cnpj")
    rows = out.select(*_present(out, PORTFOLIO_COLUMNS))
    return rows.orderBy(up("data_vencimento"), *ties(rows, ["data_vencimento"]))


def upcoming_payments(
    schedule: DataFrame, instruments: DataFrame, issuers: DataFrame, as_of: Column, status: str = "Previsto"
) -> DataFrame:
    """JOIN-2: planned events from ``as_of`` on, with the issuer and the days left."""
    due = schedule.where((F.col("data_evento") >= as_of) & (F.col("status") == status)).drop("cnpj")
    out = (
        due.join(instruments.select("ticker_deb", "cnpj"), "ticker_deb")
        .join(issuers.select("cnpj", F.col("nome").alias("emissor"), "grupo_economico"), "cnpj")
        .withColumn("dias_para_evento", F.datediff("data_evento", as_of))
    )
    rows = out.select(*_present(out, PAYMENT_COLUMNS))
    return rows.orderBy(up("data_evento"), *ties(rows, ["data_evento"]))


def issuer_instruments(issuers: DataFrame, instruments: DataFrame) -> DataFrame:
    """JOIN-3: every issuer with each of its instruments, by name and maturity."""
    out = issuers.select(*_present(issuers, ["cnpj", "nome", "grupo_economico", "tipo_capital"])).join(
        instruments.drop("nome", "grupo_economico", "tipo_capital"), "cnpj"
    )
    return out.select(*_present(out, ISSUER_INSTRUMENT_COLUMNS)).orderBy(up("nome"), up("data_vencimento"))


def active_in_registry(compat: bool = False) -> Column:
    """Whether a registry row is in operation.

    The strict form matches whole words. ``compat`` matches substrings, so that
    INATIVO and PRÉ-OPERACIONAL count as active too.
    """
    phase = F.upper(F.coalesce(F.col("SIT"), F.lit("")))
    standing = F.upper(F.coalesce(F.col("SIT_REG"), F.lit("")))
    if compat:
        return phase.contains("OPERACIONAL") | standing.contains("ATIVO")
    return phase.rlike(r"(?<![\p{L}\-])OPERACIONAL") | standing.rlike(r"(?<!\p{L})ATIVO")


def resolve_registry(
    ids: DataFrame,
    registry: DataFrame,
    overrides: DataFrame | None = None,
    order: str = "file_order",
    compat: bool = False,
) -> DataFrame:
    """JOIN-4: the registry row of each ``cnpj``.

    An override wins and takes the first row of its code, or a made-up row where
    the code is not registered. Otherwise an active row comes before the first
    one. The registry is read once and cut to one row per id and per code before it is joined.
    """
    wanted = ids.select(digits("cnpj").alias("cnpj")).where("cnpj <> ''").distinct()
    fields = ["CD_CVM", "CATEG_REG", "SIT", "SIT_REG"]
    idle = F.when(active_in_registry(compat), 0).otherwise(1)
    by_id = F.struct(F.lit("cnpj").alias("_kind"), digits("CNPJ_CIA").alias("_key"), idle.alias("_rank"))
    by_code = F.struct(F.lit("code").alias("_kind"), strip("CD_CVM").alias("_key"), F.lit(0).alias("_rank"))
    # A row is the candidate of its id and of its code; one ranking settles both.
    candidates = F.array(by_id) if overrides is None else F.array(by_id, by_code)
    tagged = registry.select(*fields, F.col(order).alias("_order"), F.inline(candidates)).where(F.col("_key").isNotNull())
    best = dedupe(tagged, ["_kind", "_key"], order=["_rank", "_order"]).select("_kind", "_key", F.struct(*fields).alias("_row"))
    forced, code = F.lit(False), F.lit(None).cast("string")
    if overrides is not None:
        corrected = overrides.select(digits("cnpj").alias("cnpj"), F.col("cod_cvm").cast("string").alias("_code"), F.lit(True).alias("_forced"))
        wanted = wanted.join(corrected, "cnpj", "left")
        forced, code = F.coalesce("_forced", F.lit(False)), F.col("_code")
    asked = wanted.select(
        "cnpj", forced.alias("_is_forced"), F.when(forced, "code").otherwise("cnpj").alias("_kind"), F.when(forced, code).otherwise(F.col("cnpj")).alias("_key")
    )
    made_up = F.struct(
        F.col("_key").alias("CD_CVM"),
        F.lit("FORCED_OVERRIDE").alias("CATEG_REG"),
        F.lit(None).cast("string").alias("SIT"),
        F.lit(None).cast("string").alias("SIT_REG"),
    )
    met = asked.join(best, ["_kind", "_key"], "left").where("_row is not null or _is_forced")
    return met.select(
        "cnpj", F.coalesce("_row", made_up).alias("_row"), F.when(F.col("_is_forced"), "override").otherwise("cnpj").alias("matched_by")
    ).select("cnpj", "_row.*", "matched_by")


def fill_issuer(
    instruments: DataFrame, characteristics: DataFrame, key: str = "ticker", col: str = "cnpj_emissor"
) -> DataFrame:
    """JOIN-5: missing issuer ids taken from the characteristics; existing ones stay."""
    found = characteristics.select(F.col(key), F.nullif(digits("cnpj"), F.lit("")).alias("_found"))
    found = found.groupBy(key).agg(F.max("_found").alias("_found"))
    given = F.when(digits(col) != "", F.col(col))
    return instruments.join(found, key, "left").withColumn(col, F.coalesce(given, F.col("_found"))).drop("_found")


def discover_issuers(characteristics: DataFrame, issuers: DataFrame) -> DataFrame:
    """JOIN-6: issuers named by characteristics and absent from the register, with default attributes."""
    found = (
        characteristics.select(digits("cnpj").alias("cnpj"), blank_to_null("nome").alias("nome"))
        .where((F.col("cnpj") != "") & F.col("nome").isNotNull())
        .groupBy("cnpj").agg(F.max("nome").alias("nome"))
    )
    known = issuers.select(digits("cnpj").alias("cnpj")).distinct()
    return found.join(known, "cnpj", "left_anti").select(
        "nome", "cnpj",
        F.lit("").alias("cod_cvm"),
        F.lit("Fechado").alias("tipo_capital"),
        F.lit("").alias("ticker_acao"),
        F.lit("").alias("categoria"),
        F.lit("Descoberto via ANBIMA").alias("observacao"),
    )


def new_documents(
    documents: DataFrame, manifest: DataFrame, keys: Sequence[str] = ("cnpj", "hash_md5"), force: bool = False
) -> DataFrame:
    """JOIN-7: documents whose content is not yet in the manifest; ``force`` keeps all."""
    if force:
        return documents
    return documents.join(manifest.select(*keys).distinct(), list(keys), "left_anti")


def document_intake(
    documents: DataFrame, manifest: DataFrame, owner: str = "cnpj", keys: Sequence[str] = ("cnpj", "hash_md5")
) -> DataFrame:
    """JOIN-7: per owner, how many documents came in, are new, and are skipped."""
    seen = manifest.select(*keys).distinct().withColumn("_seen", F.lit(1))
    # Copies share their content key, so they are counted before the join spreads them.
    counted = documents.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counted.join(seen, list(keys), "left").groupBy(owner).agg(
        F.sum("_n").alias("received"),
        F.sum(F.when(F.col("_seen").isNull(), F.col("_n")).otherwise(0)).alias("new"),
        F.sum(F.when(F.col("_seen").isNotNull(), F.col("_n")).otherwise(0)).alias("skipped"),
    )


def flag_member(df: DataFrame, other: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """JOIN-8: whether the row's key also occurs in the other frame."""
    present = other.select(*keys).distinct().withColumn("_present", F.lit(True))
    return df.join(present, list(keys), "left").withColumn(flag, F.col("_present").isNotNull()).drop("_present")


def attach(df: DataFrame, other: DataFrame, keys: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """JOIN-9: columns of a keyed frame for every row at once, instead of one look-up per key; of repeated keys, the greatest row."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.join(last_update_wins(other.select(*keys, *columns), keys), keys, "left")


def inject_rates(
    history: DataFrame, rates: DataFrame, keys: Sequence[str] = ("data_referencia",), rate: str = "taxa_indicativa",
    order: Sequence[str] = (),
) -> DataFrame:
    """JOIN-10: looked-up rates by date, decimal commas read; dates without one keep what they had. Of several rates, the last by ``order``."""
    found = last_update_wins(rates.select(*keys, *order, parse_decimal(rate).alias("_rate")), keys, order).select(*keys, "_rate")
    return history.join(found, list(keys), "left").withColumn(rate, F.coalesce("_rate", rate)).drop("_rate")


def map_owner(keys: DataFrame, emissions: DataFrame, key: str = "ticker", owner: str = "cnpj_emissor") -> DataFrame:
    """JOIN-11: the owner of each key; ``linked`` is false where none is known."""
    owners = (
        emissions.select(strip(key).alias(key), F.nullif(digits(owner), F.lit("")).alias(owner))
        .where(F.col(key) != "").groupBy(key).agg(F.max(owner).alias(owner))
    )
    return keys.join(owners, key, "left").withColumn("linked", F.col(owner).isNotNull())


def owner_keys(emissions: DataFrame, key: str = "ticker", owner: str = "cnpj_emissor") -> DataFrame:
    """JOIN-11: one row per owner and key. Left flat: an owner may hold any number of keys."""
    return (
        emissions.select(digits(owner).alias(owner), strip(key).alias(key))
        .where((F.col(owner) != "") & (F.col(key) != "")).distinct()
    )


def union_ranked(*frames: DataFrame, rank: str = "branch_rank") -> DataFrame:
    """SET-1: branches one after another; the rank column remembers which."""
    tagged = [frame.withColumn(rank, F.lit(i)) for i, frame in enumerate(frames)]
    out = tagged[0]
    for frame in tagged[1:]:
        out = out.unionByName(frame)
    return out


def set_compare(a: DataFrame, b: DataFrame, key: str | None, value: str) -> DataFrame:
    """SET-2: sizes of two sets, both differences and the intersection, per key or overall.

    Values are grouped first, so a key that holds most of the rows is spread by value.
    """
    keys = [key] if key else []
    sides = a.select(*keys, value, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*keys, value, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    members = sides.groupBy(*keys, value).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    totals = [
        F.sum("_a").alias("n_a"),
        F.sum("_b").alias("n_b"),
        F.sum(F.when((F.col("_a") == 1) & (F.col("_b") == 0), 1).otherwise(0)).alias("only_a"),
        F.sum(F.when((F.col("_a") == 0) & (F.col("_b") == 1), 1).otherwise(0)).alias("only_b"),
        F.sum(F.when((F.col("_a") == 1) & (F.col("_b") == 1), 1).otherwise(0)).alias("common"),
    ]
    return members.groupBy(*keys).agg(*totals)


def contains_all(df: DataFrame, wanted: DataFrame, col: str) -> DataFrame:
    """SET-3: one row telling how many wanted values there are, how many are missing, and whether none is."""
    found = df.select(col).distinct().withColumn("_found", F.lit(1))
    return (
        wanted.select(col).distinct().join(found, col, "left")
        .agg(
            F.count(F.lit(1)).alias("n_wanted"),
            F.count_if(F.col("_found").isNull()).alias("n_missing"),
        )
        .withColumn("all_present", F.col("n_missing") == 0)
    )
