"""Latest rows, de-duplication, pages, top-N and search (WIN-1..7, SRT-1..2).

Each ``row_number() <= n`` below is planned with a group limit on both sides of
the shuffle: every task keeps at most ``n`` rows of a key before it sends them,
so a key holding most of the data does not gather in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuerlake.functions.cleaning import digits, strip
from issuerlake.functions.display import fold, join_parts
from issuerlake.operators.ordering import Order, down, null_safe, order_columns, ties, up
from issuerlake.session import ensure_checkpoint_dir, scratch_folder, shuffles_end

# What each kind of match adds to the score of an option.
EXACT = {"primary": 120, "value": 115, "secondary": 105}
PREFIX = {"primary": 90, "value": 82, "secondary": 74}
INSIDE = {"primary": 64, "secondary": 52, "value": 44}
SAME_KIND, NO_QUERY = 8, 10
KIND_OF_MODE = {"asset": "ativo", "issuer": "emissor"}


#: Ranks from which Spark plans no group limit (its default threshold).
UNLIMITED = 1000
#: Shares a key is ranked in first, from UNLIMITED on.
SHARES = 64


def top_rows(df: DataFrame, keys: Sequence[str], order: Order, n: int, rank: str | None = None) -> DataFrame:
    """First ``n`` rows of each key, numbered in ``rank`` if named.

    Below UNLIMITED Spark ranks in the map tasks and again after the shuffle. From there
    on the same is written out: each of a key's SHARES (by input partition) is ranked and
    cut to ``n`` in a task of its own, then what is left of the key is ranked.
    """
    name = rank or "_rank"
    ordered = order_columns(order)
    if n >= UNLIMITED:
        shares = df.withColumn("_share", F.pmod(F.spark_partition_id(), F.lit(SHARES)))
        place = F.row_number().over(Window.partitionBy(*keys, "_share").orderBy(*ordered))
        df = shares.withColumn("_place", place).where(F.col("_place") <= n).drop("_place", "_share")
    window = Window.partitionBy(*keys).orderBy(*ordered)
    out = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def latest_per(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """WIN-1: the first row of each key in the given order, which must break every tie."""
    return top_rows(df, keys, order, 1)


def dedupe(df: DataFrame, keys: Sequence[str], order: Order, keep: str = "first") -> DataFrame:
    """WIN-2: first or last occurrence of each key; ``order`` is the order of occurrence."""
    if keep == "last":
        order = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order]
    elif keep != "first":
        raise ValueError(f"keep must be first or last, not {keep}")
    return top_rows(df, keys, order, 1)


def clamp(offset: int, limit: int) -> tuple[int, int]:
    return max(offset, 0), max(limit, 1)


def page(df: DataFrame, order: Order, offset: int = 0, limit: int = 10) -> DataFrame:
    """WIN-3: one page of the whole frame; top-k per task, no full sort."""
    offset, limit = clamp(offset, limit)
    return df.orderBy(*order_columns(order)).offset(offset).limit(limit)


def _beyond(c: str, way: Callable, value: object) -> Column:
    """Whether a column comes after a value in its direction, nulls last going up and first going down."""
    if way is up:
        return F.lit(False) if value is None else (F.col(c) > F.lit(value)) | F.col(c).isNull()
    return F.col(c).isNotNull() if value is None else F.col(c) < F.lit(value)


def page_after(df: DataFrame, order: Sequence[tuple[str, Callable]], after: Sequence[object] | None = None, limit: int = 10) -> DataFrame:
    """WIN-3 by key: the ``limit`` rows that follow the row with the values ``after`` (the first page without).

    ``order`` names columns with their direction, ``up`` or ``down``, and must break
    every tie. However deep the page, a task keeps ``limit`` rows.
    """
    if after is not None:
        if len(after) != len(order):
            raise ValueError("after has a value for each column of the order")
        later, same = F.lit(False), F.lit(True)
        for (c, way), value in zip(order, after):
            later = later | (same & F.coalesce(_beyond(c, way, value), F.lit(False)))
            same = same & F.col(c).eqNullSafe(F.lit(value))
        df = df.where(later)
    return df.orderBy(*[way(c) for c, way in order]).limit(clamp(0, limit)[1])


def deep_page(df: DataFrame, order: Order, offset: int, limit: int = 10) -> DataFrame:
    """WIN-3 by number, at any depth: no task and no driver holds ``offset + limit`` rows.

    The frame is sorted over all tasks and checkpointed, partitions are counted (one
    number each), and only rows of the partitions the page overlaps are kept.
    """
    offset, limit = clamp(offset, limit)
    ensure_checkpoint_dir(df.sparkSession)
    placed = df.orderBy(*order_columns(order)).checkpoint().select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id"))
    counts = {r["_part"]: r["n"] for r in placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    inside, before = F.lit(False), 0
    for part in sorted(counts):
        low, high = max(offset - before, 0), min(offset + limit - before, counts[part])
        if low < high:
            inside = inside | ((F.col("_part") == part) & F.col("_id").between(F.lit((part << 33) + low), F.lit((part << 33) + high - 1)))
        before += counts[part]
    return placed.where(inside).drop("_part", "_id").orderBy(*order_columns(order))


def _placed(df: DataFrame) -> DataFrame:
    """A sorted frame, written once, with each row's partition and its number there.

    Written as compressed Parquet, so that later steps read the columns they need, and the sort's shuffle files go
    with the write; types that Parquet has no form for are checkpointed.
    """
    spark = df.sparkSession
    numbered = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    if "interval" in df.schema.simpleString() or "void" in df.schema.simpleString():
        return df.checkpoint().select("*", F.spark_partition_id().alias("_part"), numbered.alias("_at"))
    placed, path = df.select("*", F.spark_partition_id().alias("_part"), numbered.alias("_at")), scratch_folder(spark, "positions")
    with shuffles_end(spark):
        placed.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def positions(df: DataFrame, keys: Sequence[str], order: Order, name: str = "position") -> DataFrame:
    """Each row's place among the rows of its key, from 0, however many rows a key has.

    The frame is sorted by key and order over all tasks and written, so a hot key
    is spread over as many tasks as its rows need, if ``order`` breaks ties. A row's place is its number in
    its partition, plus the rows of all partitions before, minus where its key begins.
    What is joined to the rows has one row per key and partition; the driver gets a count per partition. Null keys are a key.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    placed = _placed(df.orderBy(*[up(k) for k in keys], *order_columns(order)))
    before, offsets = 0, []
    for row in placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect():
        offsets.append((row["_part"], before))
        before += row["n"]
    first = placed.groupBy(*keys, "_part").agg(F.min("_at").alias("_at")).join(spark.createDataFrame(offsets, "_part int, _before long"), "_part")
    begins = first.groupBy(*keys).agg(
        F.min(F.col("_before") + F.col("_at")).alias("_begin"), F.collect_list(F.struct("_part", "_before")).alias("_parts")
    )
    shifts = begins.select(*keys, "_begin", F.inline("_parts")).select(*keys, "_part", (F.col("_before") - F.col("_begin")).alias("_shift"))
    met = placed.alias("r").join(shifts.alias("s"), null_safe("r", "s", [*keys, "_part"]))
    return met.select(*[F.col(f"r.{c}") for c in df.columns], (F.col("_at") + F.col("_shift")).alias(name))


def page_info(df: DataFrame, offset: int = 0, limit: int = 10) -> DataFrame:
    """WIN-3: total, offset, limit and whether rows follow the page."""
    offset, limit = clamp(offset, limit)
    return df.agg(F.count(F.lit(1)).alias("total")).select(
        "total",
        F.lit(offset).cast("long").alias("offset"),
        F.lit(limit).cast("long").alias("limit"),
        (F.lit(offset + limit) < F.col("total")).alias("has_more"),
    )


def page_per(df: DataFrame, keys: Sequence[str], order: Order, offset: int = 0, limit: int = 10) -> DataFrame:
    """WIN-3: the same page of every key."""
    offset, limit = clamp(offset, limit)
    return top_rows(df, keys, order, offset + limit, rank="position").where(F.col("position") > offset)


def top_n_per(df: DataFrame, keys: Sequence[str], order: Order, n: int) -> DataFrame:
    """WIN-4: first ``n`` rows of each key, with the key's total and whether more exist.

    The total is a grouped count joined back, so no window has to hold a whole key.
    """
    totals = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"))
    return (
        top_rows(df, keys, order, n, rank="position")
        .join(totals, list(keys))
        .withColumn("has_more", F.col("total") > n)
    )


def recent_jobs(df: DataFrame, n: int = 100, order: Order | None = None) -> DataFrame:
    """WIN-5: newest jobs."""
    return df.orderBy(*order_columns(order or [down("criado_em"), up("id")])).limit(n)


def _option_branches(instruments: DataFrame, issuers: DataFrame, query: str, limit: int):
    text = query.strip()
    prefix, number = text.upper(), "".join(ch for ch in text if ch in "0123456789")
    assets = instruments.select(
        F.upper(strip("ticker_deb")).alias("ticker"), "ticker_deb", "nome_emissor", "cnpj"
    )
    owners = issuers.select("cnpj", "nome", "ticker_acao")

    def first(df: DataFrame, condition: Column, *order: str) -> DataFrame:
        return df.where(condition).orderBy(*[up(c) for c in order]).limit(limit)

    def starts(col: str, value: str) -> Column:
        return F.upper(F.col(col).cast("string")).startswith(value)

    if not text:
        return [first(assets, F.lit(True), "ticker_deb", "cnpj")], []
    by_ticker = first(assets, starts("ticker_deb", prefix), "ticker_deb", "cnpj")
    if number:
        return (
            [by_ticker, first(assets, starts("cnpj", number), "ticker_deb", "cnpj")],
            [first(owners, starts("cnpj", number), "cnpj")],
        )
    return (
        [by_ticker, first(assets, starts("nome_emissor", prefix), "nome_emissor", "ticker_deb", "cnpj")],
        [
            first(owners, starts("ticker_acao", prefix), "ticker_acao", "cnpj"),
            first(owners, starts("nome", prefix), "nome", "cnpj"),
        ],
    )


def search_options(instruments: DataFrame, issuers: DataFrame, query: str, limit: int = 12) -> DataFrame:
    """WIN-6: options whose code, id or name starts with the query, instruments before issuers.

    Digits in the query switch to tax-id search. Prefixes are literal. Every
    branch is cut to ``limit`` rows by its own top-k, so the ranking at the end
    sees four small branches at most.
    """
    asset_branches, owner_branches = _option_branches(instruments, issuers, query, limit)
    options = []
    for i, branch in enumerate(asset_branches):
        name = F.coalesce(F.nullif("nome_emissor", F.lit("")), F.lit("Emissor sem nome"))
        rank = [up("nome_emissor")] if i == 1 and not any(ch.isdigit() for ch in query) else []
        options.append(branch.where(F.col("ticker") != "").select(
            F.concat(F.lit("ativo-"), "ticker").alias("id"),
            F.col("ticker").alias("value"),
            F.col("ticker").alias("primary"),
            join_parts(name, digits("cnpj")).alias("secondary"),
            F.lit("ativo").alias("tipo"),
            F.lit(i).alias("_branch"),
            F.row_number().over(Window.partitionBy(F.lit(i)).orderBy(*rank, up("ticker_deb"), up("cnpj"))).alias("_at"),
        ))
    for i, branch in enumerate(owner_branches, start=len(asset_branches)):
        cnpj, share = digits("cnpj"), F.upper(strip(F.coalesce("ticker_acao", F.lit(""))))
        by = "cnpj" if len(owner_branches) == 1 else ("ticker_acao" if i == len(asset_branches) else "nome")
        options.append(branch.where(cnpj != "").select(
            F.concat(F.lit("emissor-"), cnpj).alias("id"),
            F.when(share != "", share).otherwise(cnpj).alias("value"),
            F.coalesce(F.nullif(strip("nome"), F.lit("")), F.lit("Emissor sem nome")).alias("primary"),
            join_parts(cnpj, share).alias("secondary"),
            F.lit("emissor").alias("tipo"),
            F.lit(i).alias("_branch"),
            F.row_number().over(Window.partitionBy(F.lit(i)).orderBy(up(by), up("cnpj"))).alias("_at"),
        ))
    out = options[0]
    for branch in options[1:]:
        out = out.unionByName(branch)
    return dedupe(out, ["id"], ["_branch", "_at"]).orderBy("_branch", "_at").limit(limit).drop("_branch", "_at")


def with_score(df: DataFrame, query: str, mode: str = "asset") -> DataFrame:
    """WIN-7: relevance of each option: equality, prefix and substring weights plus a bonus for its kind."""
    kind = F.col("tipo") == KIND_OF_MODE[mode]
    if not query.strip():
        return df.withColumn("score", F.when(kind, NO_QUERY).otherwise(0))
    needle = fold(F.lit(query))
    score = F.when(kind, SAME_KIND).otherwise(0)
    for col, weight in EXACT.items():
        score = score + F.when(fold(col) == needle, weight).otherwise(0)
    for col, weight in PREFIX.items():
        score = score + F.when(F.startswith(fold(col), needle), weight).otherwise(0)
    for col, weight in INSIDE.items():
        score = score + F.when(F.contains(fold(col), needle), weight).otherwise(0)
    return df.withColumn("score", score)


def score_options(df: DataFrame, query: str, mode: str = "asset", n: int = 1) -> DataFrame:
    """WIN-7: the best option, or the ``n`` best; equal scores go by id."""
    return with_score(df, query, mode).orderBy(F.desc("score"), up("id")).limit(n)


def order_statements(df: DataFrame) -> DataFrame:
    """SRT-1: newest period first, then document type down, statement and account up."""
    return df.orderBy(down("data_ref"), down("tipo_doc"), up("demonstracao"), up("cd_conta"))


# SRT-2: the order of each listing.
LISTINGS = {
    "assets": [("data_vencimento", up)],
    "schedule": [("data_evento", up)],
    "history": [("data_referencia", down)],
    "documents": [("criado_em", down)],
    "register": [("nome", up)],
}


def order_listing(df: DataFrame, listing: str, tie: Sequence[str] = ()) -> DataFrame:
    """SRT-2: rows in the order of a named listing; ``tie`` columns follow upward, then those of the natural keys it has."""
    named = [c for c, _ in LISTINGS[listing]]
    return df.orderBy(*[way(c) for c, way in LISTINGS[listing]], *[up(c) for c in tie], *ties(df, [*named, *tie]))
