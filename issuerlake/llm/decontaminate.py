"""Benchmark decontamination: a prefix-filtered join of item windows with document words.

Only DataFrame operations. An item's windows are its runs of ``window`` words; an
item of fewer words is one window. Steps:

1. Item windows are broken into shingles of ``shingle`` words. Documents' shingles
   are hashed in blocks of positions and those that occur in any item are kept with
   the words around them, so later steps never come back to the texts.
2. The kept shingles are ordered by rarity over all documents. Of each window only
   the rarest shingle (the necessary prefix of an exact containment) is joined.
3. The window must lie inside the document (positions) and have its length, and its
   words must be equal to the document's words there.

A shingle set is broadcast only while its counted size is at most ``BROADCAST_ROWS``;
beyond that the same join is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuerlake.llm.shared import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words, after lower-casing A-Z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word before lower-casing.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words of a document that one row carries.
BLOCK = 256
BROADCAST_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), "")


def count_words(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """``(item, words, size)``: the distinct windows of each item, as words joined by one space."""
    words = items.select(F.col("item_id").alias("item"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    at = words.select("item", "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    cut = F.slice("words", F.col("at") + 1, window)
    return at.select("item", F.array_join(cut, " ").alias("window"), F.size(cut).alias("size")).distinct()


def _hash(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, at + j) for j in range(size)])


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcasting when its counted rows are few enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def occurrences(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, start, size, window)`` of every place of an item's window, and ``(item, window, size)``."""
    windows = materialize(item_windows(items, window), "windows")
    single = windows.select("window", "size").distinct()
    parts = single.select("window", "size", F.split("window", " ").alias("words"), F.least(F.lit(shingle), "size").alias("width"))
    widths = [r["width"] for r in parts.select("width").distinct().collect()]  # at most `shingle` values
    if not widths:
        widths = [shingle]

    def hashed(words: Column, at: Column, width: Column) -> Column:
        found = F.lit(None).cast("long")
        for w in widths:
            found = F.when(width == w, _hash(words, at, w)).otherwise(found)
        return found

    shingles = parts.select("window", "size", "words", "width", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("width"))).alias("offset"))
    shingles = materialize(shingles.select("window", "size", "width", "offset", hashed(F.col("words"), F.col("offset"), F.col("width")).alias("shingle")), "shingles")
    known = shingles.select("shingle", "width").distinct()

    margin = window - 1
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", F.length("text").alias("chars"), words_of(F.col("text")).alias("words"))
    # At most every second character starts a word; blocks past the last word go. The bound keeps the cutting of words out of filters.
    blocks = texts.select("doc_id", "words", F.explode(F.expr(f"sequence(0, chars div 2, {BLOCK})").cast("array<int>")).alias("block"))
    blocks = blocks.select("*", F.size("words").alias("n")).where("block < n")
    lead = F.least(F.col("block"), F.lit(margin))
    blocks = blocks.select("doc_id", "n", "block", lead.alias("lead"), F.slice("words", F.col("block") - lead + 1, F.lit(BLOCK + 2 * margin)).alias("words"))
    cells = blocks.select("*", F.explode(F.expr(f"sequence(0, least({BLOCK}, n - block) - 1)")).alias("i"))
    cells = cells.withColumn("at", F.col("block") + F.col("i")).withColumn("k", F.col("lead") + F.col("i"))
    if len(widths) == 1:
        cells = cells.withColumn("width", F.lit(widths[0])).where(F.col("at") + F.col("width") <= F.col("n"))
    else:
        cells = cells.select("*", F.explode(F.array(*map(F.lit, widths))).alias("width")).where(F.col("at") + F.col("width") <= F.col("n"))
    cells = cells.withColumn("shingle", hashed(F.col("words"), F.col("k"), F.col("width")))
    met = cells.join(_small(known), ["shingle", "width"])
    before = F.least(F.col("k"), F.lit(margin))
    met = met.select("doc_id", "n", "at", "shingle", "width", before.alias("before"), F.slice("words", F.col("k") - before + 1, before + F.lit(window)).alias("near"))
    met = materialize(met, "met")

    rare = met.groupBy("shingle", "width").agg(F.count(F.lit(1)).alias("df"))
    ranked = shingles.join(rare, ["shingle", "width"])
    # A window with a shingle that no document has can't occur; the others keep their rarest shingle.
    need = F.col("size") - F.col("width") + 1
    best = ranked.groupBy("window", "size", "width").agg(
        F.count(F.lit(1)).alias("seen"), F.min(F.struct("df", "shingle", "offset")).alias("rarest")
    ).where(F.col("seen") == need)
    prefix = best.select("window", "size", "width", F.col("rarest.shingle").alias("shingle"), F.col("rarest.offset").alias("offset"))
    places = met.join(_small(materialize(prefix, "prefix")), ["shingle", "width"])
    start = F.col("at") - F.col("offset")
    inside = (start >= 0) & (start + F.col("size") <= F.col("n"))
    same = F.array_join(F.slice("near", F.col("before") - F.col("offset") + 1, F.col("size")), " ") == F.col("window")
    places = places.where(inside & same).select("doc_id", start.alias("start"), "size", "window").distinct()
    return materialize(places, "places"), windows


def _key(docs: DataFrame) -> Column:
    """What a row is known by: its doc_id, or its text where it has none."""
    return F.coalesce(F.concat(F.lit("id "), docs["doc_id"].cast("string")), F.concat(F.lit("text "), F.sha2(docs["text"], 256)), F.lit("none"))


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` per row of ``docs``.

    Null and empty texts have no words and no hits; null or wordless items have no
    windows. Columns other than doc_id, text and item_id are ignored. Repeated rows of
    one doc_id and text give the same result each; rows with a null doc_id are judged by their
    texts. No items: nothing is contaminated.
    """
    found = _hits(docs.select(_key(docs).alias("doc_id"), "text"), items.select("item_id", "text"), window)
    counted = docs.select("doc_id", count_words(F.col("text")).alias("n_words"), _key(docs).alias("key"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return counted.join(found, counted["key"] == found["hit_id"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def _hits(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """``(hit_id, n_hit, items)`` of the documents with a hit."""
    places, windows = occurrences(docs, items, window)
    # Words hit: the length of the union of a document's intervals.
    starts = places.groupBy("doc_id", "start").agg(F.max(F.col("start") + F.col("size")).alias("stop"))
    before = Window.partitionBy("doc_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce(F.max("stop").over(before), "start")))
    hits = starts.withColumn("covered", covered).groupBy("doc_id").agg(F.sum("covered").alias("n_hit"))
    pairs = places.select("doc_id", "window").distinct().join(windows.select("window", "item"), "window")
    pairs = pairs.select("doc_id", F.col("item").cast("string").alias("item")).distinct()
    named = pairs.groupBy("doc_id").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return hits.join(named, "doc_id").withColumnRenamed("doc_id", "hit_id")


def clean(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """All columns of ``docs``, without the contaminated documents. Rows with a null doc_id are judged by their texts."""
    found = _hits(docs.select(_key(docs).alias("doc_id"), "text"), items.select("item_id", "text"), window)
    return docs.join(found, _key(docs) == found["hit_id"], "left_anti")
