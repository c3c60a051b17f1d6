"""N-gram Jaccard join by vertical partitioning.

Documents are sets of distinct word n-grams. All n-grams stand in one global order,
rare ones first, and that order is cut into fragments of equal weight. Two sets can
only be similar if they share one of the first n-grams of each ("prefix"), which
gives candidate pairs; the overlap of a pair is then counted in each fragment apart
and summed per pair.

* Rarity is counted over all words of all documents, in 2**17 hashed counters. An
  n-gram's place is (the summed logarithms of its words' counters, its hash): any
  total order gives right results. N-grams of rare words only, which no unrelated
  document has, come first; frequent words come last.
* Passages of rare words that many documents share would come first too. N-grams found
  in the prefixes of many documents are therefore put behind all others, and the
  documents that have them get new prefixes. The set of such n-grams is joined, never
  broadcast by hint, and may be any set: it only changes the order.
* Equal sets are one class before any pair is formed.
* Prefix n-grams of few documents give pairs outright, at most ``FEW`` for each. A
  pair must share more prefix n-grams than what lies beyond the prefixes can make up
  for, so unrelated pairs end here. Prefix n-grams of many documents count as shared
  as far as both sets have some: a pair that shares n-grams of both kinds is settled
  here, and only pairs that share none of few documents depend on what follows.
* Prefix n-grams of many documents (large groups of near copies) give no pairs.
  First every document is only compared with the smallest one that shares the
  n-gram. What is linked by then needs no further comparison. The documents of the
  n-grams that still join different components are put into blocks of at most about
  ``BLOCK`` alike ones, and every two blocks with an n-gram in common are compared
  whole in one task, fragment by fragment; only links come out, and no link is lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuerlake.llm import text as T
from issuerlake.llm.components import components
from issuerlake.llm.shared import Shared, materialize, spent

#: Counters of the rarity table: a table of 1 MB, whatever the input.
COUNTERS = 1 << 17
#: Pieces in which tasks hand over their counters.
PIECES = 64
#: Fragments of the global order.
FRAGMENTS = 4
#: Documents of a prefix n-gram that are paired outright, at most.
FEW = 16
#: Documents of one block of the exhaustive round, about.
BLOCK = 512
#: How often frequent n-grams of prefixes are put at the end of the order. Any number gives the same links.
DEMOTIONS = 3
#: Prefix lengths that are read of a document to find its new prefix, before its whole set is.
AHEAD = 3
#: Rounds of the exhaustive comparison; each holds its share of the copied n-grams on disk.
ROUNDS = 4
#: Shares of the prefix n-grams that are matched one after another; each is on disk alone.
SHARES = 2
#: What names a block.
PARTS = ("family", "kind", "salt")

_SHIFT = np.uint64(64 - COUNTERS.bit_length() + 1)


def _grams(texts: pa.Array, n: int, separators: np.ndarray, lower: bool, levels: np.ndarray):
    """Per chunk: first row; hashes and places of its n-grams, and the bounds of its documents. A shorter document is one n-gram of all its words."""
    for chunk in T.chunks(texts):
        words = T.cut(chunk, separators, lower)
        grams, at = T.ngrams(words, n)
        level = np.concatenate([[0], np.cumsum(levels[(words.hashes >> _SHIFT).astype(np.int64)])])
        place = level[at + n] - level[at]
        doc = np.searchsorted(words.first, at, "right") - 1
        for m in range(1, n):
            few = np.flatnonzero(words.counts == m)
            if len(few):
                start = words.first[few]
                h = sum((words.hashes[start + j] * f for j, f in enumerate(T.factors(m))), np.full(len(few), m, np.uint64))
                grams, place, doc = np.concatenate([grams, T.mix(h)]), np.concatenate([place, level[start + m] - level[start]]), np.concatenate([doc, few])
        order = np.argsort(doc, kind="stable")
        yield chunk.row, grams[order], place[order], np.searchsorted(doc[order], np.arange(len(chunk) + 1))


def _sets(grams: np.ndarray, place: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per document, its different n-grams by hash, and their places."""
    for a, b in zip(bounds[:-1], bounds[1:]):
        g, one = np.unique(grams[a:b], return_index=True)
        yield g, place[a:b][one]


def rarity(docs: DataFrame, separators: np.ndarray, lower: bool) -> np.ndarray:
    """How often the words of each counter occur in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for chunk in T.chunks(batch.column(0)):
                total += np.bincount((T.cut(chunk, separators, lower).hashes >> _SHIFT).astype(np.int64), minlength=COUNTERS)
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict(
            {"piece": np.arange(PIECES, dtype=np.int32), "part": np.full(PIECES, task % 512, np.int32), "counts": [x.tobytes() for x in np.split(total, PIECES)]}
        )

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in rows.column("counts").to_pylist())
        return pa.Table.from_pydict({"piece": pa.array([key[0].as_py()], pa.int32()), "counts": [total.tobytes()]})

    counted = docs.select("text").mapInArrow(count, "piece int, part int, counts binary")
    added = counted.groupBy("piece", "part").applyInArrow(add, "piece int, counts binary")
    added = added.groupBy("piece").applyInArrow(add, "piece int, counts binary")
    out = np.zeros((PIECES, COUNTERS // PIECES), np.int64)
    for row in added.collect():  # PIECES rows of 16 KB
        out[row["piece"]] = np.frombuffer(row["counts"], np.int64)
    return out.ravel()


def _order(counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The level of each counter, and the places where the global order is cut into fragments: equal shares if words were drawn apart."""
    levels = np.round(4 * np.log2(counts + 1)).astype(np.int64)
    one = np.bincount(levels, counts, minlength=int(levels.max()) + 1) / max(1, counts.sum())
    share = np.ones(1)
    for _ in range(n):
        share = np.convolve(share, one)
    return levels, np.searchsorted(np.cumsum(share), np.arange(1, FRAGMENTS) / FRAGMENTS)


#: Rows without a doc_id get ids from here on, by a hash of their text.
UNNAMED = 1 << 62


def _id(docs: DataFrame) -> Column:
    """doc_id, or for a row without one an id of its text: rows with the same text have the same."""
    return F.coalesce(docs["doc_id"].cast("long"), F.xxhash64(docs["text"]).bitwiseAND(F.lit(UNNAMED - 1)).bitwiseOR(F.lit(UNNAMED)))


def _take(n: int, percent: int) -> int:
    """N-grams of the prefix of a set of n."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _demoted(docs: DataFrame, reps: DataFrame, shared: Shared, words: int, percent: int, separators: np.ndarray, lower: bool) -> DataFrame:
    """``reps`` (doc_id, n, prefix; written, and removed here when changed) with prefixes in the order where n-grams of the prefixes of many documents come last."""

    def ordered(batches: Iterator[pa.RecordBatch], ahead: int | None) -> Iterator[pa.RecordBatch]:
        """The first n-grams of each set in the order by place; all without ``ahead``."""
        levels, _ = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, grams, place, bounds in _grams(batch.column(1), words, separators, lower, levels):
                n, take, first = [], [], []
                for g, at in _sets(grams, place, bounds):
                    n.append(len(g))
                    take.append(_take(len(g), percent))
                    first.append(g[np.argsort(at, kind="stable")[: ahead * take[-1] if ahead else len(g)]])
                lengths = np.concatenate([[0], np.cumsum([len(x) for x in first])]).astype(np.int32)
                flat = np.concatenate(first) if first else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row : row + len(n)], pa.int64()), pa.array(n, pa.int64()), pa.array(take, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(lengths), pa.array(T.as_long(flat)))],
                    ["doc_id", "n", "take", "grams"],
                )

    def renewed(asked: DataFrame, often: DataFrame, ahead: int | None) -> DataFrame:
        """New prefixes of the sets ``asked`` for (doc_id, n); ``open`` where too little was read."""
        texts = docs.join(asked.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "text")
        read = texts.mapInArrow(lambda x: ordered(x, ahead), "doc_id long, n long, take int, grams array<long>")
        read = materialize(read.join(asked, ["doc_id", "n"], "left_semi").dropDuplicates(["doc_id", "n"]), "ordered")
        met = read.select("doc_id", "n", F.explode("grams").alias("gram")).join(often, "gram")
        met = met.groupBy("doc_id", "n").agg(F.collect_list("gram").alias("late"))
        late = F.coalesce("late", F.array().cast("array<long>"))
        both = read.join(met, ["doc_id", "n"], "left").withColumn("early", F.array_except("grams", late))
        # array_except and array_intersect keep the order of their first array.
        prefix = F.slice(F.concat("early", F.array_intersect("grams", late)), F.lit(1), F.col("take"))
        wanting = (F.size("early") < F.col("take")) & (F.size("grams") < F.col("n"))
        out = materialize(both.select("doc_id", "n", prefix.alias("prefix"), wanting.alias("open")), "renewed")
        spent(read)
        return out

    often, found = None, []
    for _ in range(DEMOTIONS):
        posts = reps.select("doc_id", "n", F.explode("prefix").alias("gram"))
        more = posts.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where(f"m > {FEW}").select("gram")
        more = materialize(more if often is None else more.join(often, "gram", "left_anti"), "often")
        found.append(more)
        if more.isEmpty():
            break
        often = more if often is None else often.unionByName(more)
        asked = materialize(posts.join(more, "gram", "left_semi").select("doc_id", "n").distinct(), "asked")
        ahead = renewed(asked, often, AHEAD)
        whole = renewed(ahead.where("open").select("doc_id", "n"), often, None)
        new = ahead.where("not open").unionByName(whole).drop("open")
        before, reps = reps, materialize(reps.join(asked, ["doc_id", "n"], "left_anti").unionByName(new), "prefixes")
        spent(before, asked, ahead, whole)
    spent(*found)
    return reps


def similar_sets(
    docs: DataFrame, words: int = 5, percent: int = 80, separators: np.ndarray = T.BLANKS, lower: bool = True
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``: components of documents whose n-gram sets have a Jaccard similarity of ``percent`` or more.

    Null and empty texts have an empty set and stand alone; a text of fewer words
    than ``words`` is one n-gram. Repeated rows of one ``doc_id`` give a row each.
    Rows without a doc_id are linked like others (ids are below 2**62); their doc_id stays null,
    and so does the component_id of a component of such rows only.
    Columns other than doc_id and text are ignored. An empty table gives no rows.
    """
    found = _similar(docs.select(_id(docs).alias("doc_id"), "text"), words, percent, separators, lower)
    named = [F.when(F.col(c) < UNNAMED, F.col(c)).alias(c) for c in ("doc_id", "component_id")]
    return found.select(named[0], "n_shingles", named[1])


def _similar(docs: DataFrame, words: int, percent: int, separators: np.ndarray, lower: bool) -> DataFrame:
    """``similar_sets`` of documents that all have an id."""
    spark = docs.sparkSession
    shared = Shared(spark, _order(rarity(docs, separators, lower), words))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, _ = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, grams, place, bounds in _grams(batch.column(1), words, separators, lower, levels):
                size, prefix = len(bounds) - 1, []
                n, one, two = np.zeros(size, np.int64), np.zeros(size, np.uint64), np.zeros(size, np.uint64)
                for i, (g, at) in enumerate(_sets(grams, place, bounds)):
                    n[i] = len(g)
                    prefix.append(g[np.argsort(at, kind="stable")[: _take(len(g), percent)]])
                    one[i], two[i] = g.sum(), T.mix(g ^ np.uint64(0x5851F42D4C957F2D)).sum()
                lengths = np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)
                flat = np.concatenate(prefix) if prefix else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row : row + size], pa.int64()), pa.array(n), pa.array(T.as_long(one)), pa.array(T.as_long(two)),
                     pa.ListArray.from_arrays(pa.array(lengths), pa.array(T.as_long(flat)))],
                    ["doc_id", "n", "one", "two", "prefix"],
                )

    sets = materialize(docs.mapInArrow(first, "doc_id long, n long, one long, two long, prefix array<long>"), "sets")
    classes = sets.where("n > 0").groupBy("n", "one", "two").agg(F.min("doc_id").alias("rep"))
    members = sets.select("doc_id", "n", "one", "two").join(classes, ["n", "one", "two"], "left").select("doc_id", "n", "rep")
    members = materialize(members, "members")
    ranked = Window.partitionBy("n", "one", "two").orderBy("doc_id")
    reps = sets.where("n > 0").withColumn("k", F.row_number().over(ranked)).where("k = 1").select("doc_id", "n", "prefix")
    reps = materialize(reps, "prefixes")
    spent(sets)
    reps = _demoted(docs, reps, shared, words, percent, separators, lower)
    posts = reps.select("doc_id", "n", F.posexplode("prefix").alias("i", "gram"))
    met = []
    for share in range(SHARES):
        some = posts.where(F.pmod("gram", F.lit(SHARES)) == share)
        several = some.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("doc_id", "n", "i")).alias("centre")).where("m > 1")
        met.append(materialize(some.join(several, "gram"), "met"))
    spent(reps)
    often = F.count(F.when(F.col("m") > FEW, 1)).over(Window.partitionBy("doc_id"))
    posts = materialize(reduce(DataFrame.unionByName, met).withColumn("often", often), "posts")
    spent(*met)

    def enough(na: Column, nb: Column, common: Column) -> Column:
        return (100 + percent) * common >= percent * (na + nb)

    def possible(na: Column, nb: Column, i: Column, j: Column) -> Column:
        fits = (100 * F.least(na, nb)) >= (percent * F.greatest(na, nb))
        return fits & enough(na, nb, 1 + F.least(na - i - 1, nb - j - 1))

    def beyond(n: Column) -> Column:
        """N-grams of a set that are not in its prefix."""
        return F.ceil(percent * n / 100) - 1

    small, many = posts.where(f"m <= {FEW}"), posts.where(f"m > {FEW}")
    x, y = small.alias("x"), small.alias("y")
    both = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.doc_id") < F.col("y.doc_id"))
                  & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")))
    both = both.groupBy(
        F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb"), F.least("x.often", "y.often").alias("often")
    ).agg(F.count(F.lit(1)).alias("shared"))
    # The positional bound below holds at the first shared n-gram only, so these pairs are judged here, whatever else they share.
    most = F.col("shared") + F.col("often") + F.greatest(beyond(F.col("na")), beyond(F.col("nb")))
    pairs = both.where(enough(F.col("na"), F.col("nb"), most)).drop("shared", "often")
    c = F.col("centre")
    near = many.where((F.col("doc_id") != c["doc_id"]) & possible(F.col("n"), c["n"], F.col("i"), c["i"]))
    near = near.select(c["doc_id"].alias("a"), F.col("doc_id").alias("b"), c["n"].alias("na"), F.col("n").alias("nb"))
    pairs = materialize(pairs.unionByName(near).distinct(), "pairs")

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("d")).unionByName(many.select(F.col("doc_id").alias("d"))).distinct()
    texts = docs.join(wanted, docs["doc_id"] == wanted["d"], "left_semi").dropDuplicates(["doc_id"])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, pivots = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, grams, place, bounds in _grams(batch.column(1), words, separators, lower, levels):
                keys, parts, cut = [], [], []
                for i, (g, at) in enumerate(_sets(grams, place, bounds)):
                    f = np.searchsorted(pivots, at, "right")
                    for k in range(FRAGMENTS):
                        keys.append(ids[row + i])
                        parts.append(k)
                        cut.append(g[f == k])
                lengths = np.concatenate([[0], np.cumsum([len(c) for c in cut])]).astype(np.int32)
                flat = np.concatenate(cut) if cut else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(parts, pa.int32()), pa.ListArray.from_arrays(pa.array(lengths), pa.array(T.as_long(flat)))],
                    ["d", "fragment", "grams"],
                )

    cut = materialize(texts.mapInArrow(segments, "d long, fragment int, grams array<long>"), "segments")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs that are links, written."""
        left = cut.select(F.col("d").alias("a"), "fragment", F.col("grams").alias("ga"))
        right = cut.select(F.col("d").alias("b"), "fragment", F.col("grams").alias("gb"))
        parts = []
        # A fragment at a time: the n-grams sent for the pairs are a part of the whole, and gone before the next part.
        for k in range(FRAGMENTS):
            met = pairs.join(left.where(F.col("fragment") == k), "a").join(right.where(F.col("fragment") == k), ["b", "fragment"])
            parts.append(materialize(met.select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).alias("common")), "common"))
        summed = reduce(DataFrame.unionByName, parts).groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
        out = materialize(summed.where(enough(F.col("na"), F.col("nb"), F.col("common"))).select("a", "b"), "links")
        spent(*parts)
        return out

    links = verified(pairs)
    spent(pairs)
    named = components(links).select(F.col("id").alias("node"), "component")

    # N-grams of many documents in several components, in blocks of documents that share their most frequent one.
    posts = many.drop("m", "centre", "often").join(named, many["doc_id"] == named["node"], "left").select("gram", "doc_id", "n", "i", F.coalesce("component", "doc_id").alias("c"))
    posts = materialize(posts, "named")
    mixed = posts.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    posts = materialize(posts.join(mixed.select("gram", "m"), "gram"), "open")
    family = posts.groupBy("doc_id").agg(F.max(F.struct("m", "gram"))["gram"].alias("family"), F.first("n").alias("n"), F.first("c").alias("c"))
    # A component of more than BLOCK documents has blocks of its own, which are not compared among themselves; the rest of a family is mixed.
    own = family.groupBy("family", "c").agg(F.count(F.lit(1)).alias("together"))
    kind = F.when(F.col("together") > BLOCK, F.col("c")).otherwise(-1)
    sizes = own.groupBy("family", kind.alias("kind")).agg(F.sum("together").alias("size"))
    family = family.join(own, ["family", "c"]).withColumn("kind", kind).join(sizes, ["family", "kind"])
    salt = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("size") / BLOCK))
    blocks = materialize(family.select(F.col("doc_id").alias("d"), "n", "c", F.struct("family", "kind", salt.alias("salt")).alias("block")), "blocks")
    placed = materialize(posts.select("gram", "i", F.col("doc_id").alias("d")).join(blocks, "d"), "placed")
    ranges = placed.groupBy("gram", "block").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("i").alias("i"), F.min("c").alias("c_low"), F.max("c").alias("c_high")
    )
    ranges = materialize(ranges, "ranges")
    x, y = ranges.alias("x"), ranges.alias("y")
    alike = (100 * F.col("x.high") >= percent * F.col("y.low")) & (100 * F.col("y.high") >= percent * F.col("x.low"))
    alike &= enough(F.col("x.low"), F.col("y.low"), F.least(F.col("x.high") - F.col("x.i"), F.col("y.high") - F.col("y.i")))
    alike &= (F.col("x.c_low") != F.col("y.c_high")) | (F.col("x.c_high") != F.col("y.c_low"))
    met = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.block") <= F.col("y.block")) & alike)
    met = met.select("x.gram", F.col("x.block").alias("one"), F.col("y.block").alias("two"), F.col("x.low").alias("xl"), F.col("x.high").alias("xh"), F.col("y.low").alias("yl"), F.col("y.high").alias("yh"))
    # Of two blocks, the documents that have one of the n-grams in common, at a length that the other block has too.
    ends = F.array(F.struct(F.lit(0).alias("side"), F.col("one").alias("block")), F.struct(F.lit(1).alias("side"), F.col("two").alias("block")))
    met = met.withColumn("end", F.explode(F.when(F.col("one") == F.col("two"), F.slice(ends, 1, 1)).otherwise(ends)))
    met = met.withColumn("block", F.col("end.block")).withColumn("side", F.col("end.side")).drop("end").join(placed, ["gram", "block"])
    side = F.col("side")
    low, high = F.when(side == 0, F.col("yl")).otherwise(F.col("xl")), F.when(side == 0, F.col("yh")).otherwise(F.col("xh"))
    met = met.where((100 * F.col("n") >= percent * low) & (100 * high >= percent * F.col("n")))
    asked = met.select(
        F.xxhash64("one", "two").alias("task"), *(F.col(f"{block}.{part}").alias(f"{block}_{part}") for block in ("one", "two") for part in PARTS), "side", "d", "n", "c",
    ).distinct()
    # One document, or one component, has nothing to be compared with.
    key = [f"{block}_{part}" for block in ("one", "two") for part in PARTS]
    tasks = asked.groupBy(*key).agg(F.min("c").alias("c_low"), F.max("c").alias("c_high")).where("c_low < c_high")
    asked = materialize(asked.join(tasks.select(*key), key), "asked")

    def compare(batches: Iterator[pa.RecordBatch], narrow: bool = False) -> Iterator[pa.RecordBatch]:
        """Rows of one pair of blocks stand together, by fragment; at most about 2 * BLOCK documents are held."""
        names = ["side", "d", "n", "c", "fragment", "grams"]

        def groups(batches):
            last, held = None, []
            for batch in batches:
                keys = list(zip(*(batch.column(x).to_numpy(zero_copy_only=False).tolist() for x in ("task", *key))))
                rows = list(zip(*(batch.column(x).to_numpy(zero_copy_only=False).tolist() for x in names[:-1]), batch.column("grams")))
                for k, row in zip(keys, rows):
                    if k != last and held:
                        yield last[0], held
                        held = []
                    last = k
                    held.append(row)
            if held:
                yield last[0], held

        for task, held in groups(batches):
            docs_ = sorted({(r[0], r[1], r[2], r[3]) for r in held})
            at = {(r[0], r[1]): i for i, r in enumerate(docs_)}
            cross = docs_[-1][0] == 1
            split = sum(1 for r in docs_ if r[0] == 0)
            common = np.zeros((split, len(docs_) - split if cross else split))
            for k in range(1) if narrow else range(FRAGMENTS):
                mine = [(at[r[0], r[1]], r[5].values.to_numpy()) for r in held if r[4] == k]
                who = np.repeat([i for i, _ in mine], [len(g) for _, g in mine]).astype(np.int64)
                grams, place, seen = np.unique(np.concatenate([g for _, g in mine]) if mine else np.zeros(0, np.int64), return_inverse=True, return_counts=True)
                often = np.flatnonzero(seen > 1)
                turn = np.full(len(grams), -1)
                turn[often] = np.arange(len(often))
                place = turn[place]
                for low in range(0, len(often), 4096):
                    some = np.flatnonzero((place >= low) & (place < low + 4096))
                    has = np.zeros((len(docs_), min(4096, len(often) - low)), np.float32)
                    has[who[some], place[some] - low] = 1
                    common += has[:split] @ (has[split:] if cross else has[:split]).T
            left, right = docs_[:split], docs_[split:] if cross else docs_
            n, m = np.array([r[2] for r in left], np.int64), np.array([r[2] for r in right], np.int64)
            other = np.array([r[3] for r in left])[:, None] != np.array([r[3] for r in right])[None, :]
            if narrow:
                # What a link lets a set lack, its rarest fragment may lack at most.
                size = np.zeros(len(docs_), np.int64)
                for r in held:
                    size[at[r[0], r[1]]] = len(r[5].values)
                need = -(-percent * (n[:, None] + m[None, :]) // (100 + percent))
                can = other & (need <= np.minimum(n[:, None], m[None, :]))
                can &= (common >= size[:split][:, None] - (n[:, None] - need)) & (common >= (size[split:] if cross else size)[None, :] - (m[None, :] - need))
                stay = {(r[0], r[1]) for r, x in zip(left, can.any(axis=1)) if x} | {(r[0], r[1]) for r, x in zip(right, can.any(axis=0)) if x}
                kept = [(task, *r[:2]) for r in held if (r[0], r[1]) in stay]
                if kept:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*kept)], ["narrow_task", "narrow_side", "narrow_d"])
                continue
            i, j = np.nonzero(other & ((100 + percent) * common >= percent * (n[:, None] + m[None, :])))
            a, b = np.array([r[1] for r in left], np.int64)[i], np.array([r[1] for r in right], np.int64)[j]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], ["a", "b"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    def together(asked: DataFrame, cut: DataFrame) -> DataFrame:
        rows = asked.join(cut, "d").repartition(parts, "task").sortWithinPartitions("task", *key, "fragment")
        return rows.select("task", *key, "side", "d", "n", "c", "fragment", "grams")

    # In rounds: a document's n-grams are copied for every task, and one round's copies are gone before the next begins.
    # The rarest fragment alone says which documents of two blocks can still have a link; only those are loaded whole.
    for turn in range(ROUNDS):
        now = asked.where(F.pmod(F.shiftright("task", 32), F.lit(ROUNDS)) == turn)
        stay = together(now, cut.where("fragment = 0")).mapInArrow(lambda x: compare(x, True), "narrow_task long, narrow_side long, narrow_d long")
        stay = materialize(stay, "narrowed")
        same = (now["task"] == stay["narrow_task"]) & (now["side"] == stay["narrow_side"]) & (now["d"] == stay["narrow_d"])
        filled = together(now.join(stay, same, "left_semi"), cut)
        links = links.unionByName(materialize(filled.mapInArrow(compare, "a long, b long").distinct(), "links"))
    named = components(links).select(F.col("id").alias("node"), "component")

    named = members.join(named, members["rep"] == named["node"], "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """All columns of ``docs``, without the documents that have a near copy with a smaller id.

    One row of each kept doc_id stays. Rows without a doc_id are compared too, by their
    texts; they give way to a near copy with an id. Columns may have any names.
    """
    own, kept_id, several = (f"{x}_{uuid.uuid4().hex}" for x in ("id", "kept", "several"))
    keyed = docs.withColumn(own, _id(docs))
    found = _similar(keyed.select(F.col(own).alias("doc_id"), "text"), words, percent, T.BLANKS, True)
    found = found.where("doc_id = component_id").groupBy(F.col("doc_id").alias(kept_id)).agg((F.count(F.lit(1)) > 1).alias(several))
    kept = keyed.join(materialize(found, "kept"), F.col(own) == F.col(kept_id))
    # Only rows whose id occurs again are shuffled to be made one.
    once, again = kept.where(~F.col(several)), kept.where(several).dropDuplicates([own])
    return once.unionByName(again).select(*docs.columns)
