"""Language identification by interpolated Kneser-Ney character models.

Each language gets a model of byte trigrams over letters (A-Z folded, everything
that is no letter is one blank), counted over all learning texts by Spark. The
models are kept as one sorted array of the trigram codes that any language has, with
a column of log-probabilities per language; other trigrams back off to bigrams.
A text gets the language with the lowest cross-entropy per symbol. It is rejected
if it has no letter, or if its cross-entropy is above the limit of that language,
which is calibrated on all learning texts: ``MARGIN`` above the cross-entropy that
``USUAL`` percent of the language's texts keep below in their own language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuerlake.llm import text as T
from issuerlake.llm.shared import Shared

UNKNOWN = "und"
#: Symbols: blank, a-z, and the 128 bytes of other characters.
SYMBOLS = 1 + 26 + 128
#: Texts of fewer symbols are not rejected for their cross-entropy: it says little.
SHORT = 40
#: Percent of a language's learning texts that set its limit; the rest may be junk.
USUAL = 99
#: Bits per symbol above that. At sf0.1 a limit is 5.5 to 5.7 bits: the oddest learning text has 5.1, random letters have 9.
MARGIN = 3.0
#: Steps of a bit in which cross-entropies are counted.
STEPS = 64
#: Limit where no text is long enough to measure: bits of symbols drawn evenly.
EVEN = float(np.log2(SYMBOLS))

_CLASS = np.zeros(256, np.int32)
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = np.arange(1, 27)
_CLASS[0x80:] = np.arange(27, 155)


def _trigrams(chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes of a chunk's texts, runs of blanks taken as one, and where each text's codes begin."""
    c = _CLASS[chunk.data]
    if not len(c):
        return np.zeros(0, np.int32), np.zeros(len(chunk) + 1, np.int64)
    first = np.zeros(len(c) + 1, bool)
    first[chunk.bounds] = True
    before = np.concatenate([[0], c[:-1]])
    before[first[:-1]] = 0
    keep = np.flatnonzero((c != 0) | (before != 0))
    c, starts = c[keep], np.searchsorted(keep, chunk.bounds)
    one, two = np.zeros(len(c) + 1, np.int32), np.zeros(len(c) + 1, np.int32)
    one[1:], two[2:] = c, c[:-1]
    one[starts] = two[starts] = 0
    inner = starts[starts < len(c)] + 1
    two[inner[inner <= len(c)]] = 0
    return (two[:-1] * SYMBOLS + one[:-1]) * SYMBOLS + c, starts


@dataclass
class Model:
    """``codes`` sorted; ``logs``: bits per language and code; ``gamma``, ``low``: bits of backing off per bigram, and of the lower order."""

    languages: list[str]
    codes: np.ndarray
    logs: np.ndarray
    gamma: np.ndarray
    low: np.ndarray
    limits: np.ndarray

    def entropies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bits per symbol of whole texts in each language, and their symbols."""
        if not hasattr(self, "_place"):
            self._place = np.full(SYMBOLS**3, -1, np.int32)
            self._place[self.codes] = np.arange(len(self.codes), dtype=np.int32)
        out, size = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        for chunk in T.chunks(texts):
            codes, starts = _trigrams(chunk)
            rows = slice(chunk.row, chunk.row + len(chunk))
            size[rows] = np.diff(starts)
            place = self._place[codes]
            new = np.flatnonzero(place < 0)
            for k in range(len(self.languages)):
                bits = self.logs[k][place]
                bits[new] = self.gamma[k][codes[new] // SYMBOLS] + self.low[k][codes[new] % SYMBOLS**2]
                sums = np.concatenate([[0.0], np.cumsum(bits, dtype=np.float64)])
                out[rows, k] = (sums[starts[1:]] - sums[starts[:-1]]) / np.maximum(size[rows], 1)
        return out, size


def kneser_ney(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Models from each language's trigram codes and counts."""
    languages = sorted(counts)
    codes = np.unique(np.concatenate([counts[x][0] for x in languages])) if languages else np.zeros(0, np.int64)
    logs, gammas, lows = [], [], []

    def discount(n: np.ndarray) -> float:
        one, two = (n == 1).sum(), (n == 2).sum()
        return one / (one + 2 * two) if one and two else 0.5

    for language in languages:
        code, n = counts[language]
        history, pair = code // SYMBOLS, code % SYMBOLS**2
        d = discount(n)
        total = np.bincount(history, n, SYMBOLS**2)
        kinds = np.bincount(history, minlength=SYMBOLS**2)
        gamma = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
        # Lower orders count the different symbols before, not the occurrences.
        seen = np.bincount(pair, minlength=SYMBOLS**2).astype(float)
        grid = seen.reshape(SYMBOLS, SYMBOLS)
        d2 = discount(seen)
        sums, types = grid.sum(axis=1), (grid > 0).sum(axis=1)
        alone = (grid > 0).sum(axis=0).astype(float)
        d1 = discount(alone)
        unigram = np.maximum(alone - d1, 0) / max(alone.sum(), 1) + d1 * (alone > 0).sum() / max(alone.sum(), 1) / SYMBOLS
        unigram = unigram / unigram.sum()
        back = np.where(sums > 0, d2 * types / np.maximum(sums, 1), 1.0)
        low = (np.maximum(grid - d2, 0) / np.maximum(sums, 1)[:, None] + back[:, None] * unigram[None, :]).ravel()
        mine = np.zeros(len(codes))
        mine[np.searchsorted(codes, code)] = n
        h = codes // SYMBOLS
        p = np.where(total[h] > 0, np.maximum(mine - d, 0) / np.maximum(total[h], 1), 0) + gamma[h] * low[codes % SYMBOLS**2]
        logs.append(-np.log2(p))
        gammas.append(-np.log2(gamma))
        lows.append(-np.log2(low))
    stack = lambda x: np.array(x, np.float32) if x else np.zeros((0, 0), np.float32)
    return Model(languages, codes, stack(logs), stack(gammas), stack(lows), np.full(len(languages), EVEN))


def limits(languages: int, own: np.ndarray, steps: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Limits from how many texts (``n``) of which language (``own``) have a cross-entropy of ``steps``.

    A language's limit is not below that of all texts taken together, which is also
    the limit of a language without a measured text: few texts, of which the model
    was learned, say too little about others. No text at all: ``EVEN``.
    """

    def usual(some: np.ndarray) -> float:
        order = np.argsort(steps[some])
        total = np.cumsum(n[some][order])
        return steps[some][order][np.searchsorted(total, -(-USUAL * total[-1] // 100))] / STEPS

    if not len(n):
        return np.full(languages, EVEN)
    least = usual(np.ones(len(n), bool))
    return np.array([max(least, usual(own == k)) if (own == k).any() else least for k in range(languages)]) + MARGIN


def learn(docs: DataFrame) -> Model:
    """Models of every non-null ``lang`` of ``docs``, counted over all its texts; so are the rejection limits.

    What comes to the driver are counts of trigram codes, at most SYMBOLS ** 3 for a
    language, and of cross-entropies in steps, however much text there is.
    """
    docs = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            lang = np.array(batch.column(0).to_pylist(), object)
            for chunk in T.chunks(batch.column(1)):
                codes, starts = _trigrams(chunk)
                mine = lang[chunk.row : chunk.row + len(chunk)]
                for x in set(mine):
                    have = total.setdefault(x, np.zeros(0, np.int64))
                    got = np.concatenate([codes[starts[i] : starts[i + 1]] for i in np.flatnonzero(mine == x)])
                    code, n = np.unique(got, return_counts=True)
                    total[x] = _add(have, code, n)
        for x, (code, n) in ((x, v) for x, v in total.items() if len(v)):
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(code), pa.string()), pa.array(code, pa.int32()), pa.array(n, pa.int64())], ["lang", "code", "n"])

    def _add(have, code, n):
        if not len(have):
            return code.astype(np.int64), n
        both, place = np.unique(np.concatenate([have[0], code]), return_inverse=True)
        return both, np.bincount(place, np.concatenate([have[1], n])).astype(np.int64)

    counted = docs.select("lang", "text").mapInArrow(count, "lang string, code int, n long")
    got = counted.groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow()
    lang, code, n = np.array(got.column(0).to_pylist(), object), got.column(1).to_numpy(), got.column(2).to_numpy()
    counts = {x: (code[lang == x].astype(np.int64), n[lang == x]) for x in set(lang.tolist())}
    model = kneser_ney(counts)
    if counts:
        shared = Shared(docs.sparkSession, model)

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at = {x: k for k, x in enumerate(shared.value.languages)}
            for batch in batches:
                bits, size = shared.value.entropies(batch.column(1))
                own = np.array([at.get(x, -1) for x in batch.column(0).to_pylist()], np.int32)
                long = np.flatnonzero((size >= SHORT) & (own >= 0))
                steps = np.ceil(bits[long, own[long]] * STEPS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own[long]), pa.array(steps)], ["own", "steps"])

        measured = docs.select("lang", "text").mapInArrow(measure, "own int, steps long")
        got = measured.groupBy("own", "steps").agg(F.count(F.lit(1)).alias("n")).toArrow()
        model.limits = limits(len(model.languages), *(got.column(k).to_numpy() for k in range(3)))
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, lang_pred, score, bits, rejected)`` per row of ``docs``.

    Null texts and texts without a letter are ``und`` with score 0, and rejected;
    so is every text if no language was learned. ``bits``: cross-entropy per symbol
    in the language predicted. Score: probability of that language among the learned
    ones, from at most 64 symbols' worth of evidence. Equal languages: the first in
    order of name. Repeated rows give a row each; other columns are ignored.
    """
    shared = Shared(docs.sparkSession, model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            letters = batch.column(1).to_numpy(zero_copy_only=False)
            names, scores, low, refused = [], np.zeros(len(batch)), np.zeros(len(batch)), np.ones(len(batch), bool)
            if m.languages:
                bits, size = m.entropies(batch.column(2))
                best = bits.argmin(axis=1)
                low = bits[np.arange(len(bits)), best]
                chance = np.exp2(-(bits - low[:, None]) * np.minimum(size, 64)[:, None])
                scores = np.where(letters, 1 / chance.sum(axis=1), 0.0)
                refused = ~letters | ((size >= SHORT) & (low > m.limits[best]))
                names = [m.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
            else:
                names = [UNKNOWN] * len(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores), pa.array(low), pa.array(refused)], ["doc_id", "lang_pred", "score", "bits", "rejected"]
            )

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", has_letter(F.col("text")).alias("letters"), "text")
    return rows.mapInArrow(score, f"doc_id {kind}, lang_pred string, score double, bits double, rejected boolean")


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def accepted(docs: DataFrame, learning: DataFrame) -> DataFrame:
    """All columns of ``docs``, without the documents whose language is rejected (see ``identify``); models come from ``learning`` (doc_id, text, lang)."""
    found = identify(docs, learn(learning.select("doc_id", "text", "lang")))
    gone = found.groupBy("doc_id").agg(F.min("rejected").alias("rejected")).where("rejected").select(F.col("doc_id").alias("gone_id"))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"]), "left_anti")
