"""Words, word hashes and n-gram hashes of whole Arrow batches, without a loop over words.

Separators are ASCII bytes, so words can be cut on the UTF-8 bytes: every byte from
0x80 on belongs to a word, whatever character it is part of.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer document is handled alone.
CHUNK = 1 << 19

_BYTE = np.arange(256)
#: Separators of words `[^\x20\x09-\x0D]+`.
BLANKS = (_BYTE == 0x20) | ((_BYTE >= 0x09) & (_BYTE <= 0x0D))
#: Separators of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after A-Z are lower-cased.
MARKS = (_BYTE < 0x80) & ~((_BYTE >= 0x30) & (_BYTE <= 0x39)) & ~((_BYTE >= 0x41) & (_BYTE <= 0x5A)) & ~((_BYTE >= 0x61) & (_BYTE <= 0x7A))
#: A-Z to a-z, all else as it is.
LOWER = np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 32, _BYTE).astype(np.uint8)

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2 ** 64; kept for chunks of usual size."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK + (CHUNK >> 2)), base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if n <= CHUNK + (CHUNK >> 2):
            _powers[base] = have
    return have[:n]


@dataclass
class Chunk:
    """Some documents of a batch. ``first``: index of each document's first row in the batch."""

    row: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Words:
    """Words of a chunk: byte ranges, hashes, and where each document's words begin (one more at the end)."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def chunks(texts: pa.Array | pa.ChunkedArray, limit: int = CHUNK) -> Iterator[Chunk]:
    """A batch's texts (null: empty) in runs of about ``limit`` bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, where, data = texts.buffers()
    if not len(texts):
        return
    bounds = np.frombuffer(where, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        upto = min(upto, len(texts))
        yield Chunk(at, data[bounds[at] : bounds[upto]], bounds[at : upto + 1] - bounds[at])
        at = upto


def cut(chunk: Chunk, separators: np.ndarray, lower: bool, hashes: bool = True) -> Words:
    """Words between ``separators`` (a table of 256 flags); with ``lower``, hashes are of the lower-cased words."""
    data, bounds = chunk.data, chunk.bounds
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64))
    inside = ~separators[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    found = np.zeros(0, np.uint64)
    if hashes:
        terms = (LOWER[data] if lower else data).astype(np.uint64)
        terms += np.uint64(1)
        terms *= _power(_BASE, n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        found = (sums[ends] - sums[starts]) * _power(_INVERSE, n)[starts]
        found = mix(found + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return Words(starts, ends, found, np.searchsorted(starts, bounds))


def hash_ranges(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges, as ``cut`` makes them of words."""
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= _power(_BASE, len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    found = (sums[starts + sizes] - sums[starts]) * _power(_INVERSE, len(data))[starts]
    return mix(found + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hash_words(words: list[bytes]) -> np.ndarray:
    """The hashes that ``cut`` gives these words."""
    chunk = Chunk(0, np.frombuffer(b" ".join(words), np.uint8), np.array([0, sum(map(len, words)) + max(0, len(words) - 1)]))
    return cut(chunk, BLANKS, lower=False).hashes


def factors(n: int) -> np.ndarray:
    return _power(0xA0761D6478BD642F, n + 1)[1:]


def ngrams(words: Words, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words of one document, and the index of each run's first word."""
    h = words.hashes
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = len(h) - n + 1
    sums = np.full(size, seed + n, np.uint64)
    for j, factor in enumerate(factors(n)):
        sums += h[j : j + size] * factor
    limit = np.repeat(words.first[1:], words.counts)[:size]
    at = np.flatnonzero(limit - np.arange(size) >= n)
    return mix(sums[at]), at


def as_long(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's signed long."""
    return x.view(np.int64)
