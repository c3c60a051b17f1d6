"""Adaptive context-mixing range coder for token ids, many blocks in step.

A block is at most ``BLOCK`` ids and starts from a fresh model, so any block can be
read alone. Before each id the model has three predictions: the id that last
followed the two ids before (order 2), the one that last followed the id before
(order 1), and a distribution over all ids from those seen so far (order 0). How
often the first two were right in the same state of confidence decides how the
probability is shared between the three; a 64-bit range coder turns it into 32-bit
units.

The ids of a block are dealt to ``STREAMS`` streams of neighbours that advance
together under the block's one model, each with a range coder of its own. The model
stands still for a round of ``_LEARN`` steps and then takes in what all streams have
shown, so that a round's probabilities are a few numpy operations when ids are
known. When they are not, a step is a few operations over the streams of all blocks.
Products of 32 bits may wrap, in hashes alone. Arrays are steps x lanes: the streams of the first block, of the second, and so on.

Layout of a block: ``MAGIC``, number of ids (4 bytes), crc32 of the ids as
little-endian unsigned 32-bit integers (4 bytes), size of the vocabulary (4 bytes),
units of each stream (2 bytes each), the streams' units (all big-endian).
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 4096
MAGIC = b"TIF2"
STREAMS = 8
_HEAD = 16 + 2 * STREAMS
#: Blocks that advance together.
LANES = 384

#: Steps after which predictions and shares are renewed, and the steps before which the order-0 distribution is.
_LEARN = 16
_RENEW = (0, 16, 32, 64, 128, 256)
#: Ids below this have a count of their own; others share one among 64.
_OWN = 1024
_GAIN = 24
_SLOTS_1, _SLOTS_2 = 1024, 2048
#: Bits of a share and of the order-0 distribution.
_SHARES, _ZERO = 10, 20
_BITS = _SHARES + _ZERO
#: Bits of a place of the order-0 distribution that are searched; the others are looked up.
_FINE = 9
_U = np.uint64
_BOTTOM, _UNIT = _U(1 << 32), _U(32)


class BlockError(ValueError):
    """A block that does not hold what it says."""


def _bucket(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.where(ids < _OWN, ids, _OWN + ((ids - _OWN) >> 6)), np.where(ids < _OWN, 0, (ids - _OWN) & 63)


class _Model:
    """The models of some blocks."""

    def __init__(self, blocks: int, vocabulary: int) -> None:
        self.blocks = blocks
        self.buckets = _OWN + ((max(0, vocabulary - _OWN) + 63) >> 6) + 1
        at = np.arange(self.buckets)
        # Smaller ids are older merges: commoner until ids are seen.
        self.counts = np.tile(np.where(at < _OWN, _OWN / (at + 64), 2.0), (blocks, 1))
        self.least = np.concatenate([[0], np.cumsum(np.where(at < _OWN, 1, 64))]).astype(np.int32)
        # The id that followed, times four, and how sure it is (0 to 3).
        self.one, self.two = np.full(blocks * _SLOTS_1, -4, np.int32), np.full(blocks * _SLOTS_2, -4, np.int32)
        self.seen = np.tile(np.array([6, 1, 1], np.int64), (blocks * 16, 1))
        row = np.repeat(np.arange(blocks, dtype=np.int32), STREAMS)  # the block of each lane
        self.at_0, self.at_1, self.at_2, self.at_s = row * (self.buckets + 1), row * _SLOTS_1, row * _SLOTS_2, row * 16
        self.at_p = row << _ZERO

    def renew(self, ids: np.ndarray, cells: bool) -> None:
        """Take in the ids since the last renewal of the order-0 distribution. ``cells``: make it searchable too."""
        if len(ids):
            cell = _bucket(ids)[0] + self.at_0
            seen = np.bincount(cell.ravel(), minlength=self.blocks * (self.buckets + 1))
            self.counts += _GAIN * seen.reshape(self.blocks, -1)[:, :-1]
        cum = np.cumsum(self.counts, axis=1)
        cum *= ((1 << _ZERO) - self.least[-1]) / cum[:, -1:]
        flat = np.zeros((self.blocks, self.buckets + 1), np.int32)
        flat[:, 1:] = cum
        flat[:, -1] = (1 << _ZERO) - self.least[-1]
        flat += self.least
        flat += (np.arange(self.blocks, dtype=np.int32) << _ZERO)[:, None]  # each block's places follow those of the block before
        self.flat = flat.ravel()
        if cells:
            # The last bucket that begins at or before each cell's begin.
            self.cells = (np.cumsum(np.bincount(-(-self.flat >> _FINE))) - 1).astype(np.int32)
            self.cells[:: 1 << (_ZERO - _FINE)][:-1] = np.arange(self.blocks) * (self.buckets + 1)

    def find(self, place: np.ndarray) -> np.ndarray:
        """Where in ``flat`` the bucket stands that holds each place."""
        cell = place >> _FINE
        low = self.cells.take(cell)
        cell += 1
        high = self.cells.take(cell)
        left = np.flatnonzero(low < high)
        a, b, goal = low[left], high[left], place[left]
        while len(left):
            middle = a + b
            middle += 1
            middle >>= 1
            right = self.flat.take(middle) <= goal
            a, b = np.where(right, middle, a), np.where(right, b, middle - 1)
            low[left] = a
            more = np.flatnonzero(a < b)
            left, a, b, goal = left[more], a[more], b[more], goal[more]
        return low

    def mix(self) -> None:
        """Renew the shares: of order 2, and of orders 2 and 1 together."""
        whole = self.seen.sum(axis=1)
        self.second = (1 + self.seen[:, 2] * ((1 << _SHARES) - 3) // whole).astype(np.int32)
        self.both = (self.second + 1 + self.seen[:, 1] * ((1 << _SHARES) - 3) // whole).astype(np.int32)

    def predict(self, before: np.ndarray, earlier: np.ndarray) -> tuple:
        mixed = before * 40503
        i = mixed >> 5
        i &= _SLOTS_1 - 1
        i += self.at_1
        mixed += earlier * 30011
        mixed >>= 4
        mixed &= _SLOTS_2 - 1
        j = mixed + self.at_2
        p, q = self.one.take(i), self.two.take(j)
        k = q & 3
        k <<= 2
        k += p & 3
        k += self.at_s
        return i, j, k, p, q

    def learn(self, real: np.ndarray, *round: np.ndarray) -> None:
        """Take in the ids of a round and what ``predict`` gave. Where a context stands in it more than once, the last counts."""
        whole = real.all()
        ids, i, j, k, p, q = (x.ravel() if whole else x[real] for x in round)
        right_2, right_1 = q >> 2 == ids, p >> 2 == ids
        event = np.where(right_2, 2, right_1)
        self.seen += 16 * np.bincount(3 * k + event, minlength=self.seen.size).reshape(self.seen.shape)
        over = self.seen.max(axis=1) > 1000
        if over.any():
            self.seen[over] = (self.seen[over] + 1) >> 1
        ids = 4 * ids
        self.two[j] = ids + np.where(right_2, np.minimum((q & 3) + 1, 3), 0)
        self.one[i] = ids + np.where(right_1, np.minimum((p & 3) + 1, 3), 0)


def _places(sizes: list[int]) -> tuple[int, np.ndarray, np.ndarray]:
    """Steps of the longest stream, the ids of each lane, and which of steps x lanes are ids."""
    sizes = np.array(sizes, np.int64)
    steps = -(-sizes // STREAMS)
    lengths = np.clip(sizes[:, None] - np.arange(STREAMS) * steps[:, None], 0, steps[:, None]).ravel()
    return int(steps.max(initial=0)), lengths, np.arange(steps.max(initial=0))[:, None] < lengths


def encode(blocks: list[np.ndarray], vocabulary: int = 1 << 16) -> list[bytes]:
    """Each block's bytes. Ids are below ``vocabulary``; a block holds at most BLOCK of them."""
    out = []
    for at in range(0, len(blocks), LANES):
        out += _encode(blocks[at : at + LANES], vocabulary)
    return out


def _encode(blocks: list[np.ndarray], vocabulary: int) -> list[bytes]:
    steps, lengths, real = _places([len(b) for b in blocks])
    count, lanes = len(blocks), len(lengths)
    ids = np.zeros((steps + 2, lanes), np.int32)  # two places before the first
    for at, block in zip(range(0, lanes, STREAMS), blocks):
        n = lengths[at]  # the longest
        ids[2 : 2 + n, at : at + STREAMS] = np.pad(block, (0, n * STREAMS - len(block))).reshape(STREAMS, n).T
    model = _Model(count, vocabulary)
    low, span = np.zeros(lanes, _U), np.full(lanes, (1 << 64) - 1, _U)
    # A unit may take a carry until the end; the first place takes none but makes room for it.
    width = steps + 4
    units, filled = np.zeros(lanes * width, _U), np.arange(lanes) * width + 1
    renewed = 0
    for at in range(0, steps, _LEARN):
        if at in _RENEW:
            model.renew(ids[2 + renewed : 2 + at], cells=False)
            renewed = at
        model.mix()
        upto = min(at + _LEARN, steps)
        symbol = ids[2 + at : 2 + upto]
        i, j, k, p, q = model.predict(ids[1 + at : 1 + upto], ids[at:upto])
        bucket, inner = _bucket(symbol)
        cell = bucket + model.at_0
        base = model.flat.take(cell)
        weight = model.flat.take(cell + 1) - base
        own = symbol < _OWN
        x = weight * inner >> 6
        w = np.where(own, weight, (weight * (inner + 1) >> 6) - x)
        x += base - model.at_p
        second, both = model.second.take(k), model.both.take(k)
        third = (1 << _SHARES) - both
        hit_2, hit_1 = q >> 2 == symbol, p >> 2 == symbol
        start = np.where(hit_2, 0, np.where(hit_1, second << _ZERO, (both << _ZERO) + third * x))
        size = np.where(hit_2, second << _ZERO, np.where(hit_1, (both - second) << _ZERO, third * w))
        start[~real[at:upto]], size[~real[at:upto]] = 0, 1 << _BITS
        for a, b in zip(start.astype(_U), size.astype(_U)):
            part = span >> _U(_BITS)
            span = part * b
            part *= a
            low += part
            over = np.flatnonzero(low < part)
            if len(over):
                units[filled[over] - 1] += _U(1)
            move = np.flatnonzero(span < _BOTTOM)
            if len(move):
                units[filled[move]] = low[move] >> _UNIT
                filled[move] += 1
                low[move] <<= _UNIT
                span[move] <<= _UNIT
        model.learn(real[at:upto], symbol, i, j, k, p, q)
    # The last unit: the least above ``low`` that needs no other after it.
    last = low + (_BOTTOM - _U(1))
    units[filled[last < low] - 1] += _U(1)
    units[filled] = last >> _UNIT
    units = units.reshape(lanes, width)
    while True:
        carry = units >> _UNIT
        if not carry.any():
            break
        units &= _BOTTOM - _U(1)
        units[:, :-1] += carry[:, 1:]
    sizes = (filled - np.arange(lanes) * width).reshape(count, STREAMS)
    raw = units.astype(">u4").reshape(count, STREAMS, width)
    out = []
    for block, n, own in zip(blocks, sizes, raw):
        head = MAGIC + struct.pack("<III", len(block), zlib.crc32(np.asarray(block).astype("<u4").tobytes()), vocabulary)
        out.append(head + n.astype(">u2").tobytes() + b"".join(u[1 : 1 + m].tobytes() for u, m in zip(own, n)))
    return out


def decode(coded: list[bytes]) -> list[np.ndarray]:
    """The ids of each block, checked against its checksum. Blocks of one call have one vocabulary."""
    if any(len(c) < _HEAD or c[:4] != MAGIC or c[12:16] != coded[0][12:16] for c in coded):
        raise BlockError("not blocks of token ids of one vocabulary")
    out = []
    for at in range(0, len(coded), LANES):
        out += _decode(coded[at : at + LANES])
    return out


def _decode(coded: list[bytes]) -> list[np.ndarray]:
    heads = [struct.unpack_from("<II", c, 4) for c in coded]
    vocabulary = struct.unpack_from("<I", coded[0], 12)[0]
    sizes = np.array([np.frombuffer(c, ">u2", STREAMS, 16) for c in coded]).astype(np.int64)
    if any(n > BLOCK for n, _ in heads) or any(len(c) != _HEAD + 4 * n for c, n in zip(coded, sizes.sum(axis=1))):
        raise BlockError("a block is not as long as it says")
    steps, lengths, real = _places([n for n, _ in heads])
    lanes = len(lengths)
    # Streams one after another; a stream reads zeros beyond its end.
    units = np.concatenate([np.frombuffer(c, ">u4", offset=_HEAD) for c in coded] + [np.zeros(1, np.uint32)]).astype(_U)
    end = np.cumsum(sizes.ravel())
    taken, none = end - sizes.ravel(), len(units) - 1

    def unit(lane: np.ndarray) -> np.ndarray:
        at = taken[lane]
        taken[lane] += 1
        return units.take(np.where(at < end[lane], at, none))

    every = np.arange(lanes)
    code = unit(every) << _UNIT
    code |= unit(every)
    span = np.full(lanes, (1 << 64) - 1, _U)
    ids = np.zeros((steps, lanes), np.int32)
    kept = np.zeros((5, _LEARN, lanes), np.int32)
    model = _Model(len(coded), vocabulary)
    before = earlier = np.zeros(lanes, np.int32)
    renewed = 0
    for at in range(0, steps, _LEARN):
        if at in _RENEW:
            model.renew(ids[renewed:at], cells=True)
            renewed = at
        model.mix()
        upto = min(at + _LEARN, steps)
        for step in range(at, upto):
            _, _, k, p, q = found = model.predict(before, earlier)
            second, both = model.second.take(k), model.both.take(k)
            part = span >> _U(_BITS)
            value = np.minimum(code // part, _U((1 << _BITS) - 1)).astype(np.int32)
            share = value >> _ZERO
            hit_2 = share < second
            symbol = np.where(hit_2, q, p) >> 2
            start = np.where(hit_2, 0, second)
            size = np.where(hit_2, second, both - second) << _ZERO
            start <<= _ZERO
            miss = np.flatnonzero(share >= both)
            if len(miss):
                above = both[miss]
                third = (1 << _SHARES) - above
                above <<= _ZERO
                # Exact: both numbers are far below 2 ** 53.
                rest = ((value[miss] - above) / third).astype(np.int32)
                begin = model.at_p[miss]
                rest += begin
                cell = model.find(rest)
                cum = model.flat.take(cell)
                weight = model.flat.take(cell + 1) - cum
                bucket = cell - model.at_0[miss]
                own = bucket < _OWN
                inner = np.where(own, 0, (((rest - cum + 1) << 6) - 1) // weight)
                x = weight * inner >> 6
                w = np.where(own, weight, (weight * (inner + 1) >> 6) - x)
                x += cum - begin
                symbol[miss] = np.where(own, bucket, _OWN + ((bucket - _OWN) << 6) + inner)
                start[miss] = above + third * x
                size[miss] = third * w
            code -= part * start.astype(_U)
            span = part * size.astype(_U)
            move = np.flatnonzero(span < _BOTTOM)
            if len(move):
                span[move] <<= _UNIT
                code[move] = code[move] << _UNIT | unit(move)
            ids[step] = symbol
            for own, x in zip(kept, found):
                own[step - at] = x
            earlier, before = before, symbol
        mine = ids[at:upto]
        mine[~real[at:upto]] = 0
        if mine.min() < 0 or mine.max() >= _OWN + ((model.buckets - _OWN) << 6):
            raise BlockError("a block's ids are out of range")
        model.learn(real[at:upto], mine, *kept[:, : upto - at])
    out = []
    for at, (n, crc) in zip(range(0, lanes, STREAMS), heads):
        got = ids[: lengths[at], at : at + STREAMS].T.ravel()[:n].astype(np.uint32)
        if zlib.crc32(got.astype("<u4").tobytes()) != crc:
            raise BlockError("a block's ids do not match its checksum")
        out.append(got)
    return out
