"""Token ids of whole texts by a public byte-level tokenizer."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

from issuerlake.llm import text as T

#: Pieces that a worker looks up first, about; beyond, those that do not come again are forgotten at the next time.
REMEMBERED = 300_000
#: Bytes of texts cut at once.
RUN = 1 << 20

_JOINED = re.compile(r"\s | \s")
_CUT = re.compile(r"(?<=\S)(?= \S)")
#: Blanks that texts are not cut at. Python knows some that pre-tokenizers do not, and no fewer.
_OTHER = re.compile(r"[^\S \n]")

_BYTE = np.arange(256)
_LETTER = ((_BYTE | 32) >= 0x61) & ((_BYTE | 32) <= 0x7A) & (_BYTE < 0x80)
_QUOTE = _BYTE == 0x27
_MARK = (_BYTE > 0x20) & (_BYTE < 0x7F) & ~_LETTER & ~((_BYTE >= 0x30) & (_BYTE <= 0x39)) & ~_QUOTE
_BLANK = (_BYTE == 0x20) | (_BYTE == 0x0A)
#: A byte's kinds, as bits: letter, mark, single quote, blank, line end.
_KINDS = (_LETTER + 2 * _MARK + 4 * _QUOTE + 8 * _BLANK + 16 * (_BYTE == 0x0A)).astype(np.uint8)


#: How a byte-level pre-tokenizer shows the bytes that are no visible characters of Latin-1, and its blank.
_SHOWN = np.arange(256, dtype="<u2")
_HIDDEN = (_BYTE < 0x21) | ((_BYTE > 0x7E) & (_BYTE < 0xA1)) | (_BYTE == 0xAD)
_SHOWN[_HIDDEN] = 256 + np.arange(_HIDDEN.sum())


def _cuts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a byte-level pre-tokenizer cuts whatever stands around (a part of all its cuts), in UTF-8 text whose blanks are " " and "\\n".

    Before a blank after no blank; between a letter and a mark (a quote may begin a
    contraction: only before it); after a single line end before a letter. Also gives
    the bytes of letters, as far as known here.
    """
    now = _KINDS[data]
    # Of two bytes, U+00C0 to U+00FF but two are letters: their last bytes when they come before, their first after.
    pair = data[:-1] == 0xC3
    letter = pair & (data[1:] != 0x97) & (data[1:] != 0xB7)
    now[:-1] |= letter
    before = now.copy()  # as the byte before another
    before[1:] |= letter
    cut = np.ones(len(data), bool)
    old, new = before[:-1], now[1:]
    cut[1:] = ((new & 8) > (old & 8)) | (((old & 1) != 0) & ((new & 6) != 0)) | (((old & 2) != 0) & ((new & 1) != 0))
    cut[2:] |= ((old[1:] & 16) != 0) & ((old[:-1] & 8) == 0) & ((new[1:] & 1) != 0)
    return cut, (before & 1).astype(bool)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes texts piece by piece: a byte-level pre-tokenizer always cuts before a single blank between two visible characters."""

    def __init__(self, model: str, plain: bool = False) -> None:
        """``model``: the text of a tokenizer file. ``plain``: special tokens' strings in a text are ordinary text."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = plain
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        parts = json.loads(model)
        cutter = parts.get("pre_tokenizer") or {}
        # Words may go to the model straight, byte by byte as the pre-tokenizer shows them.
        self.byte_level = not parts.get("normalizer") and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")

    @staticmethod
    def pieces(text: str) -> list[str]:
        if _JOINED.search(text) or text.startswith(" ") or text.endswith(" "):
            return _CUT.split(text)
        first, *others = text.split(" ")
        return [first, *[" " + x for x in others]]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit integers."""
        out: list[np.ndarray | None] = [None] * len(texts)
        run, size = [], 0
        for at, text in enumerate(texts):
            if _OTHER.search(text) or any(x in text for x in self.added):
                cut = [x.encode() for x in self.pieces(text)]
                different = list(set(cut))
                ends = np.cumsum([len(x) for x in different], dtype=np.int64)
                begin = ends - [len(x) for x in different] if different else ends
                known = dict(zip(different, self._ids(b"".join(different), begin, ends, np.zeros(len(ends), bool))))
                out[at] = np.frombuffer(b"".join([known[x] for x in cut]), "<u4")
                continue
            raw = text.encode()
            run.append((at, raw))
            size += len(raw)
            if size >= RUN:
                self._run(run, out)
                run, size = [], 0
        self._run(run, out)
        return out

    def _run(self, run: list[tuple[int, bytes]], out: list[np.ndarray | None]) -> None:
        """Ids of some texts, each of their different pieces looked up once."""
        raw = b"".join([x for _, x in run])
        bounds = np.concatenate([[0], np.cumsum([len(x) for _, x in run])]).astype(np.int64)
        if not raw:
            for at, _ in run:
                out[at] = np.zeros(0, "<u4")
            return
        data = np.frombuffer(raw, np.uint8)
        cut, letters = _cuts(data)
        cut[bounds[:-1][bounds[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        sizes = np.diff(starts, append=len(data))
        _, first, which = np.unique(T.hash_ranges(data, starts, sizes), return_index=True, return_inverse=True)
        # Equal hashes are compared byte by byte.
        same = starts[first]
        same = np.repeat(same[which] - starts, sizes) + np.arange(len(data))
        if (sizes != sizes[first][which]).any() or (data != data[same]).any():
            first, which = np.arange(len(starts)), np.arange(len(starts))
        others = np.concatenate([[0], np.cumsum(~letters)])
        begin = starts[first]
        ends = begin + sizes[first]
        words = (data[begin] == 0x20) & (ends - begin > 1) & (others[ends] - others[begin] == 1)
        ids = self._ids(raw, begin, ends, words)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        flat = np.frombuffer(b"".join(ids), "<u4")
        begins = (np.cumsum(lengths) - lengths)[which]
        lengths = lengths[which]
        ends = np.cumsum(lengths)
        flat = flat[np.repeat(begins - (ends - lengths), lengths) + np.arange(ends[-1])]
        ends = np.concatenate([[0], ends])[np.searchsorted(starts, bounds)]
        for (at, _), a, b in zip(run, ends[:-1].tolist(), ends[1:].tolist()):
            out[at] = flat[a:b]

    def _ids(self, raw: bytes, begin: np.ndarray, ends: np.ndarray, words: np.ndarray) -> list[bytes]:
        """Ids of different pieces of ``raw``. ``words``: a blank and letters, which a pre-tokenizer leaves as they are."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known = self.known
        begin, ends, words = begin.tolist(), ends.tolist(), words.tolist()
        shown = _SHOWN[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-16-le")
        pieces = [shown[a:b] for a, b in zip(begin, ends)]
        out = list(map(known.get, pieces))
        new = [i for i, x in enumerate(out) if x is None]
        if self.older:
            for i in new:
                x = self.older.get(pieces[i])
                if x is not None:
                    known[pieces[i]] = out[i] = x
            new = [i for i in new if out[i] is None]
        rest = new
        if self.byte_level:
            merge = self.tokenizer.model.tokenize
            for i in new:
                if words[i]:
                    ids = [t.id for t in merge(pieces[i])]
                    known[pieces[i]] = out[i] = b"".join([x.to_bytes(4, "little") for x in ids])
            rest = [i for i in new if not words[i]]
        for i, got in zip(rest, self.tokenizer.encode_batch([raw[begin[i] : ends[i]].decode() for i in rest], add_special_tokens=False)):
            known[pieces[i]] = out[i] = np.array(got.ids, "<u4").tobytes()
        return out


@lru_cache(maxsize=1)
def remembered(model: str) -> Encoder:
    """An encoder that the tasks of a worker share, with the pieces it knows."""
    return Encoder(model)
