"""The coder's streams, cuts of texts against whole-text encoding, and joined checksums."""

from __future__ import annotations

import random
import zlib
from pathlib import Path

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from issuerlake.llm import coder  # noqa: E402
from issuerlake.llm.tokenfiles import join_crcs  # noqa: E402
from issuerlake.llm.tokens import Encoder, tokenizer_path  # noqa: E402


def test_streams_share_the_steps(monkeypatch):
    asked = []
    predict = coder._Model.predict
    monkeypatch.setattr(coder._Model, "predict", lambda self, *ids: asked.append(1) or predict(self, *ids))
    block = np.minimum(np.random.default_rng(2).zipf(1.2, coder.BLOCK), 50256)
    coded = coder.encode([block], 50257)
    assert len(asked) * 100 < coder.BLOCK  # a round's predictions at once
    asked.clear()
    assert (coder.decode(coded)[0] == block).all()
    assert len(asked) <= coder.BLOCK // 8  # eight streams in step


def test_short_blocks_beside_others():
    rng = np.random.default_rng(3)
    for kinds in (3, 50257):  # repeats, so that what follows padding would show
        blocks = [rng.integers(0, kinds, n) for n in [*range(1, 40), 127, 129, 513, 520, 1025, coder.BLOCK - 1, coder.BLOCK]]
        coded = coder.encode(blocks, 50257)
        for block, one, together in zip(blocks, coded, coder.decode(coded)):
            assert (together == block).all() and (coder.decode([one])[0] == block).all()


def test_damage_is_seen():
    rng = np.random.default_rng(4)
    coded = coder.encode([np.minimum(rng.zipf(1.3, 900), 50256)], 50257)[0]
    for at in range(0, len(coded), 7):
        with pytest.raises(coder.BlockError):
            coder.decode([coded[:at] + bytes([coded[at] ^ 64]) + coded[at + 1 :], coded])


@pytest.mark.parametrize("plain", [False, True])
def test_cuts_keep_the_ids(plain):
    rng = random.Random(5)
    common = ["a", "b", "Z", "é", "×", "÷", "ñ", " ", "  ", "\n", "\n\n", ".", "%", "'", "'s", "'ll", "’", "。", "漢", "1", "_", "Ã"]
    odd = ["\t", "\xa0", "\x1c", " ", "<|endoftext|>", "<|", "|>", "endoftext", "\x7f", "\x00", "\r", "\xad", "—"]
    texts = ["".join(rng.choice(common if n % 2 else common + odd) for _ in range(rng.randint(0, 30))) for n in range(6000)]
    encoder = Encoder(Path(tokenizer_path()).read_text(), plain)
    for _ in range(2):  # unknown pieces, then known ones
        got = encoder.encode(texts)
        assert [x.tolist() for x in got] == [x.ids for x in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        encoder.known, encoder.older = {}, encoder.known


def test_checksums_are_joined_together():
    rng = np.random.default_rng(6)
    parts = [(rng.bytes(a), rng.bytes(b)) for a, b in [(0, 0), (3, 0), (0, 5), (7, 16384), (100, 12345)]]
    first, second, whole = (np.array([zlib.crc32(x) for x in xs]) for xs in ([a for a, _ in parts], [b for _, b in parts], [a + b for a, b in parts]))
    assert (join_crcs(first, second, np.array([len(b) for _, b in parts])) == whole).all()
