"""op13: words are cut into parts in one go, and a failure leaves no word numbered without its ids."""

from __future__ import annotations

import numpy as np
import pytest

from shelfscope.llm import packing

TEXTS = [b"don't I'LL x's'S !'s 12ab a-b", b"a\x00b c<|d \x7f \x01 a\x01b <|endoftext|>", "é ü ÀB'S 中文 x".encode(), b"", b"< | <| a"]


def test_plain_words_are_cut_in_one_call(monkeypatch):
    calls, cut = [], packing.PARTS
    monkeypatch.setattr(packing, "PARTS", lambda text: calls.append(1) or cut(text))
    encoder = packing.WordEncoder(packing.default_vocabulary())
    ids, sizes = encoder.encode(TEXTS)
    assert len(calls) == 1
    at = 0
    for text, n in zip(TEXTS, sizes.tolist()):
        whole = encoder.tokenizer.encode(" ".join(w.decode() for w in text.split()), add_special_tokens=False).ids
        assert ids[at:at + n].tolist() == [*whole, packing.END_ID]
        at += n
    again, _ = encoder.encode(TEXTS[::-1])
    assert len(calls) == 1 and sorted(again.tolist()) == sorted(ids.tolist())


def test_a_failure_leaves_no_numbers(monkeypatch):
    encoder = packing.WordEncoder(packing.default_vocabulary())
    want = encoder.encode(TEXTS)
    other = packing.WordEncoder(packing.default_vocabulary())
    with monkeypatch.context() as m:
        m.setattr(other, "plain_ids", lambda words: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            other.encode(TEXTS)
    assert all(np.array_equal(a, b) for a, b in zip(other.encode(TEXTS), want))
