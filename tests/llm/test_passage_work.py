"""How much the passes of the passage index do, counted, and their results against brute force."""

import hashlib
import random

import numpy as np
import pytest
from conftest import words

from isodose.llm import fm_dedup

LENGTH = 35


def texts_of(rng, n):
    return [None, b"", *(" ".join(words(rng, rng.randint(0, 150))).encode() for _ in range(n)), b" \n a  b"]


@pytest.mark.parametrize("length", [8, 9, 20, 35])
def test_segments_by_hand(length):
    texts = [*texts_of(random.Random(3), 40), b"x " * 100]
    block = fm_dedup._Block(texts, length)
    codes, first, at = [], [], 0
    for text in texts:
        mine = [fm_dedup.xxhash.xxh3_64_intdigest(w) for w in (text or b"").split()]
        codes += mine
        first += range(at, at + len(mine) - length + 1)
        at += len(mine)
    assert block.codes.tolist() == codes
    grams = fm_dedup._grams(block.codes).tolist()
    reach = length - fm_dedup.ANCHOR + 1
    place = {i: min(range(i, i + reach), key=lambda k: (grams[k], k)) for i in first}
    begin = [i for i in first if place.get(i - 1) != place[i]]
    end = [i for i in first if place.get(i + 1) != place[i]]
    assert (block.first.tolist(), block.last.tolist()) == (begin, end)
    assert len({grams[place[i]] for i in begin}) == len(set(block.anchor.tolist()))


def test_a_block_is_hashed_few_times(monkeypatch):
    texts = texts_of(random.Random(4), 200)
    hashed = []
    mix = fm_dedup.mix
    monkeypatch.setattr(fm_dedup, "mix", lambda left, right: hashed.append(len(left)) or mix(left, right))
    block = fm_dedup._Block(texts, LENGTH)
    assert sum(hashed) <= 4 * len(block.codes)


def test_words_are_cut_without_their_codes(monkeypatch):
    texts = texts_of(random.Random(5), 30)
    counts = [len((t or b"").split()) for t in texts]
    starts = np.cumsum([0, *counts])
    long = [i for i, n in enumerate(counts) if n > 70]
    note = fm_dedup.pack(starts[long].astype(np.uint32), np.full(len(long), ((1 << 36) - 1) << 3, np.uint64))
    monkeypatch.delattr(fm_dedup, "mix")
    monkeypatch.delattr(fm_dedup, "xxhash")
    lengths, lost, digests, _ = fm_dedup._remove(texts, [b"", note], False)
    assert (lengths.tolist(), lost) == (counts, [36 * (i in long) for i in range(len(texts))])
    kept = [(t or b"").split()[:3] + (t or b"").split()[39:] if i in long else (t or b"").split() for i, t in enumerate(texts)]
    assert digests == [hashlib.sha256(b" ".join(w)).hexdigest() for w in kept]
    _, _, _, out = fm_dedup._remove(texts, [b"", note], True)
    assert [t if t is None else t.split() for t in out] == [None if t is None else w for t, w in zip(texts, kept, strict=True)]


def test_a_changed_word_strikes_out_its_windows(monkeypatch):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(60):
        row = rng.integers(1, 400, 62)
        rows.append(row)
        rows.append(row.copy())
        rows[-1][rng.integers(28, 34)] = 400 + i  # in every window
    rows.append(rows[0][:50])
    symbols, lengths = np.concatenate(rows), np.array([len(r) for r in rows])
    index = fm_dedup.FMIndex(symbols, lengths, np.ones(len(rows), np.int64))
    steps = []
    extend = fm_dedup.FMIndex.extend
    monkeypatch.setattr(fm_dedup.FMIndex, "extend", lambda self, s, *range_: steps.append(len(s)) or extend(self, s, *range_))
    masks = fm_dedup.repeated_windows(index, symbols, np.cumsum(lengths) - lengths, lengths, LENGTH)
    whole = (1 << 50) - 1
    assert masks.tolist() == [whole, *[0] * 119, whole]
    assert sum(steps) <= 2 * symbols.size


def test_suffixes_in_order():
    rng = np.random.default_rng(8)
    rows = [rng.integers(0, top, n) for n in (1, 2, 7, 300) for top in (1, 2, 5, 1 << 20, 1 << 40)]
    for row in [*rows, np.zeros(0, np.int64), np.tile([3, 0, 1], 60)]:
        text = row.tolist()
        assert fm_dedup.suffix_array(row).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_symbols_that_do_not_occur():
    symbols = np.array([5, 1, 5, 9, 1, 5])
    tree = fm_dedup.WaveletMatrix(symbols)
    for symbol in range(16):
        for low in range(7):
            a, b = tree.ranks(np.array([symbol]), np.array([low]), np.array([6]))
            assert (a[0], b[0]) == ((symbols[:low] == symbol).sum(), (symbols == symbol).sum())
