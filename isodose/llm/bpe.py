"""Which two tokens of a byte-pair vocabulary may stand side by side.

A byte-pair encoding is fixed by its borders: a row of tokens is *the* encoding of its text
exactly if every two neighbours are the encoding of their joined text.  Hence every prefix of a
text has one encoding, and that has one last token; both encoders here walk texts by it.
Whether a border holds is found by undoing merges on either side of it, latest first: the border
breaks if at some moment the two symbols beside it could merge before one of them was made.
"""

from __future__ import annotations

import numpy as np


class Borders:
    """Merge tables of a vocabulary.

    ``rank``: the place of a token's merge, -1 for symbols no merge makes; ``left`` and ``right``:
    its two parts (-1 without).  No two tokens share a rank.
    """

    def __init__(self, rank: np.ndarray, left: np.ndarray, right: np.ndarray):
        self.rank, self.left, self.right = rank, left, right
        self._size = len(rank)
        made = np.flatnonzero(rank >= 0)
        codes = left[made].astype(np.int64) * self._size + right[made]
        order = np.argsort(codes)
        self._codes, self._ranks = codes[order], rank[made][order].astype(np.int64)
        self._pairs = dict(zip(self._codes.tolist(), self._ranks.tolist(), strict=True))
        self._lists = rank.tolist(), left.tolist(), right.tolist()

    def holds(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` stay as they are when their joined text is encoded."""
        rank, left, right = self._lists
        pairs, size = self._pairs, self._size
        limit = 1 << 62
        while True:
            merged = pairs.get(a * size + b)
            if merged is not None and 2 * merged < limit:
                return False
            if rank[a] > rank[b]:
                # ``a`` came last. Of two merges of one rank the left one goes first.
                limit, a = 2 * rank[a], right[a]
            elif rank[b] >= 0:
                limit, b = 2 * rank[b] + 1, left[b]
            else:
                return True

    def hold(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`holds` for arrays; each distinct pair is walked once."""
        code, inverse = np.unique(a.astype(np.int64) * self._size + b, return_inverse=True)
        a, b = code // self._size, code % self._size
        good = np.ones(len(code), bool)
        limit = np.full(len(code), 1 << 62, np.int64)
        at = np.arange(len(code))
        while len(at):
            found = np.searchsorted(self._codes, a * self._size + b)
            found[found == len(self._codes)] = 0
            merged = np.where(self._codes[found] == a * self._size + b, self._ranks[found], 1 << 61) if len(
                self._codes
            ) else np.full(len(at), 1 << 61)
            broken = 2 * merged < limit
            good[at[broken]] = False
            of_a, of_b = self.rank[a], self.rank[b]
            go = ~broken & ((of_a >= 0) | (of_b >= 0))
            undo_a = of_a > of_b
            limit = np.where(undo_a, 2 * of_a, 2 * of_b + 1)[go]
            a, b, at = np.where(undo_a, self.right[a], a)[go], np.where(undo_a, b, self.left[b])[go], at[go]
        return good[inverse.reshape(-1)]


class HashTable:
    """int64 keys to int32 values in open slots, looked up many at a time."""

    def __init__(self, bits: int):
        self._shift = np.uint64(64 - bits)
        self._mask = (1 << bits) - 1
        self._keys = np.full(1 << bits, -1, np.int64)
        self._values = np.zeros(1 << bits, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * _SPREAD) >> self._shift).astype(np.int64)

    def fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Store distinct keys for good; there must be more slots than keys."""
        slots = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self._keys[slots] == -1)
            # Of several keys for one free slot the first gets it.
            mine = free[np.unique(slots[free], return_index=True)[1]]
            self._keys[slots[mine]], self._values[slots[mine]] = keys[mine], values[mine]
            rest = np.ones(len(keys), bool)
            rest[mine] = False
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & self._mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Values; -1 for keys that were not stored."""
        slots = self._slots(keys)
        held = self._keys[slots]
        out = np.where(held == keys, self._values[slots], np.int32(-1))
        open_ = np.flatnonzero((held != keys) & (held != -1))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self._mask
            held = self._keys[slots[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self._values[slots[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out

    def recall(self, keys: np.ndarray) -> np.ndarray:
        """As :meth:`find` after :meth:`remember`: a later key may have taken the slot."""
        slots = self._slots(keys)
        return np.where(self._keys[slots] == keys, self._values[slots], np.int32(-1))

    def remember(self, keys: np.ndarray, values: np.ndarray) -> None:
        slots = self._slots(keys)
        # Slots first, so that equal slots keep one key with its own value.
        slots, at = np.unique(slots, return_index=True)
        self._keys[slots], self._values[slots] = keys[at], values[at]


_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Relaxation:
    """Left-to-right pass over the edges of many short texts at once.

    Texts lie in one row of slots, one for each end of a prefix.  An edge is a token between two
    slots.  It is relaxed if its border with the last token before it holds; exactly one edge
    into each slot is.
    """

    def __init__(self, borders: Borders, bits: int = 21):
        self._borders = borders
        self._known = HashTable(bits)

    def _hold(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = a.astype(np.int64) * len(self._borders.rank) + b
        known = self._known.recall(code)
        new = np.flatnonzero(known < 0)
        if len(new):
            found = self._borders.hold(a[new], b[new]).astype(np.int32)
            known[new] = found
            self._known.remember(code[new], found)
        return known > 0

    def run(self, source: np.ndarray, target: np.ndarray, token: np.ndarray, depth: np.ndarray, slots: int):
        """Per slot the last token, the number of tokens and the slot before; ``depth`` is an
        edge's distance from the start of its text."""
        last = np.full(slots, -1, np.int32)
        count, back = np.zeros(slots, np.int32), np.zeros(slots, np.int32)
        if not len(depth):
            return last, count, back
        deepest = int(depth.max())
        order = np.argsort(depth.astype(np.uint16 if deepest < 1 << 16 else np.int64), kind="stable")
        bounds = np.r_[0, np.cumsum(np.bincount(depth))]
        source, target, token = source[order], target[order], token[order]
        for d in range(deepest + 1):
            part = slice(bounds[d], bounds[d + 1])
            u, v, t = source[part], target[part], token[part]
            if d:
                before = last[u]
                good = np.flatnonzero(before >= 0)
                good = good[self._hold(before[good], t[good])]
                u, v, t = u[good], v[good], t[good]
            last[v], count[v], back[v] = t, count[u] + 1, u
        return last, count, back
