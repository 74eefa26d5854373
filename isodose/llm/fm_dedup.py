"""Exact removal of word passages that occur more than once, by FM-indexes per shard.

Windows of ``length`` consecutive words are judged.  A window belongs to its *anchor*, the
``ANCHOR``-word gram in it with the smallest hash; neighbouring windows with one anchor form a
segment.  Equal windows have equal anchors, so it is enough to compare segments whose anchors are
equal, and an anchor that occurs once leaves its windows unique.

1. Blocks of documents ask how often their anchors occur (:mod:`.exchange`).
2. Segments of repeated anchors go, each distinct one once per block with its multiplicity, to
   the shard of their anchor.
3. A shard builds a compressed FM-index of its segments: the Burrows-Wheeler transform in a
   wavelet matrix of packed bits.  The segments are streamed through backward search, which
   yields the longest matches that occur twice; those of ``length`` words and more are reported.
4. Blocks merge the reported words and cut them out.

Anchors with very many segments, as at the edges of a passage that a large part of the corpus
holds, are split: their windows travel one by one, to shards chosen by the whole window.
"""

from __future__ import annotations

import hashlib
import re
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_list, block_of, blocks_for, mix, pick, starts_of, text_bytes
from .exchange import ask_and_answer, bucket_bounds, pack, unpack

ANCHOR = 8
#: Anchors with more segments than this are split into windows.
SPLIT = 20_000
#: The lowest 0 to 63 bits of a word.
_BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)
_SHARD = np.uint64(0x5A4D5A4D5A4D5A4F)
_WHOLE = np.uint64(0x3C6EF372FE94F82B)
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class _Block:
    """Words of a block's texts as 64-bit codes, its windows and their segments."""

    def __init__(self, texts: list[bytes | None], length: int):
        lengths = np.zeros(len(texts), np.int64)
        parts = [np.zeros(0, np.uint64)]
        for i, text in enumerate(texts):
            if text:
                words = text.split()
                lengths[i] = len(words)
                parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        self.codes = np.concatenate(parts)
        self.length = length
        size = len(self.codes) - length + 1
        owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        if size <= 0 or not (owner[:size] == owner[length - 1 :]).any():
            self.first = self.last = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            return
        least, place = _least(_grams(self.codes), length - ANCHOR + 1)
        whole = owner[:size] == owner[length - 1 :]
        moved = place[1:] != place[:-1]
        # A segment starts where the anchor's place changes or the window before it is not whole.
        begin = whole & np.r_[True, moved | ~whole[:-1]]
        end = whole & np.r_[moved | ~whole[1:], True]
        self.first, self.last = np.flatnonzero(begin), np.flatnonzero(end)
        self.anchor = mix(least[self.first], _SHARD)

    def split(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words and numbers of windows, one segment per window."""
        counts = (self.last - self.first + 1)[which]
        first = np.repeat(self.first[which], counts) + _within(counts)
        return first, np.ones(len(first), np.int64)

    def content(self, first: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Hash of the words of each range."""
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.r_[np.uint64(1), np.full(len(self.codes), _WHOLE)])
            inverse = np.uint64(pow(int(_WHOLE), -1, 1 << 64))
            back = np.cumprod(np.r_[np.uint64(1), np.full(len(self.codes), inverse)])
            sums = np.r_[np.uint64(0), np.cumsum(self.codes * powers[:-1])]
            return mix((sums[first + words] - sums[first]) * back[first], words.astype(np.uint64))


def _grams(codes: np.ndarray) -> np.ndarray:
    """Hash of the ``ANCHOR`` words from each place on, from hashes of halves."""
    width = 1
    while width < ANCHOR:
        codes = mix(codes[:-width], codes[width:])
        width *= 2
    return codes


def _least(values: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of ``reach`` values from each place on, and where it first stands; by doubled widths."""
    place = np.arange(len(values), dtype=np.int32)
    width = 1
    while width < reach:
        step = min(width, reach - width)
        later = values[step:] < values[:-step]
        place = np.where(later, place[step:], place[:-step])
        values = np.minimum(values[:-step], values[step:])
        width += step
    return values, place


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. count - 1 for each count, in one row."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _ranges(values: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return values[np.repeat(first, counts) + _within(counts)]


class WaveletMatrix:
    """Rank of symbols in a sequence, on packed bits with a count every 64."""

    def __init__(self, symbols: np.ndarray):
        self._bits = max(1, int(symbols.max()).bit_length()) if len(symbols) else 1
        self._levels = []
        for bit in range(self._bits - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            packed = np.packbits(np.r_[ones, np.zeros(-len(ones) % 64 + 64, bool)], bitorder="little").view(np.uint64)
            before = np.r_[0, np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]]
            self._levels.append((bit, packed, before, int(len(ones) - ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        # Equal symbols now stand together, in the order of their bits read backward.
        order = np.zeros(1, np.int64)
        for _ in range(self._bits):
            order = np.concatenate([2 * order, 2 * order + 1])
        counts = np.bincount(symbols, minlength=len(order))
        self._start = np.empty(len(order), np.int64)
        self._start[order] = np.cumsum(counts[order]) - counts[order]

    def ranks(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol occurs before ``low`` and before ``high``."""
        n = len(symbol)
        places, both = np.concatenate([low, high]), np.concatenate([symbol, symbol])
        for bit, packed, before, zeros in self._levels:
            word = places >> 6
            ones = before.take(word) + np.bitwise_count(packed.take(word) & _BELOW.take(places & 63))
            places = np.where(both & (1 << bit), ones + zeros, places - ones)
        start = self._start[symbol]
        return places[:n] - start, places[n:] - start


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of small numbers, by doubling; only suffixes that still tie are sorted again.

    The first sort takes as many numbers as a key holds.  A rank is where a suffix's ties start.
    """
    size = len(text)
    bits = int(text.max() + 1).bit_length() if size else 1
    step = max(1, min(63 // bits, size))
    key = np.zeros(size, np.int64)
    for k in range(step):  # behind the end: 0
        key <<= bits
        key[: size - k] |= text[k:] + 1
    order = np.argsort(key)
    at, rank = np.arange(size), np.empty(size, np.int64)
    tied, key = order, key[order]
    while len(at):
        new = np.r_[True, key[1:] != key[:-1]]
        rank[tied] = np.repeat(at[new], np.diff(np.r_[np.flatnonzero(new), len(at)]))
        alike = ~(new & np.r_[new[1:], True])
        at = at[alike]
        tied = tied[alike]
        behind = tied + step
        key = rank[tied] * (size + 1)
        inside = behind < size
        key[inside] += rank[behind[inside]] + 1
        by_key = np.argsort(key)
        tied, key = tied[by_key], key[by_key]
        order[at] = tied
        step *= 2
    return order


class FMIndex:
    """Backward search over weighted segments; an interval's weight is its number of occurrences."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, weights: np.ndarray):
        """``symbols``: from 1, all segments in one row.  Each segment ends in a symbol of its own."""
        ends = np.cumsum(lengths + 1) - 1
        text = np.empty(len(symbols) + len(lengths), np.int64)
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = symbols + len(lengths)
        text[ends] = np.arange(len(lengths))
        order = suffix_array(text)
        plain = np.zeros(len(text), np.int64)
        plain[inside] = symbols
        self._tree = WaveletMatrix(plain[order - 1])
        top = int(symbols.max()) if len(symbols) else 0
        self._before = np.r_[0, np.cumsum(np.bincount(plain, minlength=top + 1))]
        self._weight = np.r_[0, np.cumsum(np.repeat(weights, lengths + 1)[order])]
        self.size = len(text)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` put in front."""
        a, b = self._tree.ranks(symbol, low, high)
        return self._before[symbol] + a, self._before[symbol] + b

    def weight(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return self._weight[high] - self._weight[low]


def repeated_windows(index: FMIndex, symbols: np.ndarray, at: np.ndarray, lengths: np.ndarray, length: int) -> np.ndarray:
    """Per streamed segment a mask: bit i is set if word i lies in a window that occurs twice.

    ``left..right`` are the windows not yet decided.  A search backward from the end of the last
    one either reaches past that window's start, deciding all windows on its way, or strikes it
    out.  The next search starts from the end of the first window and strikes out, where it
    fails, all windows that hold the failing pattern: with one changed word in all of them, all.
    """
    n = len(lengths)
    masks = np.zeros(n, np.uint64)
    left, right = np.zeros(n, np.int64), lengths - length
    active = np.flatnonzero(right >= 0)
    from_left = np.zeros(n, bool)
    end = right + length - 1
    place = end.copy()  # the word that comes next in front
    low, high = np.zeros(n, np.int64), np.full(n, index.size)
    while len(active):
        a = active
        new_low, new_high = index.extend(symbols[at[a] + place[a]], low[a], high[a])
        good = index.weight(new_low, new_high) > 1
        low[a], high[a] = new_low, new_high
        goal = left[a]
        over = ~good | (place[a] <= goal)
        place[a] -= good
        done, ok = a[over], good[over]
        if len(done):
            # place: one before the first matching word, or the word that failed.
            match = place[done] + 1
            back = ~from_left[done]
            full = end[done] - match + 1 >= length
            for rows, lo, hi in ((done[full], match[full], end[done][full]),):
                width = (hi - lo + 1).astype(np.uint64)
                masks[rows] |= ((np.uint64(1) << width) - np.uint64(1)) << lo.astype(np.uint64)
            # Backward from the last window: all from ``match`` on are decided, at least that one.
            b = done[back]
            right[b] = np.minimum(right[b] - 1, match[back] - 1)
            # From the first window: it is decided, and where it failed all that hold the failure.
            f = done[~back]
            left[f] = np.where(full[~back], left[f] + 1, match[~back])
            from_left[done] = back
            end[done] = np.where(from_left[done], left[done], right[done]) + length - 1
            place[done], low[done], high[done] = end[done], 0, index.size
            stay = np.ones(len(a), bool)
            stay[np.flatnonzero(over)[left[done] > right[done]]] = False
            active = a[stay]
    return masks


def _ask_anchors(block: _Block, buckets: int) -> list[bytes]:
    keys, counts = np.unique(block.anchor, return_counts=True)
    at = bucket_bounds(keys, buckets)
    counts = np.minimum(counts, 1 << 30).astype(np.uint32)
    return [pack(keys[a:b], counts[a:b]) if b > a else b"" for a, b in zip(at, at[1:], strict=False)]


def _answer_anchors(split: int, notes: list[bytes]) -> list[bytes]:
    """0: the anchor occurs once; 1: more often; 2: so often that its segments are split."""
    opened = [unpack(n, np.uint64, np.uint32) for n in notes]
    keys = np.concatenate([k for k, _ in opened])
    _, inverse = np.unique(keys, return_inverse=True)
    total = np.bincount(inverse.reshape(-1), np.concatenate([c for _, c in opened]).astype(np.float64))
    kind = ((total > 1).astype(np.uint8) + (total > split))[inverse.reshape(-1)].astype(np.uint8)
    at = starts_of(np.array([len(k) for k, _ in opened]))
    return [kind[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]


def _segments(block: _Block, answers: list[bytes], buckets: int) -> list[bytes]:
    """Per shard: distinct segments with multiplicities, and where the block has them."""
    keys = np.unique(block.anchor)
    kind = np.frombuffer(b"".join(answers), np.uint8)[np.searchsorted(keys, block.anchor)] if len(keys) else np.zeros(0, np.uint8)
    once, hot = kind == 1, kind == 2
    first, windows = block.split(hot)
    first = np.r_[block.first[once], first]
    words = np.r_[(block.last - block.first + 1)[once], windows] + block.length - 1
    content = block.content(first, words) if len(first) else np.zeros(0, np.uint64)
    shard_key = np.r_[block.anchor[once], mix(content[once.sum() :], _SHARD)] if len(first) else content
    _, chosen, inverse, counts = np.unique(content, return_index=True, return_inverse=True, return_counts=True)
    order = np.argsort(shard_key[chosen], kind="stable")
    at = bucket_bounds(shard_key[chosen][order], buckets)
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    occurrence = number[inverse.reshape(-1)]
    by_segment = np.argsort(occurrence, kind="stable")
    starts, per_segment = first[by_segment].astype(np.uint32), counts[order].astype(np.uint32)
    ends = np.r_[0, np.cumsum(per_segment)]
    out = []
    for a, b in zip(at, at[1:], strict=False):
        if a == b:
            out.append(b"")
            continue
        mine = chosen[order[a:b]]
        codes = _ranges(block.codes, first[mine], words[mine])
        out.append(
            pack(
                content[mine],
                words[mine].astype(np.uint8),
                per_segment[a:b],
                starts[ends[a] : ends[b]],
                (codes & np.uint64(0xFFFFFFFF)).astype(np.uint32),
                (codes >> np.uint64(48)).astype(np.uint16),
            )
        )
    return out


_SEGMENT_KINDS = (np.uint64, np.uint8, np.uint32, np.uint32, np.uint32, np.uint16)


def _answer_segments(length: int, notes: list[bytes]) -> list[bytes]:
    """A shard's work: for each block where its repeated words are, as start, mask pairs."""
    opened = [unpack(n, *_SEGMENT_KINDS) for n in notes]
    content = np.concatenate([o[0] for o in opened])
    words = np.concatenate([o[1] for o in opened]).astype(np.int64)
    counts = np.concatenate([o[2] for o in opened]).astype(np.int64)
    codes = np.concatenate([o[4].astype(np.uint64) | o[5].astype(np.uint64) << np.uint64(32) for o in opened])
    _, chosen, inverse = np.unique(content, return_index=True, return_inverse=True)
    inverse = inverse.reshape(-1)
    weights = np.bincount(inverse, counts).astype(np.int64)
    lengths = words[chosen]
    symbols = _ranges(codes, (np.cumsum(words) - words)[chosen], lengths)
    symbols = np.unique(symbols, return_inverse=True)[1].reshape(-1).astype(np.int64) + 1
    masks = np.full(len(chosen), 0, np.uint64)
    # A segment that itself occurs twice is repeated from end to end.
    twice = weights > 1
    masks[twice] = (np.uint64(1) << lengths[twice].astype(np.uint64)) - np.uint64(1)
    if not twice.all():
        index = FMIndex(symbols, lengths, weights)
        at = np.cumsum(lengths) - lengths
        masks[~twice] = repeated_windows(index, symbols, at[~twice], lengths[~twice], length)
    found = masks[inverse]
    sizes = starts_of(np.array([len(o[0]) for o in opened]))
    out = []
    for o, a, b in zip(opened, sizes, sizes[1:], strict=False):
        mask = np.repeat(found[a:b], o[2])
        out.append(pack(o[3][mask > 0], mask[mask > 0]) if mask.any() else b"")
    return out


def _cut(text: bytes, removed: np.ndarray) -> bytes:
    """The text without the removed words and the white space behind them; the rest as it was."""
    spans = [m.span() for m in _WORD.finditer(text)]
    parts, at = [], 0
    gone = np.flatnonzero(np.diff(np.r_[False, removed, False].astype(np.int8)))
    for a, b in zip(gone[::2], gone[1::2], strict=True):
        parts.append(text[at : spans[a][0]])
        at = spans[b][0] if b < len(spans) else len(text)
    return b"".join([*parts, text[at:]])


def _remove(texts: list[bytes | None], answers: list[bytes], whole_text: bool) -> tuple[np.ndarray, list, list, list]:
    """Words per text, how many go, and the digests of what is left or the texts without them.

    Answers name words by their place in the block: neither codes nor windows are needed again.
    """
    # A text of n bytes has at most (n + 1) // 2 words.
    removed = np.zeros(sum((len(text or b"") + 1) // 2 for text in texts), bool)
    for note in answers:
        if note:
            starts, masks = unpack(note, np.uint32, np.uint64)
            for k in range(64):
                removed[starts[masks >> np.uint64(k) & np.uint64(1) > 0].astype(np.int64) + k] = True
    lengths = np.zeros(len(texts), np.int64)
    lost, digests, out = [], [], []
    at = 0
    for i, text in enumerate(texts):
        words = (text or b"").split()
        lengths[i] = len(words)
        mine = removed[at : at + len(words)]
        at += len(words)
        n = int(np.count_nonzero(mine))
        lost.append(n)
        if whole_text:
            out.append(_cut(text, mine) if n else text)
        else:
            if n:
                words = compress(words, (~mine).tolist())
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
    return lengths, lost, digests, out


def deduplicate(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    length: int = 35,
    whole_text: bool = False,
    split: int = SPLIT,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: id, ``n_words``, ``n_removed`` and ``kept_sha256`` (of the kept words, joined by one
    space) or, with ``whole_text``, ``kept_text``; also the columns ``keep``.

    A word is removed if it lies in a window of ``length`` words (8 to 35) whose sequence also
    starts elsewhere, in this text or another.  Windows are judged on the input.  Null texts have
    no words (``kept_text`` stays null); shorter texts have no windows; repeated rows repeat each
    other's windows.  Very long texts are cut like any other.  Other columns are not looked at.
    """
    if not ANCHOR <= length <= 35:
        raise ValueError("length must be from 8 to 35 words")  # masks have 64 bits
    names = [f"_{i}" for i in range(len(keep))]
    rows = docs.select(
        F.col(ident).alias("ident"), F.col(text).cast("string").alias("text"), *(F.col(k).alias(n) for k, n in zip(keep, names, strict=True))
    )
    blocks = blocks_for(docs.sparkSession, text_bytes(rows))
    # The passes exchange positions in a block's words.  Only texts matter for them, so rows of one
    # text may change places; its hash goes first because it is quick to sort by.
    rows = rows.withColumn("block", block_of(blocks, "ident", "text")).withColumn("text_hash", F.xxhash64("text"))

    def ask(table):
        return _ask_anchors(_Block(binary_list(table["text"]), length), blocks)

    def again(table, answers):
        return _segments(_Block(binary_list(table["text"]), length), answers, blocks)

    def finish(table, answers):
        lengths, lost, digests, out = _remove(binary_list(table["text"]), answers, whole_text)
        last = pa.array(out, pa.binary()).cast(pa.string()) if whole_text else pa.array(digests, pa.string())
        columns = [table["ident"], pa.array(lengths), pa.array(lost, pa.int64()), last, *(table[n] for n in names)]
        return pa.table(columns, names=["ident", "n_words", "n_removed", "kept", *names])

    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"ident {fields['ident']}, n_words long, n_removed long, kept string" + "".join(f", {n} {fields[n]}" for n in names)
    out = ask_and_answer(
        rows,
        [(ask, lambda notes: _answer_anchors(split, notes)), (again, lambda notes: _answer_segments(length, notes))],
        finish,
        blocks,
        schema,
        order=("text_hash", "text"),
    )
    return out.withColumnsRenamed({"ident": ident, "kept": "kept_text" if whole_text else "kept_sha256"} | dict(zip(names, keep, strict=True)))


def cut_repeats(docs: DataFrame, ident: str = "doc_id", text: str = "text", length: int = 35) -> DataFrame:
    """The documents, all columns, with repeated passages cut out of their texts."""
    others = tuple(c for c in docs.columns if c not in (ident, text))
    out = deduplicate(docs, ident, text, length, whole_text=True, keep=others)
    return out.withColumnRenamed("kept_text", "_kept").select(*(F.col("_kept").alias(c) if c == text else F.col(c) for c in docs.columns))
