"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch are laid out as one text and indexed by a suffix array.  Every
piece of the vocabulary finds its range of occurrences by binary search; the occurrences are the
edges of a lattice over the text, and sorted by position they are relaxed from left to right.
The models handled are byte-pair ones with byte fallback, whose encoding is not a cheapest path:
an edge is relaxed if its border with the piece before it would survive the merges (see
:mod:`.bpe`), and every position then has exactly one last piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Borders, Relaxation
from .common import batches, pick

_SPACE = "▁"
#: Documents encoded together.
BATCH = 600


def _read_model(path: str) -> tuple[list[str], list[int]]:
    """Piece texts and kinds (1 normal, 6 byte) of a model file."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    size = processor.get_piece_size()
    texts = [processor.id_to_piece(i) for i in range(size)]
    kinds = [
        6 if processor.is_byte(i) else 0 if processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i) else 1
        for i in range(size)
    ]
    return texts, kinds


def _last_merge(chars: str, rank: dict[str, int]) -> tuple[str, str] | None:
    """The two parts from which merging by rank makes ``chars``; None if it never does."""
    parts = list(chars)
    while len(parts) > 2:
        ranks = [rank.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:], strict=False)]
        best = min(ranks)
        if best == 1 << 60:
            return None
        i = ranks.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def _key(raw: list[bytes], start: int) -> np.ndarray:
    """Bytes start to start + 8 as big-endian numbers, short ones padded with 0."""
    return np.frombuffer(b"".join(r[start : start + 8].ljust(8, b"\0") for r in raw), ">u8").astype(np.uint64)


def _bisect(values: np.ndarray, low: np.ndarray, high: np.ndarray, keys: np.ndarray, right: bool) -> np.ndarray:
    """``searchsorted`` of each key within its own range of ``values``."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        held = values[np.minimum(middle, len(values) - 1)]
        up = open_ & ((held <= keys) if right else (held < keys))
        low[up] = middle[up] + 1
        down = open_ & ~up
        high[down] = middle[down]
    return low


class PieceCodec:
    """Encoder and decoder of one model."""

    def __init__(self, path: str):
        texts, kinds = _read_model(path)
        self.size = len(texts)
        normal = [i for i, k in enumerate(kinds) if k == 1]
        ident = {texts[i]: i for i in normal}
        self._byte = np.array([ident.get(f"<0x{b:02X}>", 0) for b in range(256)], np.int32)
        for i, k in enumerate(kinds):
            if k == 6:
                self._byte[int(texts[i][3:5], 16)] = i
        # Runs of spaces have the lowest rank of all and no order among them: see _join_spaces.
        self._runs = {len(t): i for t, i in ident.items() if set(t) == {_SPACE}}
        pieces = {t: i for t, i in ident.items() if len(t) == 1 or set(t) != {_SPACE}}
        rank, left, right = (np.full(self.size + 1, -1, np.int64) for _ in range(3))
        usable = []
        ranks = {t: i for t, i in pieces.items() if len(t) > 1}
        for text, i in pieces.items():
            if len(text) > 1:
                parts = _last_merge(text, ranks)
                if parts is None or parts[0] not in pieces or parts[1] not in pieces:
                    continue
                rank[i], left[i], right[i] = i, pieces[parts[0]], pieces[parts[1]]
            usable.append(text)
        self._relaxation = Relaxation(Borders(rank, left, right))
        raw = [t.encode() for t in usable]
        self._ids = np.array([pieces[t] for t in usable], np.int32)
        self._sizes = np.array([len(r) for r in raw], np.int64)
        self._keys = [_key(raw, 8 * k) for k in range(-(-int(self._sizes.max()) // 8))]
        plain = [(t.replace(_SPACE, " ").encode() if k == 1 else b"") for t, k in zip(texts, kinds, strict=True)]
        for byte, i in enumerate(self._byte):
            plain[i] = bytes([byte]) if kinds[i] == 6 else plain[i]
        self._plain_sizes = np.array([len(p) for p in plain], np.int64)
        self._plain_at = np.cumsum(self._plain_sizes) - self._plain_sizes
        self._plain = np.frombuffer(b"".join(plain), np.uint8)

    def _edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of all occurrences of all pieces in the text (0 parts its words)."""
        wide = np.zeros(len(text) + 8 * len(self._keys) + 8, np.uint8)
        wide[: len(text)] = text
        at = np.flatnonzero(text)

        def eight(start: np.ndarray) -> np.ndarray:
            out = np.zeros(len(start), np.uint64)
            for k in range(8):
                out = out << np.uint64(8) | wide[start + k]
            return out

        first = eight(at)
        # Bytes behind a word's end belong to other words: they sort behind, and pieces hold no 0.
        second = eight(at + 8)
        order = np.lexsort((second, first))
        suffix, first, second = at[order], first[order], second[order]

        size = np.minimum(self._sizes, 8)
        span = (np.uint64(1) << (np.uint64(64) - 8 * size.astype(np.uint64))) - np.uint64(1)
        span[size == 8] = 0
        low = np.searchsorted(first, self._keys[0], "left")
        high = np.searchsorted(first, self._keys[0] | span, "right")
        longer = np.flatnonzero((self._sizes > 8) & (high > low))
        if len(longer):
            size = np.minimum(self._sizes[longer] - 8, 8)
            span = (np.uint64(1) << (np.uint64(64) - 8 * size.astype(np.uint64))) - np.uint64(1)
            span[size == 8] = 0
            key = self._keys[1][longer]
            low[longer], high[longer] = (
                _bisect(second, low[longer], high[longer], key, False),
                _bisect(second, low[longer], high[longer], key | span, True),
            )
        counts = np.maximum(high - low, 0)
        number = np.repeat(np.arange(len(counts)), counts)
        place = suffix[np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(len(number))]
        for k in range(2, len(self._keys)):
            # The few pieces of more than 16 bytes: the rest is compared as it stands.
            rest = np.flatnonzero(self._sizes[number] > 8 * k)
            if len(rest):
                cut = np.uint64(8) * np.minimum(8 * (k + 1) - self._sizes[number[rest]], 8).clip(0).astype(np.uint64)
                wrong = (eight(place[rest] + 8 * k) >> cut) != (self._keys[k][number[rest]] >> cut)
                keep = np.ones(len(number), bool)
                keep[rest[wrong]] = False
                number, place = number[keep], place[keep]
        return place, number

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one row, and how many each word has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        place, number = self._edges(text)
        inside = np.ones(len(text), bool)
        inside[ends] = False
        heads = np.flatnonzero(inside & ((text & 0xC0) != 0x80))
        width = 1 + (text[heads] >= 0xC0) + (text[heads] >= 0xE0) + (text[heads] >= 0xF0)
        covered = np.zeros(len(text), bool)
        # A character without a piece of its own becomes an edge of its own.
        single = self._sizes[number] == 1 + (text[place] >= 0xC0) + (text[place] >= 0xE0) + (text[place] >= 0xF0)
        covered[place[single]] = True
        lone = ~covered[heads]
        source = np.concatenate([place, heads[lone]])
        target = np.concatenate([place + self._sizes[number], heads[lone] + width[lone]])
        token = np.concatenate([self._ids[number], np.full(int(lone.sum()), self.size, np.int32)])
        first = np.repeat(starts, lengths + 1)
        last, count, back = self._relaxation.run(source, target, token, source - first[source], len(text))

        pieces = count[ends].astype(np.int64)
        offset = np.cumsum(pieces) - pieces
        ids, begin, size = (np.zeros(int(pieces.sum()), np.int64) for _ in range(3))
        at, word = ends.copy(), np.arange(len(ends))
        while len(at):
            more = at > starts[word]
            at, word = at[more], word[more]
            slot = offset[word] + count[at] - 1
            ids[slot], begin[slot], size[slot] = last[at], back[at], at - back[at]
            at = back[at].astype(np.int64)
        # Characters without a piece are written byte by byte.
        repeat = np.where(ids == self.size, size, 1)
        wide = np.repeat(ids, repeat)
        shift = np.arange(len(wide)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        raw = text[np.repeat(begin, repeat) + shift]
        wide = np.where(wide == self.size, self._byte[raw], wide).astype(np.int32)
        owner = np.repeat(np.arange(len(words)), pieces)
        return wide, np.bincount(owner, repeat, minlength=len(words)).astype(np.int64)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; none for null and empty texts."""
        numbers: dict[str, int] = {}
        rows = []
        for text in texts:
            if not text:
                rows.append(np.zeros(0, np.int64))
                continue
            # No piece goes on behind a space, and none holds a line end or 0.
            marked = _SPACE + text.replace(_SPACE, " ").replace(" ", f" {_SPACE}")
            for char in ("\n", "\0"):
                marked = marked.replace(char, f" {char} ")
            words = [w for w in marked.split(" ") if w]
            rows.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
        zero = numbers.get("\0")
        ids, counts = self.encode_words([w.encode() if w != "\0" else b"" for w in numbers]) if numbers else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        at = np.cumsum(counts) - counts
        out = []
        for text, row in zip(texts, rows, strict=True):
            n = counts[row]
            own = ids[np.repeat(at[row] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))] if len(row) else ids[:0]
            if zero is not None and text and "\0" in text:
                own = self._put_zeros(row, zero, n, own)
            if text and ("  " in text or text[0] in " ▁" or _SPACE in text):
                own = self._join_spaces(own)
            out.append(own)
        return out

    def _put_zeros(self, row: np.ndarray, zero: int, n: np.ndarray, ids: np.ndarray) -> np.ndarray:
        places = (np.cumsum(n) - n)[row == zero]
        return np.insert(ids, places, self._byte[0])

    def _join_spaces(self, ids: np.ndarray) -> np.ndarray:
        """Single spaces left side by side merge last, from the left, into the longest runs."""
        one, longest = self._runs.get(1), max(self._runs, default=1)
        if one is None or longest < 2:
            return ids
        out, at, values = [], 0, ids.tolist()
        while at < len(values):
            end = at
            while end < len(values) and values[end] == one:
                end += 1
            run = end - at
            if run:
                out += [self._runs[longest]] * (run // longest)
                rest = run % longest
                out += [self._runs[rest]] if rest in self._runs else [one] * rest
                at = end
            else:
                out.append(values[at])
                at += 1
        return np.array(out, np.int32)

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """Texts of id rows: pieces put together, without the space that encoding puts in front."""
        out = []
        for row in ids:
            row = np.asarray(row, np.int64)
            n = self._plain_sizes[row]
            at = np.repeat(self._plain_at[row] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            text = self._plain[at].tobytes().decode("utf-8", "replace")
            out.append(text[1:] if text[:1] == " " else text)
        return out


@cache
def codec(path: str) -> PieceCodec:
    """One per Python worker."""
    return PieceCodec(path)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    sizes = np.array([0, *(len(r) for r in rows)])
    values = np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(values, pa.int32()))


def _encode(path: str, frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in batches(frames, BATCH):
        yield pa.record_batch([frame.column(0), _lists(codec(path).encode(frame.column(1).to_pylist()))], names=["ident", "ids"])


def _decode(path: str, frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in batches(frames, BATCH):
        lists = frame.column(1)
        rows = [np.zeros(0, np.int32) if v is None else np.array(v, np.int64) for v in lists.to_pylist()]
        yield pa.record_batch([frame.column(0), pa.array(codec(path).decode(rows), pa.string())], names=["ident", "text"])


def _round_trip(path: str, frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = codec(path)
    for frame in batches(frames, BATCH):
        texts = frame.column(1).to_pylist()
        rows = own.encode(texts)
        back = own.decode(rows)
        yield pa.record_batch(
            [
                frame.column(0),
                pa.array([len(r) for r in rows], pa.int64()),
                pa.array([xxhash.xxh3_128_hexdigest(np.asarray(r, "<i4").tobytes()) for r in rows], pa.string()),
                pa.array([(t or "").replace(_SPACE, " ") == b for t, b in zip(texts, back, strict=True)], pa.bool_()),
            ],
            names=["ident", "n_pieces", "ids_digest", "round_trip"],
        )


def _apply(docs: DataFrame, function, path: str, ident: str, column: str, schema: str) -> DataFrame:
    rows = pick(docs, ident=ident, value=column)
    kind = rows.schema["ident"].dataType.simpleString()
    return rows.mapInArrow(partial(function, path), f"ident {kind}, {schema}").withColumnRenamed("ident", ident)


def encode(docs: DataFrame, model: str, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id and ``ids``, the pieces of the whole text as the model's library gives them.

    Null and empty texts have no pieces.  Repeated rows stay; other columns are not looked at.
    """
    return _apply(docs, _encode, model, ident, text, "ids array<int>")


def decode(rows: DataFrame, model: str, ident: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: id and ``text``; null or no ids give the empty text, control pieces give nothing."""
    return _apply(rows, _decode, model, ident, ids, "text string")


def summarise(docs: DataFrame, model: str, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``n_pieces``, ``ids_digest`` (XXH3-128 of the ids as little-endian 32-bit
    numbers) and ``round_trip``: whether decoding gives the text again (a null one as empty)."""
    return _apply(docs, _round_trip, model, ident, text, "n_pieces long, ids_digest string, round_trip boolean").withColumn(
        "round_trip", F.coalesce("round_trip", F.lit(False))
    )
