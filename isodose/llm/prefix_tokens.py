"""Exact token counts of every prefix, for a byte-level byte-pair vocabulary.

Prefix dynamic programming: for each end of a pre-token the table holds the one last token that
an encoding of that prefix can have (see :mod:`.bpe`) and the number of tokens up to there.
Tables are kept per distinct pre-token, so a text costs one lookup per pre-token, and its prefix
counts are those tables behind running totals.  Truncation points and counts of any prefix are
read off; nothing is encoded again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .bpe import Borders, HashTable, Relaxation
from .common import batches, pick

#: Fixed value: how the vocabulary's byte-level pre-tokenizer cuts text.
_PRETOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Pre-tokens with counts in memory; when full, they are forgotten and found again.
KEPT_TABLES = 400_000
#: Documents cut and counted together.
BATCH = 1000


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write bytes without a printable letter as letters from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class PrefixCounter:
    """Token counts of texts and of their prefixes, for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_of_letter()
        vocab = spec["model"]["vocab"]
        size = max(vocab.values()) + 1
        rank, left, right = (np.full(size, -1, np.int64) for _ in range(3))
        for place, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            token = vocab[a + b]
            if rank[token] < 0:
                rank[token], left[token], right[token] = place, vocab[a], vocab[b]
        self._token = {bytes(letters[c] for c in text): i for text, i in vocab.items()}
        self._longest = max(map(len, self._token))
        self._borders = Borders(rank, left, right)
        self._held: dict[tuple[int, int], bool] = {}
        added = [t["content"] for t in spec["added_tokens"]]
        self._added = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self._counts: dict[str, int] = {}
        self._relaxation = Relaxation(self._borders)
        self._grow_tree()

    def _grow_tree(self) -> None:
        """All prefixes of tokens as a tree: (node, byte) to node, and each node's token."""
        node_of, tokens = {b"": 0}, [-1]
        keys, nodes = [], []
        for text, token in sorted(self._token.items()):
            for end in range(1, len(text) + 1):
                if text[:end] not in node_of:
                    keys.append(node_of[text[: end - 1]] << 8 | text[end - 1])
                    node_of[text[:end]] = len(tokens)
                    nodes.append(len(tokens))
                    tokens.append(-1)
            tokens[node_of[text]] = token
        self._tree = HashTable(max(4, len(keys).bit_length() + 3))
        self._tree.fill(np.array(keys, np.int64), np.array(nodes, np.int32))
        self._token_of = np.array(tokens, np.int32)

    def learn(self, pieces: list[str]) -> None:
        """Tables for many distinct pre-tokens at once; their counts are kept."""
        raw = [p.encode() for p in pieces]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        # One slot per prefix end; the slot after a piece's last byte ends its row.
        ends = np.cumsum(lengths + 1) - 1
        letters = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8).astype(np.int64)
        inside = np.ones(len(letters), bool)
        inside[ends] = False
        first = np.repeat(ends - lengths, lengths + 1)
        start = np.flatnonzero(inside)
        at, node = start.copy(), np.zeros(len(start), np.int32)
        sources, targets, tokens = [], [], []
        while len(at):
            node = self._tree.find(node.astype(np.int64) << 8 | letters[at])
            on = node >= 0
            start, at, node = start[on], at[on] + 1, node[on]
            token = self._token_of[node]
            whole = token >= 0
            sources.append(start[whole])
            targets.append(at[whole])
            tokens.append(token[whole])
            more = inside[at]
            start, at, node = start[more], at[more], node[more]
        source = np.concatenate(sources)
        _, count, _ = self._relaxation.run(
            source, np.concatenate(targets), np.concatenate(tokens), source - first[source], len(letters)
        )
        self._counts.update(zip(pieces, count[ends].tolist(), strict=True))

    def table(self, piece: bytes) -> list[int]:
        """Tokens of every prefix of one pre-token; item i is for its first i bytes."""
        token, held, borders = self._token, self._held, self._borders
        last, count = [-1] * (len(piece) + 1), [0] * (len(piece) + 1)
        for end in range(1, len(piece) + 1):
            for start in range(max(0, end - self._longest), end):
                found = token.get(piece[start:end])
                if found is None:
                    continue
                if start:
                    pair = (last[start], found)
                    holds = held.get(pair)
                    if holds is None:
                        if len(held) > 4 * KEPT_TABLES:
                            held.clear()
                        holds = held[pair] = borders.holds(*pair)
                    if not holds:
                        continue
                last[end], count[end] = found, count[start] + 1
                break
        return count

    def _count(self, piece: str) -> int:
        known = self._counts.get(piece)
        return self.table(piece.encode())[-1] if known is None else known

    def pieces(self, text: str) -> list[str | None]:
        """Pre-tokens of a text; None stands for an added token."""
        if self._added is None or not self._added.search(text):
            return _PRETOKEN.findall(text)
        out: list[str | None] = []
        at = 0
        for found in self._added.finditer(text):
            out += [*_PRETOKEN.findall(text[at : found.start()]), None]
            at = found.end()
        return out + _PRETOKEN.findall(text[at:])

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; tables of new pre-tokens are made together."""
        cut = [self.pieces(t) if t else [] for t in texts]
        if len(self._counts) > KEPT_TABLES:
            self._counts.clear()
        new = set().union(*cut)
        new.discard(None)
        new.difference_update(self._counts)
        if new:
            self.learn(list(new))
        known = self._counts.__getitem__
        return [sum(map(known, c)) if None not in c else sum(1 if p is None else known(p) for p in c) for c in cut]

    def prefix_counts(self, text: str) -> np.ndarray:
        """Item i: tokens of the first i bytes as the whole text's cut leaves them.

        Inside an added token its one token is counted at its end only.
        """
        parts, total = [np.zeros(1, np.int64)], 0
        specials = iter(self._added.findall(text)) if self._added else iter(())
        for piece in self.pieces(text):
            if piece is None:
                size = len(next(specials).encode())
                step = np.r_[np.zeros(size - 1, np.int64), 1]
            else:
                step = np.array(self.table(piece.encode())[1:], np.int64)
            parts.append(total + step)
            total += int(step[-1])
        return np.concatenate(parts)

    def fit(self, text: str, budget: int) -> int:
        """Bytes of the prefix that a budget allows: whole characters, ending no later than in
        the first pre-token that would exceed the budget."""
        total = at = 0
        specials = iter(self._added.findall(text)) if self._added else iter(())
        for piece in self.pieces(text):
            n = 1 if piece is None else self._count(piece)
            if total + n > budget:
                if piece is None:
                    return at
                raw = piece.encode()
                table = self.table(raw)
                ends = [i for i in range(1, len(raw)) if total + table[i] <= budget and raw[i] & 0xC0 != 0x80]
                return at + (ends[-1] if ends else 0)
            at += len((next(specials) if piece is None else piece).encode())
            total += n
        return at


@cache
def counter(path: str) -> PrefixCounter:
    """One per Python worker."""
    return PrefixCounter(path)


def _count_batches(path: str, budget: int, frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = counter(path)
    for frame in batches(frames, BATCH):
        texts = frame.column(1).to_pylist()
        counts = tables.counts(texts)
        sizes = [len(t.encode()) if t else 0 for t in texts]
        fits = [s if n <= budget else tables.fit(t, budget) for t, n, s in zip(texts, counts, sizes, strict=True)]
        yield pa.record_batch(
            [frame.column(0), *(pa.array(x, pa.int64()) for x in (sizes, counts, fits))],
            names=["ident", "n_bytes", "n_tokens", "fit_bytes"],
        )


def token_counts(
    docs: DataFrame, vocabulary: str, budget: int, ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_tokens``, ``fit_bytes`` (bytes of the prefix within ``budget`` tokens).

    Null and empty texts have no bytes and no tokens.  Rows stay apart, also those alike or
    without an id.  Strings of added tokens inside a text count as one token.  A very long
    pre-token costs time in proportion to its length.  Other columns are not looked at; an empty
    table gives an empty result.
    """
    rows = pick(docs, ident=ident, text=text)
    kind = rows.schema["ident"].dataType.simpleString()
    counted = rows.mapInArrow(
        partial(_count_batches, vocabulary, budget),
        f"ident {kind}, n_bytes long, n_tokens long, fit_bytes long",
    )
    return counted.withColumnRenamed("ident", ident)
