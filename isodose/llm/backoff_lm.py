"""N-gram scores by a weighted backoff automaton.

States are the n-grams of the training texts, smoothed towards their suffix: with a prior of
``strength`` observations, ``p(w | h) = (c(hw) + strength p(w | h')) / (c(h) + strength)``.  An
n-gram that was seen is an arc; a state without the arc follows its failure arc, weighted
``strength / (c(h) + strength)``, to its suffix.  The root has an arc for every known word and
one for all unknown words, whose weight is the share of words seen once.

The automaton grows with the corpus and is never in one place.  Each block of documents asks for
the counts of the n-grams it holds (:mod:`.exchange`), builds the states and arcs its own texts
can reach, and traverses the texts left to right.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import binary_list, block_of, blocks_for, mix, pick, starts_of, text_bytes, word_ids
from .exchange import ask_and_answer, bucket_bounds, pack, unpack

#: Prior observations of a state.
STRENGTH = 8.0
#: Longest n-gram.
ORDER = 2
_END = np.uint64(0xE0D0E0D0E0D0E0D1)
_BEGIN = np.uint64(0xB0E0B0E0B0E0B0E3)


class _Tokens:
    """Texts of a block as 64-bit word hashes, each text between a begin and an end."""

    def __init__(self, texts: list[bytes | None]):
        words, ids, lengths = word_ids(texts, lower=True)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
        at = starts_of(lengths + 2)
        self.codes = np.empty(at[-1], np.uint64)
        inside = np.ones(at[-1], bool)
        inside[at[:-1]] = inside[at[1:] - 1] = False
        self.codes[inside] = hashes[ids]
        self.codes[at[:-1]], self.codes[at[1:] - 1] = _BEGIN, _END
        self.lengths = lengths + 1  # tokens: the words and the end
        self.starts = at[:-1]

    def grams(self, order: int) -> list[np.ndarray]:
        """For n = 1..order the codes of the n-grams that end at each token, 0 where none fits.

        The begin is context only: it starts n-grams of two or more tokens.
        """
        size = len(self.codes)
        place = np.arange(size) - np.repeat(self.starts, self.lengths + 1)
        out = [np.where(place > 0, self.codes, np.uint64(0))]
        code = self.codes
        for n in range(2, order + 1):
            longer = np.zeros(size, np.uint64)
            if size >= n:
                longer[n - 1 :] = mix(code[n - 2 : -1], self.codes[n - 1 :])
            longer[place < n - 1] = 0
            code = longer
            out.append(longer)
        return out


def _distinct(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes other than 0, sorted, with summed weights."""
    order = np.argsort(codes)
    codes, weights = codes[order], weights[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    sums = np.add.reduceat(weights, first) if len(first) else np.zeros(0, np.int64)
    codes = codes[first]
    return (codes[1:], sums[1:]) if len(codes) and codes[0] == 0 else (codes, sums)


def _questions(order: int, table: pa.Table) -> tuple[_Tokens, list[np.ndarray], list[tuple[np.ndarray, np.ndarray]], int]:
    tokens = _Tokens(binary_list(table["text"]))
    trained = ~table["held_out"].to_numpy().astype(bool)
    weight = np.repeat(trained, tokens.lengths + 1).astype(np.int64)
    grams = tokens.grams(order)
    return tokens, grams, [_distinct(g, weight) for g in grams], int(trained.sum())


def _ask(order: int, buckets: int, table: pa.Table) -> list[bytes]:
    """Per bucket and n: the block's n-grams and how often its training texts hold them."""
    _, _, asked, begins = _questions(order, table)
    bounds = [bucket_bounds(codes, buckets) for codes, _ in asked]
    return [
        pack(
            np.array([begins], np.int64),
            *(part for (codes, sums), at in zip(asked, bounds, strict=True) for part in (codes[at[b] : at[b + 1]], sums[at[b] : at[b + 1]].astype(np.uint32))),
        )
        for b in range(buckets)
    ]


def _answer(order: int, notes: list[bytes]) -> list[bytes]:
    """Counts over all blocks, aligned with each question, and the bucket's share of the totals:
    training tokens, distinct ones, those seen once, training texts."""
    kinds = [np.int64, *[np.uint64, np.uint32] * order]
    opened = [unpack(note, *kinds) for note in notes]
    totals = np.zeros(4, np.int64)
    totals[3] = sum(int(o[0][0]) for o in opened)  # each bucket hears of all texts
    replies: list[list[np.ndarray]] = [[] for _ in notes]
    for n in range(order):
        codes = [o[1 + 2 * n] for o in opened]
        sums = np.concatenate([o[2 + 2 * n] for o in opened]).astype(np.int64)
        _, inverse = np.unique(np.concatenate(codes), return_inverse=True)
        counts = np.bincount(inverse.reshape(-1), sums, minlength=1).astype(np.int64)
        if n == 0:
            totals[:3] = counts.sum(), (counts > 0).sum(), (counts == 1).sum()
        at = starts_of(np.array([len(c) for c in codes]))
        back = counts[inverse.reshape(-1)] if len(sums) else sums
        for i in range(len(notes)):
            part = back[at[i] : at[i + 1]]
            replies[i].append(np.minimum(part, (1 << 48) - 1).astype("<u8"))
    return [pack(totals, *(_narrow(r) for r in reply)) for reply in replies]


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes; 255 refers to the wide ones that follow behind."""
    small = np.minimum(counts, 255).astype(np.uint8)
    wide = counts[small == 255].astype(np.uint64)
    return np.frombuffer(np.int64(len(small)).tobytes() + small.tobytes() + wide.tobytes(), np.uint8)


def _widen(data: np.ndarray) -> np.ndarray:
    size = int(data[:8].view(np.int64)[0])
    counts = data[8 : 8 + size].astype(np.int64)
    counts[counts == 255] = np.frombuffer(data[8 + size :].tobytes(), np.uint64).astype(np.int64)
    return counts


class Automaton:
    """States and arcs for the n-grams of one block, with log10 weights."""

    def __init__(self, grams: list[np.ndarray], known: list[tuple[np.ndarray, np.ndarray]], totals: np.ndarray, strength: float):
        tokens, _, once, texts = (int(x) for x in totals)
        self.unknown = (once + 0.5) / (tokens + 1.0)
        self._grams, self._known, self._strength, self._texts = grams, known, strength, texts
        self._tokens = max(tokens, 1)

    def counts(self, n: int) -> np.ndarray:
        """Training count of the n-gram that ends at each token; 0 where there is none."""
        codes, counts = self._known[n - 1]
        if not len(codes):
            return np.zeros(len(self._grams[n - 1]), np.int64)
        at = np.searchsorted(codes, self._grams[n - 1])
        at[at == len(codes)] = 0
        return np.where(codes[at] == self._grams[n - 1], counts[at], 0)

    def traverse(self, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability at each place, and the unigram counts.

        The state before a token is the longest seen n-gram that ends there.  Its arc is taken
        if the n-gram one longer was seen; otherwise the failure arcs lead down to the state that
        has it, each adding its weight.  Going up the orders gives the same sums: a seen n-gram's
        weight contains its suffix's, an unseen one passes its context's failure weight on.
        """
        first = self.counts(1)
        prob = np.where(first > 0, (1 - self.unknown) * first / self._tokens, self.unknown)
        context, seen = first, first > 0
        for n in range(2, len(self._grams) + 1):
            arcs = self.counts(n)
            before = np.roll(context, 1)  # count of the state: the (n-1)-gram up to the token before
            if n == 2:
                before[begins + 1] = self._texts
            fits = self._grams[n - 1] != 0
            state = np.where(fits, before, 0).astype(float)
            prob = (arcs + self._strength * prob) / (state + self._strength)
            context, seen = arcs, arcs > 0
        return np.log10(prob), first


def _finish(order: int, buckets: int, strength: float, table: pa.Table, notes: list[bytes]) -> pa.Table:
    tokens, grams, asked, _ = _questions(order, table)
    kinds = [np.int64, *[np.uint8] * order]
    opened = [unpack(note, *kinds) for note in notes]
    totals = sum(o[0] for o in opened)
    totals = np.array([totals[0], totals[1], totals[2], opened[0][0][3]])
    known = [(codes, np.concatenate([_widen(o[1 + n]) for o in opened])) for n, (codes, _) in enumerate(asked)]
    automaton = Automaton(grams, known, totals, strength)
    weights, first = automaton.traverse(tokens.starts)
    base = np.log10((first + 0.1) / (totals[0] + 0.1 * (totals[1] + 1)))
    inside = np.ones(len(first), bool)
    inside[tokens.starts] = False
    at = starts_of(tokens.lengths)[:-1]
    add = lambda x: np.add.reduceat(x[inside], at) if len(at) else x[:0]
    return pa.table(
        [
            table["ident"],
            table["held_out"],
            pa.array(tokens.lengths),
            pa.array(add((first > 0).astype(np.int64))),
            pa.array(np.full(len(at), totals[0])),
            pa.array(add(base)),
            pa.array(add(weights)),
        ],
        names=["ident", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )


def score(
    docs: DataFrame,
    held_out: Column,
    ident: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    strength: float = STRENGTH,
) -> DataFrame:
    """Per row: id, ``held_out``, token counts, ``base_score`` and ``score`` (log10 of the text).

    ``held_out`` is a condition on the caller's columns; a null there holds the row out.  Only the
    other rows are learned from.  Null and empty texts consist of the end alone.  Repeated rows
    each count and each get a score.  Without any training text all words are unknown.  Other
    columns are not looked at.
    """
    rows = pick(docs.withColumn("_held_out", F.coalesce(held_out, F.lit(True))), ident=ident, held_out="_held_out", text=text)
    rows = rows.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    buckets = blocks_for(docs.sparkSession, text_bytes(rows))
    rows = rows.withColumn("block", block_of(buckets, "ident", "text"))
    kind = rows.schema["ident"].dataType.simpleString()
    return ask_and_answer(
        rows,
        [(partial(_ask, order, buckets), partial(_answer, order))],
        partial(_finish, order, buckets, strength),
        buckets,
        f"ident {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    ).withColumnRenamed("ident", ident)
