"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built.  A text is cut greedily into the
longest phrases that occur in that labelled text; the language that needs the fewest phrases,
normalised by the length of its labelled text, wins.  Phrases end at word borders, so the
phrase counts of a word are found once and summed per document.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, pick

_WORD = re.compile(r"[^\W\d_]+")
_BORDER = "\n"
#: Words with counts in memory; when full, all are forgotten and counted again.
KEPT_WORDS = 300_000
#: How fast the score falls with the distance in bits per character.
SHARPNESS = 8.0

Model = tuple[tuple[str, str], ...]


def suffix_automaton(text: str) -> dict[int, int]:
    """Transitions ``state << 21 | code point -> state`` of the automaton of all substrings; 0 is the root."""
    nexts: list[dict[str, int]] = [{}]
    links, lengths, last = [-1], [0], 0
    for char in text:
        state = len(nexts)
        nexts.append({})
        links.append(0)
        lengths.append(lengths[last] + 1)
        at = last
        while at >= 0 and char not in nexts[at]:
            nexts[at][char] = state
            at = links[at]
        if at >= 0:
            target = nexts[at][char]
            if lengths[target] == lengths[at] + 1:
                links[state] = target
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[target]))
                links.append(links[target])
                lengths.append(lengths[at] + 1)
                while at >= 0 and nexts[at].get(char) == target:
                    nexts[at][char] = clone
                    at = links[at]
                links[target] = links[state] = clone
        last = state
    return {state << 21 | ord(char): to for state, out in enumerate(nexts) for char, to in out.items()}


def count_phrases(automaton: dict[int, int], word: str) -> int:
    """Greedy longest-match phrases of a word with its borders; a character never seen is one phrase."""
    state, phrases = -1, 0
    for char in f"{_BORDER}{word}{_BORDER}":
        code = ord(char)
        state = automaton.get(state << 21 | code, -1) if state >= 0 else -1
        if state < 0:
            phrases += 1
            state = automaton.get(code, -1)
    return phrases


class CrossParser:
    """Phrase counts of words under every language's automaton, remembered per word."""

    def __init__(self, model: Model):
        self.languages = [name for name, _ in model]
        self._automata = [suffix_automaton(text) for _, text in model]
        self.bits = np.array([math.log2(len(text) + 2) for _, text in model])
        self._known: dict[str, int] = {}
        self._columns = [array("q") for _ in model]
        self._sizes = array("q")

    def _number(self, word: str) -> int:
        self._known[word] = number = len(self._sizes)
        self._sizes.append(len(word) + 2)
        for column, automaton in zip(self._columns, self._automata, strict=True):
            column.append(count_phrases(automaton, word))
        return number

    def rates(self, text: str) -> np.ndarray | None:
        """Bits per character by language; None without a word."""
        words = _WORD.findall(text.lower())
        if not words:
            return None
        if len(self._known) > KEPT_WORDS:
            self.__init_memory()
        known = self._known
        ids = np.fromiter((known[w] if w in known else self._number(w) for w in words), np.int64, len(words))
        chars = np.frombuffer(self._sizes, np.int64)[ids].sum()
        totals = [np.frombuffer(c, np.int64)[ids].sum() for c in self._columns]
        return np.array(totals) * self.bits / chars

    def __init_memory(self) -> None:
        self._known, self._sizes = {}, array("q")
        self._columns = [array("q") for _ in self._columns]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score; ``und`` and 0 without text, letters or languages."""
        if not text or not self.languages or not any(c.isalpha() for c in text):
            return "und", 0.0
        rates = self.rates(text)
        if rates is None:
            return "und", 0.0
        best = int(rates.argmin())  # of equals the first in the order of names
        return self.languages[best], float(1 / np.exp(-SHARPNESS * (rates - rates[best])).sum())


@cache
def _parser(model: Model) -> CrossParser:
    return CrossParser(model)


def fit(
    labelled: DataFrame, text: str, lang: str, docs_per_language: int = 300, chars_per_doc: int = 4000, chars_per_language: int = 40_000
) -> Model:
    """Labelled text per language, from a bounded sample.

    Of each language the ``docs_per_language`` distinct texts with the smallest hash give their first
    ``chars_per_doc`` characters.  A word counts for the languages in which its share is at least
    a third of its largest share, which keeps foreign passages in labelled texts out; the words
    in most documents come first, until ``chars_per_language`` is reached.
    """
    rows = pick(labelled, text=text, lang=lang).where("text is not null and lang is not null")
    rows = rows.withColumn("hash", F.xxhash64("text"))
    hashes = rows.select("lang", "hash").distinct()
    # Only hashes below a cut can be among a large language's smallest: four times as many as are
    # wanted, so that no task sorts a language's hashes from all over the corpus.
    sizes = hashes.groupBy("lang").agg(F.least(F.lit(1.0), 4.0 * docs_per_language / F.count(F.lit(1))).alias("share"))
    below = F.lit(-(2.0**63)) + F.col("share") * 2.0**64
    near = hashes.join(sizes, "lang").where((F.col("share") >= 1) | (F.col("hash") < below))
    order = Window.partitionBy("lang").orderBy("hash")
    chosen = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= docs_per_language)
    # ``docs_per_language`` short rows a language.
    sample = (
        rows.join(F.broadcast(chosen.select("lang", "hash")), ["lang", "hash"])
        .groupBy("lang", "hash")
        .agg(F.min(F.substring("text", 1, chars_per_doc)).alias("text"))
        .collect()
    )
    held: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    docs: dict[str, int] = defaultdict(int)
    for row in sample:
        docs[row["lang"]] += 1
        for word in set(_WORD.findall(row["text"].lower())):
            held[row["lang"]][word] += 1
    best: dict[str, float] = defaultdict(float)
    for name, words in held.items():
        for word, n in words.items():
            best[word] = max(best[word], n / docs[name])
    model = []
    for name in sorted(held):
        words = [(-n, w) for w, n in held[name].items() if 3 * n / docs[name] >= best[w]]
        chosen, size = [], 0
        for _, word in sorted(words):
            if size >= chars_per_language:
                break
            chosen.append(word)
            size += len(word) + 1
        model.append((name, _BORDER + _BORDER.join(chosen) + _BORDER))
    return tuple(model)


def _identify(model: Model, frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parser = _parser(model)
    for frame in batches(frames, 2000):
        found = [parser.predict(t) for t in frame.column(1).to_pylist()]
        yield pa.record_batch(
            [
                frame.column(0),
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
            ],
            names=["ident", "lang_pred", "score"],
        )


def identify(docs: DataFrame, model: Model, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``lang_pred``, ``score`` (0 to 1).

    A null or empty text and one without letters get ``und`` and 0, as does every text when
    nothing was labelled.  Equal rates go to the first language by name.  Repeated rows get equal
    results; other columns are not looked at.
    """
    rows = pick(docs, ident=ident, text=text)
    kind = rows.schema["ident"].dataType.simpleString()
    return rows.mapInArrow(partial(_identify, model), f"ident {kind}, lang_pred string, score double").withColumnRenamed(
        "ident", ident
    )
