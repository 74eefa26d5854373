"""Quality scores learned from preference pairs (Bradley-Terry).

Every labelled good document is preferred to some bad ones.  The chance that document ``a`` beats
``b`` is ``sigmoid(w . (x_a - x_b))``; ``w`` minimises the logistic loss over the pairs, on
features of the whole text.  A quantile of the fitted scores of labelled documents is the
threshold; it is mapped to the score 0.3.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, binary_list, pick

#: A score from here on is good.
CUT = 0.3
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_HIGH = bytes(range(128, 256))
_CLASSES = (_UPPER, _DIGIT, _HIGH, b"#*$%&<>@_~^+=\\/", b"|", b"!?", b".", b",", b"-:;()[]{}\"'`", b"\n")
#: Ratios are also cut at these values: quality is not linear in them.
_STEPS = (0.005, 0.02, 0.06, 0.15, 0.35)


class Ranker(NamedTuple):
    """Standardised linear scores: ``scale * (w . (x - mean) / spread - threshold)``."""

    mean: list[float]
    spread: list[float]
    weights: list[float]
    threshold: float
    scale: float

    def score(self, features: np.ndarray) -> np.ndarray:
        raw = _linear((features - np.array(self.mean)) / np.array(self.spread), np.array(self.weights))
        margin = np.clip(self.scale * (raw - self.threshold), -40, 40)
        return 1 / (1 + np.exp(-margin) * (1 - CUT) / CUT)


def _linear(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted sum of each row.  A matrix product may add a row up in another order at another place."""
    return np.ascontiguousarray(x * weights).sum(axis=1)


def features(text: bytes | None) -> list[float]:
    """Fixed-length description of a whole text; null counts as empty."""
    text = text or b""
    size = len(text) or 1
    ratios = [(len(text) - len(text.translate(None, chars))) / size for chars in _CLASSES]
    words = text.split()
    n = len(words)
    if n:
        lines = [line for line in text.split(b"\n") if line.strip()]
        counts: dict[bytes, int] = {}
        for word in words:
            counts[word] = counts.get(word, 0) + 1
        pairs = set(zip(words, words[1:], strict=False))
        ratios += [
            sum(map(len, words)) / n / 40,
            len(counts) / n,
            max(counts.values()) / n,
            1 - len(pairs) / max(1, n - 1),
            1 - len(set(lines)) / len(lines),
            min(1.0, len(lines) / n),
            sum(map(bytes.isalpha, words)) / n,
            (len(words[0]) == 1 and n == 1) * 1.0,
        ]
    else:
        ratios += [0.0] * 8
    length = np.log1p(n)
    steps = [float(r > s) for r in ratios for s in _STEPS]
    short = [float(n < s) for s in (1, 5, 10, 20, 40, 80, 160)]
    return [*ratios, length, min(length, 4.0), *steps, *short]


def _featurise(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in batches(frames, 2000):
        values = [features(t) for t in binary_list(frame.column(1))]
        yield pa.record_batch([frame.column(0), pa.array(values, pa.list_(pa.float64()))], names=["label", "x"])


def _fit_pairs(x: np.ndarray, better: np.ndarray, worse: np.ndarray, l2: float, steps: int) -> np.ndarray:
    """Newton's method for the logistic loss of feature differences."""
    diff = x[better] - x[worse]
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -40, 40)))
        gradient = -(diff * p[:, None]).mean(0) + l2 * w
        curve = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + (l2 + 1e-9) * np.eye(len(w))
        move = np.linalg.solve(curve, gradient)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return w


def fit(
    labelled: DataFrame, text: str = "text", label: str = "quality", sample: int = 20_000, partners: int = 8, l2: float = 1e-3
) -> Ranker:
    """Learn from labelled rows; ``label`` 1 is preferred to 0, other labels and null are left out.

    At most about ``sample`` rows are used, by the smallest hashes of their texts: features only
    reach the driver.  Each row meets ``partners`` rows of the other class, dealt in turn from
    hash order.  The threshold is the quantile of all scores that best divides the classes, both
    counting alike.  Without both classes every document gets the score 1.
    """
    rows = pick(labelled, label=label, text=text).where(F.col("label").isin(0, 1)).select(F.col("label").cast("int"), "text")
    total = rows.count()
    if total > sample:
        keep = int(sample / total * (1 << 32))
        rows = rows.where(F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 32)) < keep)
    table = rows.mapInArrow(_featurise, "label int, x array<double>").toPandas()
    y = table["label"].to_numpy(np.int64)
    if len(set(y.tolist())) < 2:
        size = len(features(b""))
        return Ranker([0.0] * size, [1.0] * size, [0.0] * size, -40.0, 1.0)
    x = np.array(table["x"].tolist())
    order = np.lexsort((*x.T[:20], y))
    x, y = x[order], y[order]
    mean, spread = x.mean(0), x.std(0)
    spread[spread < 1e-9] = 1.0
    z = (x - mean) / spread
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    shuffled = np.random.default_rng(11)
    good, bad = shuffled.permutation(good), shuffled.permutation(bad)
    size = max(len(good), len(bad))
    pairs = [(np.resize(good, size), np.resize(np.roll(bad, k), size)) for k in range(partners)]
    better, worse = (np.concatenate(side) for side in zip(*pairs, strict=True))
    w = _fit_pairs(z, better, worse, l2, 30)
    raw = _linear(z, w)
    levels = np.quantile(raw, np.linspace(0, 1, 4001))
    gain = [(raw[y == 1] >= t).mean() + (raw[y == 0] < t).mean() for t in levels]
    best = np.flatnonzero(np.isclose(gain, max(gain)))
    threshold = float(levels[best].mean())
    return Ranker(mean.tolist(), spread.tolist(), w.tolist(), threshold, 1.0)


def _score(ranker: Ranker, frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in batches(frames, 2000):
        values = ranker.score(np.array([features(t) for t in binary_list(frame.column(1))]))
        yield pa.record_batch(
            [frame.column(0), pa.array(values, pa.float64()), pa.array(values >= CUT).cast(pa.int32())],
            names=["ident", "score", "predicted"],
        )


def score(docs: DataFrame, ranker: Ranker, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``score`` (0 to 1), ``predicted`` (1 from 0.3 on).

    Null texts count as empty ones, which get a score like any text.  Equal texts get equal
    scores; repeated rows stay; other columns are not looked at.
    """
    rows = pick(docs, ident=ident, text=text)
    kind = rows.schema["ident"].dataType.simpleString()
    return rows.mapInArrow(partial(_score, ranker), f"ident {kind}, score double, predicted int").withColumnRenamed(
        "ident", ident
    )
