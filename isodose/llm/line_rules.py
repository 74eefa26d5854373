"""Quality rules with cross-document line frequency.

Lines are normalised and hashed, and the distinct documents that hold a line are counted per
host.  Lines above the host's limit are boilerplate: they are removed, and documents with too
little left are rejected, as are those that fail the base rules.  Copies and near copies of a
document must not make its own lines boilerplate, so documents count as distinct by their
*mark*: the smallest MD5 of the first five words of their lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, batches, binary_list, materialise, mix, pick, starts_of, word_ids

_SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))
#: A line is boilerplate of a host if more of its documents than this hold it ...
MAX_DOCS = 20
#: ... and more than this share of its documents.
MAX_SHARE = 0.01
#: A document is depleted when less than this share of its words is left.
MIN_LEFT = 0.4

_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, mark string, lines array<struct<hash:long,words:long>>"


def normalised(line: bytes) -> list[bytes]:
    return ascii_lower(line).split()


def line_hash(words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)


def repeated_words(ids: np.ndarray, lengths: np.ndarray, window: int = 3) -> np.ndarray:
    """Per text, the words inside windows that the text holds twice or more."""
    out = np.zeros(len(lengths), np.int64)
    if len(ids) < window:
        return out
    owner = np.repeat(np.arange(len(lengths)), lengths)
    code = owner[: len(ids) - window + 1].astype(np.uint64)
    for k in range(window):
        code = mix(code, ids[k : len(ids) - window + 1 + k].astype(np.uint64))
    whole = np.flatnonzero(owner[: len(code)] == owner[window - 1 :])
    _, inverse, counts = np.unique(code[whole], return_inverse=True, return_counts=True)
    twice = whole[counts[inverse.reshape(-1)] > 1]
    covered = np.zeros(len(ids), bool)
    for k in range(window):
        covered[twice + k] = True
    sums = np.concatenate([[0], np.cumsum(covered)])
    at = starts_of(lengths)
    return sums[at[1:]] - sums[at[:-1]]


def _lines(text: bytes) -> tuple[int, str | None, list[dict]]:
    """Repeated lines, the document's mark, and words by distinct normalised line."""
    seen: set[bytes] = set()
    words_of: dict[int, int] = {}
    repeats, mark = 0, None
    for line in text.split(b"\n"):
        words = normalised(line)
        if not words:
            continue
        repeats += line in seen
        seen.add(line)
        key = line_hash(words)
        words_of[key] = words_of.get(key, 0) + len(words)
        head = hashlib.md5(b" ".join(words[:5])).hexdigest()
        mark = head if mark is None or head < mark else mark
    return repeats, mark, [{"hash": k, "words": n} for k, n in words_of.items()]


def _measure(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs = pa.list_(pa.struct([("hash", pa.int64()), ("words", pa.int64())]))
    for frame in batches(frames, 500):
        texts = [t or b"" for t in binary_list(frame.column(3))]
        _, ids, n_words = word_ids(texts, lower=False)
        lines = [_lines(t) for t in texts]
        numbers = (
            n_words,
            [sum(map(len, t.split())) - len(t) + len(t.translate(None, _CONTINUATION)) for t in texts],
            [len(t) - len(t.translate(None, _SYMBOLS)) for t in texts],
            [x[0] for x in lines],
            repeated_words(ids, n_words),
        )
        yield pa.record_batch(
            [
                *(frame.column(i) for i in range(3)),
                *(pa.array(x, pa.int64()) for x in numbers),
                pa.array([x[1] for x in lines], pa.string()),
                pa.array([x[2] for x in lines], pairs),
            ],
            names=["ident", "host", "content", *(part.split()[0] for part in _STATS.split(", "))],
        )


def verdicts(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_docs: int = MAX_DOCS,
    max_share: float = MAX_SHARE,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """Per row: id, host, ``content`` (hash of the text), the base counts, ``n_removed`` words in
    boilerplate lines, ``removed`` (hashes of those lines), ``base_failed``, ``kept``.

    A null text has no words and fails.  Documents without a host form one host.  Repeated rows
    stay and get equal verdicts.  Lines are counted over all documents, long ones whole.  Other
    columns are not looked at; an empty table gives an empty result.
    """
    rows = pick(docs, ident=ident, host=host, text=text).select(
        "ident", F.col("host").cast("string").alias("host"), F.xxhash64("text").alias("content"), F.col("text").cast("string").alias("text")
    )
    kind = rows.schema["ident"].dataType.simpleString()
    measured = rows.mapInArrow(_measure, f"ident {kind}, host string, content long, {_STATS}")
    # Row numbers are given while writing: they never change afterwards.
    stats = materialise(
        measured.withColumn("row", F.monotonically_increasing_id()).withColumn("site", F.coalesce("host", F.lit("\0"))),
        "line-stats",
    )
    lines = stats.select("row", "site", "mark", F.explode("lines").alias("line")).select("row", "site", "mark", "line.hash", "line.words")
    sites = stats.select("site", "mark").distinct().groupBy("site").agg(F.count("mark").alias("site_docs"))
    common = (
        lines.select("site", "hash", "mark")
        .distinct()
        .groupBy("site", "hash")
        .agg(F.count(F.lit(1)).alias("holders"))
        .where(F.col("holders") > max_docs)
        .join(sites, "site")
        .where(F.col("holders") > max_share * F.col("site_docs"))
        .select("site", "hash")
    )
    lost = (
        lines.join(common, ["site", "hash"], "left_semi")
        .groupBy("row")
        .agg(F.sum("words").alias("n_removed"), F.collect_list("hash").alias("removed"))
    )
    left = 1.0 - F.col("n_removed") / F.col("n_words")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        stats.drop("lines", "mark", "site")
        .join(lost, "row", "left")
        .drop("row")
        .withColumn("n_removed", F.coalesce("n_removed", F.lit(0)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_removed") * 1.0 <= (1.0 - min_left) * F.col("n_words")))
        .withColumnsRenamed({"ident": ident, "host": host})
    )


def _rewrite(text: bytes, removed: set[int]) -> bytes:
    return b"\n".join(line for line in text.split(b"\n") if not (w := normalised(line)) or line_hash(w) not in removed)


def _drop_lines(at: int, frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in batches(frames, 2000):
        gone = frame.column(frame.num_columns - 1).to_pylist()
        columns = list(frame.columns[:-1])
        if any(gone):
            texts = binary_list(columns[at])
            new = [_rewrite(t, set(g)) if g and t is not None else t for t, g in zip(texts, gone, strict=True)]
            columns[at] = pa.array(new, pa.binary()).cast(pa.string())
        yield pa.record_batch(columns, names=frame.schema.names[:-1])


def clean(docs: DataFrame, ident: str = "doc_id", text: str = "text", host: str = "source", **limits: float) -> DataFrame:
    """The kept documents, all columns, without their boilerplate lines.

    Verdicts depend on content only, so rows find theirs by id, host and text hash; repeated rows
    all stay.  Texts without such lines come back byte for byte.
    """
    judged = (
        verdicts(docs, ident, text, host, **limits)
        .where("kept")
        .select(F.col(ident).alias("_ident"), F.col(host).alias("_host"), F.col("content").alias("_content"), F.array_sort("removed").alias("_removed"))
        .dropDuplicates(["_ident", "_host", "_content"])
    )
    rows = docs.withColumn("_key", F.xxhash64(text))
    joined = rows.join(
        judged,
        (rows["_key"] == judged["_content"])
        & rows[ident].eqNullSafe(judged["_ident"])
        & rows[host].cast("string").eqNullSafe(judged["_host"]),
    ).select(*(rows[c] for c in docs.columns), "_removed")
    ddl = docs.schema
    return joined.mapInArrow(partial(_drop_lines, docs.columns.index(text)), ddl)
