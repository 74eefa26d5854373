"""Fingerprints of documents that do not depend on the order of paragraphs.

Homomorphic multiset hash: a paragraph is hashed to a wide vector, and a document's fingerprint is
the sum of its paragraphs' vectors, lane by lane, modulo powers of two.  Equal multisets of
paragraphs give equal sums in any order, and a paragraph is inserted or deleted by adding or
subtracting its vector.  The vector has three parts: lanes of 64 bits from a cryptographic hash of
the whole paragraph, which decide equality; lanes of 32 bits in which each three-word shingle of the
paragraph counts once, up or down, so that the difference of two fingerprints tells how far two
multisets of shingles are apart; and the number of paragraphs.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, mix, parallelism, starts_of, word_ids

#: 64-bit lanes that decide equality, and 32-bit lanes (a power of two) that tell likeness.
EXACT, LANES = 8, 256
#: Words per shingle.
WIDTH = 3
#: Bytes of text per range of consecutive documents, on average; ranges per shuffle task at least;
#: ranges at most (their bounds are part of the plan); sampled keys per range.
RANGE_BYTES, RANGES_PER_TASK, MOST_RANGES, KEYS_PER_RANGE = 64 << 20, 2, 4096, 40
BATCH = 500
_SHORT = np.uint64(0x5851F42D4C957F2D)


class Sketch:
    """Fingerprints of several documents: one row each."""

    def __init__(self, exact: np.ndarray, lanes: np.ndarray, paragraphs: np.ndarray):
        self.exact, self.lanes, self.paragraphs = exact, lanes, paragraphs

    def __add__(self, other: Sketch) -> Sketch:
        return Sketch(self.exact + other.exact, self.lanes + other.lanes, self.paragraphs + other.paragraphs)

    def __sub__(self, other: Sketch) -> Sketch:
        return Sketch(self.exact - other.exact, self.lanes - other.lanes, self.paragraphs - other.paragraphs)

    def __getitem__(self, rows) -> Sketch:
        return Sketch(self.exact[rows], self.lanes[rows], self.paragraphs[rows])

    def same(self, other: Sketch) -> np.ndarray:
        return (
            (self.exact == other.exact).all(1) & (self.lanes == other.lanes).all(1) & (self.paragraphs == other.paragraphs)
        )

    def likeness(self, other: Sketch) -> np.ndarray:
        """Estimated shared shingles over all shingles, both as counted vectors; 1 if the same.

        For distinct shingles this is the Jaccard similarity.  Its error is about
        ``sqrt(2 / LANES)`` of the difference, and far less for short texts.
        """

        def squares(lanes: np.ndarray) -> np.ndarray:
            return (lanes.view(np.int32).astype(np.float64) ** 2).sum(1)

        a, b, apart = squares(self.lanes), squares(other.lanes), squares(self.lanes - other.lanes)
        shared = (a + b - apart) / 2
        either = a + b - shared
        out = np.divide(shared, either, out=np.zeros(len(a)), where=either > 0)
        return np.where(self.same(other), 1.0, np.clip(out, 0.0, 1.0))

    def text(self) -> list[str]:
        """All lanes, little-endian, in Base64."""
        raw = np.concatenate(
            [self.exact.astype("<u8").view(np.uint8), self.lanes.astype("<u4").view(np.uint8), self.paragraphs.astype("<u8")[:, None].view(np.uint8)], 1
        )
        return [base64.b64encode(row.tobytes()).decode() for row in raw]


def paragraphs(text: str) -> list[str]:
    """Paragraphs end with a line end; the empty text has none."""
    return text.split("\n") if text else []


def fingerprints(documents: list[list[str]], width: int = WIDTH) -> Sketch:
    """Fingerprints of documents given as their paragraphs."""
    sizes = np.fromiter(map(len, documents), np.int64, len(documents))
    flat = [p.encode() for d in documents for p in d]
    owner = np.repeat(np.arange(len(documents)), sizes)
    exact = np.zeros((len(documents), EXACT), np.uint64)
    if flat:
        digests = np.frombuffer(b"".join(hashlib.blake2b(p, digest_size=8 * EXACT).digest() for p in flat), "<u8").reshape(-1, EXACT)
        filled = sizes > 0
        with np.errstate(over="ignore"):
            exact[filled] = np.add.reduceat(digests.astype(np.uint64), starts_of(sizes)[:-1][filled])
    return Sketch(exact, _shingle_lanes(flat, owner, len(documents), width), sizes.astype(np.uint64))


def _shingle_lanes(flat: list[bytes], owner: np.ndarray, n: int, width: int) -> np.ndarray:
    """Each shingle's hash picks one lane of its document, and whether it counts up or down."""
    words, places, lengths = word_ids(flat, lower=False)
    if not len(places):
        return np.zeros((n, LANES), np.uint32)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))[places]
    ends = np.cumsum(lengths)
    left = np.repeat(ends, lengths) - np.arange(len(places))  # words from here to the paragraph's end
    run = hashed.copy()
    for step in range(1, width):
        more = np.flatnonzero(left > step)
        run[more] = mix(run[more], hashed[more + step])
    # Paragraphs of fewer words are one shingle as a whole.
    short = np.repeat(lengths, lengths) < width
    first = np.zeros(len(places), bool)
    first[(ends - lengths)[lengths > 0]] = True
    keep = (left >= width) | (short & first)
    run = np.where(short, mix(run, left.astype(np.uint64) ^ _SHORT), run)[keep]
    document = np.repeat(owner, lengths)[keep]
    lane = document * LANES + (run & np.uint64(LANES - 1)).astype(np.int64)
    up = (run >> np.uint64(32) & np.uint64(1)).astype(bool)
    counts = np.bincount(lane[up], minlength=n * LANES) - np.bincount(lane[~up], minlength=n * LANES)
    return (counts & 0xFFFFFFFF).astype(np.uint32).reshape(n, LANES)


def edit(text: str, following: str, sketch: Sketch | None = None) -> tuple[str, list[str], list[str]]:
    """The text with its last quarter replaced by as much of the following text's beginning.

    Returns the edited text and the paragraphs to delete from and to insert into the fingerprint.
    """
    cut = len(text) - len(text) // 4
    head = following[: len(text) - cut]
    kept = text.rfind("\n", 0, cut) + 1  # paragraphs before this stay
    edited = text[:cut] + head
    if not text:
        return edited, [], []
    return edited, text[kept:].split("\n"), edited[kept:].split("\n")


def _pair_rows(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids of rows, their texts and one more) for consecutive rows of one range.

    Only the last row of a batch is held back.  A row that is a seam is the first of the range
    behind and only follows.
    """
    ids, texts, bucket = [], [], None
    for frame in batches(frames, BATCH):
        kind = frame.schema.field(0).type
        columns = (frame.column(i).to_pylist() for i in range(4))
        for ident, text, place, seam in zip(*columns, strict=True):
            texts.append(text or "")
            if place != bucket:
                bucket, ids, texts = place, [], texts[-1:]
            if seam:
                if ids:
                    yield pa.array(ids, kind), texts
                bucket, ids, texts = None, [], []
            else:
                ids.append(ident)
        if len(ids) > 1:
            yield pa.array(ids[:-1], kind), texts
            ids, texts = ids[-1:], texts[-1:]


def _compare(width: int, frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in _pair_rows(frames):
        own = fingerprints([paragraphs(t) for t in texts], width)
        edits = [edit(t, f) for t, f in zip(texts, texts[1:], strict=False)]
        with np.errstate(over="ignore"):
            changed = own[:-1] - fingerprints([d for _, d, _ in edits], width) + fingerprints([i for _, _, i in edits], width)
        yield pa.record_batch(
            [
                ids,
                pa.array([len(t) for t in texts[:-1]], pa.int64()),
                pa.array([e for e, _, _ in edits], pa.string()),
                pa.array(own[:-1].text(), pa.string()),
                pa.array(changed.text(), pa.string()),
                pa.array(own[:-1].likeness(changed)),
                pa.array(own[:-1].likeness(own[1:])),
            ],
            names=["ident", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )


def _fingerprint_batches(width: int, frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in batches(frames, BATCH):
        texts = [t or "" for t in frame.column(1).to_pylist()]
        sketch = fingerprints([paragraphs(t) for t in texts], width)
        yield pa.record_batch(
            [frame.column(0), pa.array(sketch.paragraphs.astype(np.int64)), pa.array(sketch.text(), pa.string())],
            names=["ident", "n_paragraphs", "fingerprint"],
        )


def fingerprint(docs: DataFrame, ident: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Per row: id, ``n_paragraphs`` and ``fingerprint``.

    Null and empty texts have no paragraphs and the zero fingerprint; an empty line is a paragraph.
    Rows alike get the same result; very long texts cost time in proportion.  Other columns are not
    looked at; an empty table gives an empty result.
    """
    rows = docs.select(F.col(ident).alias("ident"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["ident"].dataType.simpleString()
    out = rows.mapInArrow(partial(_fingerprint_batches, width), f"ident {kind}, n_paragraphs long, fingerprint string")
    return out.withColumnRenamed("ident", ident)


def _bucket(key: Column, bounds: list[Column]) -> Column:
    """How many bounds (sorted) are at or below the key, less one: two short looks through them."""
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]

    def reached(among: Column) -> Column:
        return F.size(F.filter(among, lambda b: b <= key))

    group = F.greatest(reached(F.array(*(g[0] for g in groups))), F.lit(1))
    inside = reached(F.element_at(F.array(*(F.array(*g) for g in groups)), group))
    return ((group - 1) * step + inside - 1).cast("int")


def with_following(docs: DataFrame, ident: str, text: str, ranges: int | None = None) -> DataFrame:
    """``ident``, ``text``, ``bucket``, ``seam``, sorted inside each bucket by id.

    The rows of a bucket are consecutive documents; behind them comes one more with ``seam`` set,
    the first of the next bucket (of the first bucket, for the last one).  Ranges are cut at sampled
    keys; their number follows the bytes, and a task sorts on disk what its memory does not hold.  Rows alike in id and text are told apart by a number
    of their own, so a range may start among them.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(ident).alias("ident"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    keys = rows.select("ident", "h", "salt")
    volume = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    total = volume["n"]
    if ranges is None:
        ranges = min(MOST_RANGES, max(RANGES_PER_TASK * parallelism(spark), (volume["bytes"] or 0) // RANGE_BYTES))
    tasks = max(parallelism(spark), ranges // RANGES_PER_TASK)
    share = min(1.0, ranges * KEYS_PER_RANGE / max(total, 1))
    # Only these few keys come to the driver; they decide where work is cut, not what is computed.
    sample = keys.sample(share, seed=1).limit(2 * ranges * KEYS_PER_RANGE).union(keys.orderBy("ident", "h", "salt").limit(1))
    sample = sample.distinct().orderBy("ident", "h", "salt").collect()
    cuts = [sample[len(sample) * i // ranges] for i in range(ranges)] if sample else []
    cuts = [c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1]]
    if not cuts:
        return rows.select("ident", "text", F.lit(0).alias("bucket"), F.lit(False).alias("seam"))
    kind = rows.schema["ident"].dataType

    def literal(row) -> Column:
        return F.struct(F.lit(row["ident"]).cast(kind).alias("ident"), F.lit(row["h"]).alias("h"), F.lit(row["salt"]).alias("salt"))

    key = F.struct("ident", "h", "salt")
    dealt = rows.withColumn("bucket", _bucket(key, [literal(c) for c in cuts]))
    starts = spark.createDataFrame(
        [(c["ident"], c["h"], (i - 1) % len(cuts)) for i, c in enumerate(cuts)], rows.select("ident", "h", F.lit(0).alias("bucket")).schema
    ).withColumnsRenamed({"ident": "cut_ident", "h": "cut_h", "bucket": "before"})
    # Tables of as many rows as there are ranges; rows alike meet in the map-side maximum.
    places = F.broadcast(starts.select("cut_ident", "cut_h").distinct())
    first = rows.join(places, F.col("ident").eqNullSafe(F.col("cut_ident")) & (F.col("h") == F.col("cut_h")), "left_semi")
    first = first.groupBy("ident", "h").agg(F.max("text").alias("text"))
    seams = first.join(F.broadcast(starts), F.col("ident").eqNullSafe(F.col("cut_ident")) & (F.col("h") == F.col("cut_h")))
    seams = seams.select(
        F.lit(None).cast(kind).alias("ident"), "text", F.lit(0).cast("long").alias("h"), F.lit(0).cast("long").alias("salt"),
        F.col("before").alias("bucket"), F.lit(True).alias("seam"),
    )
    both = dealt.select("ident", "text", "h", "salt", "bucket", F.lit(False).alias("seam")).unionByName(seams)
    sorted_ = both.repartition(tasks, "bucket").sortWithinPartitions("bucket", "seam", "ident", "h", "salt")
    return sorted_.select("ident", "text", "bucket", "seam")


def compare_edits(docs: DataFrame, ident: str = "doc_id", text: str = "text", width: int = WIDTH, ranges: int | None = None) -> DataFrame:
    """Per row: id, ``n_chars``, ``edited`` (text), ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``.

    The edited text has the last quarter of its characters replaced by as many (or all) of the next
    document's, by id; the last document is followed by the first, a single one by itself.  The
    edited fingerprint is the document's own less the paragraphs that the edit touches, plus the
    new ones.  Null texts count as empty.  Ids may be null (they come first) and repeated: rows of
    one id follow each other by a hash of their text.  Very long texts are edited whole.  Other
    columns are not looked at; an empty table gives an empty result.
    """
    rows = with_following(docs, ident, text, ranges)
    field = rows.schema["ident"].dataType
    schema = (
        f"ident {field.simpleString()}, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    return rows.mapInArrow(partial(_compare, width), schema).withColumnRenamed("ident", ident)


def merged(sketches: list[Sketch]) -> Sketch:
    """The fingerprint of all documents' paragraphs together."""
    return reduce(Sketch.__add__, sketches)
