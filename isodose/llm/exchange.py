"""Ask-and-answer over two shuffles: corpus-wide facts about keys without a row per key.

Documents lie in blocks.  Every block asks each bucket once about its *distinct* keys, packed in
one binary; a bucket sees the questions of all blocks about its keys, and answers each block in
one binary; the block then goes on with its documents and the answers.  A key that a third of
all documents hold costs one entry per block, so no task grows with a hot key.  Both sides
divide the same documents by the same content hash; Spark writes that shuffle once and reads it
twice.  Lost executors cost only the lost tasks: all of it is one ordinary lineage.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_NOTES = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("data", pa.binary())])
_NOTES_DDL = "bucket int, block int, data binary"

Ask = Callable[..., list[bytes]]
Answer = Callable[[list[bytes]], list[bytes]]
Finish = Callable[[pa.Table, list[bytes]], pa.Table]


def ask_and_answer(
    rows: DataFrame, rounds: list[tuple[Ask, Answer]], finish: Finish, buckets: int, schema: str, order: tuple[str, ...] = ()
) -> DataFrame:
    """``rows`` has an int column ``block``.

    A block's rows come in any order, and in another one in another pass: map outputs are fetched as
    they arrive, and a lost task runs again.  Functions that carry positions from pass to pass need
    ``order``: every pass then gets the block sorted by these columns.  Rows alike in them must be
    interchangeable.

    Each round's ``ask`` gives one binary per bucket, from a block's rows and, after the first
    round, the answers of the round before; ``answer`` gets the binaries of one bucket and returns
    as many; ``finish`` gets a block's rows and the last answers, one per bucket.  Empty binaries
    are not sent and answered by empty ones, so there are no more of them than keys.
    """

    def arranged(table):
        return table.sort_by([(c, "ascending") for c in order]) if order else table

    def asked(ask):
        def run(key, table, *answers):
            notes = ask(arranged(table), *(_by_bucket(a, buckets) for a in answers))
            sent = [bucket for bucket, note in enumerate(notes) if note]
            places = [pa.array(sent, pa.int32()), pa.array([key[0].as_py()] * len(sent), pa.int32())]
            return pa.table([*places, pa.array([notes[b] for b in sent], pa.binary())], schema=_NOTES)

        # Spark tells the two kinds of functions apart by their arguments.
        return (lambda key, table: run(key, table)), (lambda key, table, answers: run(key, table, answers))

    def answered(answer):
        def run(key, table):
            notes = answer(table["data"].to_pylist())
            return pa.table([table["bucket"], table["block"], pa.array(notes, pa.binary())], schema=_NOTES)

        return run

    def finished(key, table, answers):
        return finish(arranged(table), _by_bucket(answers, buckets))

    answers = None
    for ask, answer in rounds:
        first, later = asked(ask)
        if answers is None:
            notes = rows.groupBy("block").applyInArrow(first, _NOTES_DDL)
        else:
            notes = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(later, _NOTES_DDL)
        answers = notes.groupBy("bucket").applyInArrow(answered(answer), _NOTES_DDL)
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finished, schema)


def _by_bucket(notes: pa.Table, buckets: int) -> list[bytes]:
    ordered = [b""] * buckets
    for bucket, data in zip(notes["bucket"].to_pylist(), notes["data"].to_pylist(), strict=True):
        ordered[bucket] = data
    return ordered


def bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket starts in sorted 64-bit ``keys``; buckets are equal ranges of key values."""
    edges = (np.arange(1, buckets, dtype=object) * (1 << 64) // buckets).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one binary: their lengths in bytes, then their bytes."""
    parts = [np.ascontiguousarray(a).tobytes() for a in arrays]
    return b"".join([np.array([len(p) for p in parts], np.int64).tobytes(), *parts])


def unpack(data: bytes, *types: type) -> list[np.ndarray]:
    """Inverse of :func:`pack` for arrays of these types."""
    sizes = np.frombuffer(data, np.int64, len(types))
    out, at = [], 8 * len(types)
    for kind, size in zip(types, sizes, strict=True):
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
        at += int(size)
    return out
