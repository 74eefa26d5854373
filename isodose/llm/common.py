"""What the operators share: column handling, byte-level words, hashing, scratch tables.

Words are the maximal runs of bytes outside ``\\x20`` and ``\\x09-\\x0D``, which is exactly what
``bytes.split()`` gives.  Columns of the caller are renamed to internal names first, so extra
columns and clashing names never reach an operator's own columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable_dir, parallelism, scratch_path

__all__ = [
    "ascii_lower",
    "binary_list",
    "block_of",
    "blocks_for",
    "durable_dir",
    "held_out",
    "materialise",
    "mix",
    "parallelism",
    "pick",
    "remainder",
    "starts_of",
    "text_bytes",
    "word_ids",
]

#: Raw text bytes that one block of documents holds, on average.  Bounds a Python task's memory.
BLOCK_BYTES = 8 << 20

_UPPER_TO_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_C1 = np.uint64(0x9E3779B97F4A7C15)
_C2 = np.uint64(0xBF58476D1CE4E5B9)
_C3 = np.uint64(0x94D049BB133111EB)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the given internal names."""
    return df.select(*(df[source].alias(name) for name, source in columns.items()))


def remainder(ident: Column, modulus: int) -> Column:
    """``crc32`` of the id as text, modulo; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(ident.cast("string"), F.lit(""))), F.lit(modulus))


def held_out(ident: Column, modulus: int, value: int) -> Column:
    return remainder(ident, modulus) == value


def materialise(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write below the shared folder and read back: a cut lineage that outlives executors.

    With ``by``, files hold rows of one value of these columns each.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: sizes blocks, never decides what is computed."""
    return df.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0


def blocks_for(spark: SparkSession, volume: int, block_bytes: int = BLOCK_BYTES) -> int:
    """How many blocks hold ``volume`` bytes; one for each shuffle task at least."""
    return max(parallelism(spark), -(-volume // block_bytes))


def block_of(blocks: int, *columns: str) -> Column:
    """The block of a row, from its content alone: a task that runs again finds the same."""
    return F.pmod(F.xxhash64(*columns), F.lit(blocks)).cast("int")


def binary_list(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """A string column as a list of UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def ascii_lower(text: bytes) -> bytes:
    return text.translate(_UPPER_TO_LOWER)


class _Numbers(dict):
    """Consecutive numbers for new keys."""

    def __missing__(self, key: bytes) -> int:
        self[key] = number = len(self)
        return number


def word_ids(texts: list[bytes | None], lower: bool) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the word numbers of all texts in one row, and the words per text."""
    numbers = _Numbers()
    parts, lengths = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            words = (ascii_lower(text) if lower else text).split()
            lengths[i] = len(words)
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
    return list(numbers), np.concatenate(parts) if parts else np.zeros(0, np.int32), lengths


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Offsets of consecutive runs, with the total at the end."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def mix(left: np.ndarray, right: np.ndarray | np.uint64) -> np.ndarray:
    """A 64-bit hash of pairs of 64-bit values; the order of a pair matters."""
    with np.errstate(over="ignore"):
        x = left * _C1 + right
        x = (x ^ (x >> np.uint64(30))) * _C2
        x = (x ^ (x >> np.uint64(27)) ^ left) * _C3
        return x ^ (x >> np.uint64(31))


def batches(frames: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows."""
    for frame in frames:
        for start in range(0, frame.num_rows, rows):
            yield frame.slice(start, rows)
