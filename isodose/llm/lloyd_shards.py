"""Exact k-means over integers, with the dimensions dealt over tasks.

Dimension-sharded Lloyd: vectors lie in chunks, and every chunk is cut into column blocks, one per
shard of the dimensions.  A task works on blocks and the slices of the centroids that belong to
them: it computes exact partial squared distances.  The blocks of a chunk are added and the nearest
centroid is taken.  The assignment goes back to the blocks; every shard adds up its own columns per
cluster and moves its own slice of the centroids.  No task ever holds a whole vector with all
centroids, and only sums are dealt by shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

#: Columns per shard.
SHARD_COLUMNS = 32
#: Bytes of one chunk's distances to all centroids, over all shards; bounds a task's memory.
CHUNK_BYTES = 8 << 20
#: The most vectors of a chunk.
CHUNK_ROWS = 4096
#: Components must lie within this, so that 64 bits hold squared distances of some dozen columns.
LIMIT = 1 << 26
#: Centroids of up to so many bytes are broadcast; beyond it they are joined by (shard, salt).
BROADCAST_BYTES = 8 << 20
_SALTS = 64


def quantised(vectors: DataFrame, ident: str, vector: str, dims: int, scale: int) -> DataFrame:
    """``ident``, ``v``: usable vectors as integers ``floor(scale * x)``."""
    x = F.col("x").cast("array<double>")
    usable = (F.size("x") == dims) & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.select(F.col(ident).alias("ident"), F.col(vector).alias("x")).withColumn("x", x).where(usable)
    return rows.select("ident", F.transform("x", lambda c: F.floor(F.lit(float(scale)) * c).cast("long")).alias("v"))


def _packed(values: np.ndarray) -> np.ndarray:
    """The same integers in the smallest type that holds them."""
    most = int(np.abs(values).max(initial=0))
    return values.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


def _wide(data: bytes, n: int, columns: int) -> np.ndarray:
    """Inverse of :func:`_packed` for ``n`` rows of ``columns`` integers."""
    size = len(data) // (n * columns)
    return np.frombuffer(data, np.dtype(f"i{size}")).reshape(n, columns).astype(np.int64)


def _cut(dims: int, columns: int, rows: int, frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of vectors, cut into one block per shard.  Chunks are numbered within the partition."""
    number = TaskContext.get().partitionId() << 32
    for frame in frames:
        for start in range(0, frame.num_rows, rows):
            part = frame.slice(start, rows)
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dims)
            if len(flat) and int(np.abs(flat).max()) > LIMIT:
                raise ValueError(f"a component is beyond {LIMIT} after scaling: use a smaller scale")
            blocks = [_packed(np.ascontiguousarray(flat[:, c : c + columns])).tobytes() for c in range(0, dims, columns)]
            idents = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
            shards = len(blocks)
            yield pa.record_batch(
                [
                    pa.array([number] * shards, pa.int64()),
                    pa.array(range(shards), pa.int32()),
                    pa.array([part.num_rows] * shards, pa.int32()),
                    pa.array(blocks, pa.binary()),
                    pa.concat_arrays([idents, pa.nulls(shards - 1, idents.type)]),
                ],
                names=["chunk", "shard", "n", "block", "idents"],
            )
            number += 1


def squared(block: np.ndarray, slice_: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centroids over some columns, exact.

    Products go through floating point where that is exact, through integers elsewhere.
    """
    most = max(int(np.abs(block).max(initial=0)), int(np.abs(slice_).max(initial=0)))
    if 4 * block.shape[1] * most * most < 1 << 53:
        x, c = block.astype(np.float64), slice_.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2.0 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    out = np.zeros((len(block), len(slice_)), np.int64)
    for k, centroid in enumerate(slice_):
        out[:, k] = ((block - centroid) ** 2).sum(1)
    return out


def _partial(k: int, widths: list[int], frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One block's part of the distances."""
    for frame in frames:
        columns = (frame.column(i).to_pylist() for i in range(5))
        for chunk, s, n, block, slice_ in zip(*columns, strict=True):
            part = squared(_wide(block, n, widths[s]), _wide(slice_, k, widths[s]))
            small = int(part.max(initial=0)) < 1 << 32
            data = part.astype(np.uint32 if small else np.int64).tobytes()
            yield pa.record_batch([pa.array([chunk], pa.int64()), pa.array([n], pa.int32()), pa.array([data], pa.binary())], names=["chunk", "n", "part"])


def _nearest(k: int, _key: tuple, table: pa.Table) -> pa.Table:
    """Add a chunk's blocks; the smallest distance, the smaller number at ties."""
    n = table["n"][0].as_py()
    total = np.zeros((n, k), np.int64)
    for part in table["part"].to_pylist():
        total += np.frombuffer(part, np.uint32 if len(part) == 4 * n * k else np.int64).reshape(n, k)
    cluster = total.argmin(1)
    distance = total[np.arange(n), cluster]
    return pa.table(
        {
            "chunk": table["chunk"].slice(0, 1),
            "cluster": pa.array([cluster.astype(np.int32).tobytes()], pa.binary()),
            "distance": pa.array([distance.tobytes()], pa.binary()),
        }
    )


def _sums(k: int, widths: list[int], columns: int, frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums per shard, cluster and column, and its vectors per cluster."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for frame in frames:
        for s, n, b, assigned in zip(*(frame.column(i).to_pylist() for i in range(4)), strict=True):
            if s not in held:
                held[s] = np.zeros((k, widths[s]), np.int64), np.zeros(k, np.int64)
            sums, counts = held[s]
            cluster = np.frombuffer(assigned, np.int32)
            order = np.argsort(cluster, kind="stable")
            present, first = np.unique(cluster[order], return_index=True)
            sums[present] += np.add.reduceat(_wide(b, n, widths[s])[order], first, axis=0)
            counts += np.bincount(cluster, minlength=k)
    for s, (sums, counts) in held.items():
        full = np.flatnonzero(counts)
        w = widths[s]
        yield pa.record_batch(
            [
                pa.array(np.full(len(full) * w, s, np.int32)),
                pa.array(np.repeat(full, w).astype(np.int32)),
                pa.array(np.tile(np.arange(w), len(full)).astype(np.int32) + s * columns),
                pa.array(sums[full].reshape(-1)),
                pa.array(np.repeat(counts[full], w)),
            ],
            names=["shard", "cluster", "dim", "total", "members"],
        )


def _move(k: int, widths: list[int], columns: int, key: tuple, moved: pa.Table, old: pa.Table) -> pa.Table:
    """A shard's own slice after a round: floors of means, empty clusters as they were."""
    s = key[0].as_py()
    slice_ = _wide(old["slice"][0].as_py(), k, widths[s]).copy()
    at = moved["cluster"].to_numpy(), moved["dim"].to_numpy() - s * columns
    slice_[at] = moved["value"].to_numpy()
    return pa.table({"shard": pa.array([s], pa.int32()), "slice": pa.array([_packed(slice_).tobytes()], pa.binary())})


def _first_slice(dims: int, columns: int, key: tuple, chosen: pa.Table) -> pa.Table:
    order = np.argsort(chosen["cluster"].to_numpy())
    flat = chosen["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)[order]
    cuts = [_packed(np.ascontiguousarray(flat[:, c : c + columns])).tobytes() for c in range(0, dims, columns)]
    return pa.table({"shard": pa.array(range(len(cuts)), pa.int32()), "slice": pa.array(cuts, pa.binary())})


class Clustering:
    """Column blocks of a table of vectors and the centroid slices of the last round, both written."""

    def __init__(self, blocks: DataFrame, slices: DataFrame, k: int, widths: list[int], columns: int, broadcast_bytes: int):
        self.blocks, self.slices, self.k, self.widths, self.columns = blocks, slices, k, widths, columns
        self._broadcast = 8 * k * sum(widths) <= broadcast_bytes

    def assign(self) -> DataFrame:
        """``chunk``, ``cluster``, ``distance`` (packed, one per vector of the chunk)."""
        blocks = self.blocks.select("chunk", "shard", "n", "block")
        if self._broadcast:
            both = blocks.join(F.broadcast(self.slices), "shard")
        else:
            salted = self.slices.withColumn("salt", F.explode(F.array(*map(F.lit, range(_SALTS)))))
            both = blocks.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(_SALTS)).cast("int")).join(salted, ["shard", "salt"])
        parts = both.select("chunk", "shard", "n", "block", "slice").mapInArrow(
            partial(_partial, self.k, self.widths), "chunk long, n int, part binary"
        )
        k = self.k
        return parts.groupBy("chunk").applyInArrow(
            lambda key, table: _nearest(k, key, table), "chunk long, cluster binary, distance binary"
        )

    def step(self) -> None:
        """One round: assign, then every shard moves its slice."""
        k, widths, columns = self.k, self.widths, self.columns
        dealt = self.blocks.select("chunk", "shard", "n", "block").join(self.assign().select("chunk", "cluster"), "chunk")
        sums = dealt.select("shard", "n", "block", "cluster").mapInArrow(
            partial(_sums, k, widths, columns), "shard int, cluster int, dim int, total long, members long"
        )
        sums = sums.groupBy("shard", "cluster", "dim").agg(F.sum("total").alias("total"), F.sum("members").alias("members"))
        mean = F.expr("(total - pmod(total, members)) div members")  # floor, also below zero
        moved = sums.select("shard", "cluster", "dim", mean.alias("value"))
        # A shard has one value per cluster and column here.
        slices = moved.groupBy("shard").cogroup(self.slices.groupBy("shard")).applyInArrow(
            lambda key, new, old: _move(k, widths, columns, key, new, old), "shard int, slice binary"
        )
        self.slices = materialise(slices, "centroids")

    def centroids(self) -> DataFrame:
        """``cluster``, ``centroid``: whole centroids, as text of decimal integers joined by commas."""
        k, widths = self.k, self.widths

        def spelled(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for frame in frames:
                for s, data in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist(), strict=True):
                    texts = [",".join(map(str, row)) for row in _wide(data, k, widths[s]).tolist()]
                    yield pa.record_batch(
                        [pa.array([s] * k, pa.int32()), pa.array(range(k), pa.int32()), pa.array(texts, pa.string())],
                        names=["shard", "cluster", "text"],
                    )

        pieces = self.slices.mapInArrow(spelled, "shard int, cluster int, text string")
        whole = F.array_sort(F.collect_list(F.struct("shard", "text")))  # one entry per shard
        return pieces.groupBy("cluster").agg(F.array_join(F.transform(whole, lambda p: p["text"]), ",").alias("centroid"))

    def members(self) -> DataFrame:
        """``ident``, ``cluster``, ``distance`` of every vector."""
        kind = self.blocks.schema["idents"].dataType.elementType.simpleString()
        idents = self.blocks.where("shard = 0").select("chunk", "idents")
        rows = idents.join(self.assign(), "chunk").select("idents", "cluster", "distance")

        def opened(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for frame in frames:
                for i in range(frame.num_rows):
                    yield pa.record_batch(
                        [
                            frame.column(0).slice(i, 1).flatten(),
                            pa.array(np.frombuffer(frame.column(1)[i].as_py(), np.int32)),
                            pa.array(np.frombuffer(frame.column(2)[i].as_py(), np.int64)),
                        ],
                        names=["ident", "cluster", "distance"],
                    )

        return rows.mapInArrow(opened, f"ident {kind}, cluster int, distance long")


def seeded(ident: Column, seed: int) -> Column:
    """Order of the vectors that become the first centroids."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)


def fit(
    vectors: DataFrame,
    k: int,
    rounds: int,
    ident: str = "vec_id",
    vector: str = "embedding",
    dims: int = 64,
    scale: int = 256,
    seed: int = 2,
    columns: int = SHARD_COLUMNS,
    chunk_rows: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> Clustering | None:
    """Lloyd's rounds from the ``k`` vectors first by hash (fewer, if there are fewer).  None without any vector."""
    rows = quantised(vectors, ident, vector, dims, scale)
    # k rows of dims integers: the model's own size.
    chosen = rows.select(seeded(F.col("ident"), seed).alias("h"), "v").orderBy("h", "v").limit(k)
    chosen = chosen.select((F.row_number().over(Window.orderBy("h", "v")) - 1).alias("cluster"), "v")
    chosen = materialise(chosen, "first-centroids")
    k = chosen.count()
    if not k:
        return None
    first = chosen.groupBy(F.lit(0).alias("all")).applyInArrow(
        lambda key, table: _first_slice(dims, columns, key, table), "shard int, slice binary"
    )
    slices = materialise(first, "centroids")
    widths = [min(columns, dims - c) for c in range(0, dims, columns)]
    chunk_rows = chunk_rows or max(1, min(CHUNK_ROWS, CHUNK_BYTES // (8 * k * len(widths))))
    kind = rows.schema["ident"].dataType.simpleString()
    # Files hold one shard each, so that a task reads blocks of few shards.
    blocks = rows.mapInArrow(
        partial(_cut, dims, columns, chunk_rows), f"chunk long, shard int, n int, block binary, idents array<{kind}>"
    )
    model = Clustering(materialise(blocks, "blocks", by=("shard",)), slices, k, widths, columns, broadcast_bytes)
    for _ in range(rounds):
        model.step()
    return model


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, ident: str = "vec_id", vector: str = "embedding", dims: int = 64, **options) -> DataFrame:
    """Per usable vector: id, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid``.

    A vector is usable if it is not null and has ``dims`` components, none null or non-finite; the
    others get no row.  Ties go to the smaller number; clusters that become empty keep their
    centroid; repeated rows are vectors of their own, and a null id is hashed as the empty text.  A
    component beyond 2^26 after scaling is an error, as 64 bits would not hold the distances.  Other
    columns are not looked at; without usable vectors the result is empty.
    """
    model = fit(vectors, k, rounds, ident, vector, dims, **options)
    if model is None:
        empty = quantised(vectors, ident, vector, dims, 1).where(F.lit(False))
        return empty.select(
            F.col("ident").alias(ident), F.lit(0).alias("cluster"), *(F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")),
            F.lit("").alias("centroid"),
        )
    members = materialise(model.members(), "members")
    # One row per cluster: k rows.
    sums = members.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sums = sums.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy(F.lit(0))))
    facts = sums.join(model.centroids(), "cluster")
    out = members.join(F.broadcast(facts), "cluster")
    return out.select(F.col("ident").alias(ident), "cluster", "distance", "cluster_inertia", "inertia", "centroid")
