"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

A rotation of the principal axes is learned so that the signs of the rotated vectors, balanced
bits around the mean, lose little.  The bits are cut into substrings, one table each: vectors
whose substrings differ in at most one bit somewhere, and whose whole codes are near, are
candidates.  Original vectors decide, by cosine in double precision.

Equal vectors are one vector with a count.  Vectors with one code form a cell; cells, not
vectors, are looked up, and the vectors of two near cells are compared in tiles of bounded size,
so a dense spot costs no row per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, materialise, pick
from .components import components

#: Bits of a code at most, and substrings it is cut into.
BITS, TABLES = 64, 4
#: Learned rotations; each gives a code of its own.
ROTATIONS = 2
#: Codes further apart than this share of their bits are not reranked.
NEAR = 0.27
#: Vectors per side of a tile.
TILE = 1000


class Quantiser(NamedTuple):
    """Bits are the signs of ``(x - mean) @ axes``, for each of the rotations."""

    mean: np.ndarray
    axes: list[np.ndarray]

    @property
    def bits(self) -> int:
        return self.axes[0].shape[1]


def learn(sample: np.ndarray, bits: int = BITS, rotations: int = ROTATIONS, steps: int = 40) -> Quantiser:
    """Principal axes, then alternately the nearest bits and the best rotation onto them."""
    mean = sample.mean(0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, : min(bits, sample.shape[1])]
    projected = centred @ axes
    out = []
    for k in range(rotations):
        turn, _ = np.linalg.qr(np.random.default_rng(k).standard_normal((axes.shape[1],) * 2))
        for _ in range(steps):
            signs = np.where(projected @ turn >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(projected.T @ signs)
            turn = u @ v
        out.append(axes @ turn)
    return Quantiser(mean, out)


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Rows as double vectors; None for those that link with nothing."""
    out: list[np.ndarray | None] = []
    for value in column:
        if not value.is_valid or value.values.null_count:
            out.append(None)
            continue
        vector = value.values.to_numpy(zero_copy_only=False).astype(float)
        out.append(vector if len(vector) and np.isfinite(vector).all() and vector.any() else None)
    return out


def _unit(vectors: list[np.ndarray]) -> np.ndarray:
    matrix = np.array(vectors)
    matrix = matrix / np.abs(matrix).max(1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _code(quantiser: Quantiser | None, frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in batches(frames, 2000):
        vectors = _vectors(frame.column(1))
        size = len(quantiser.mean) if quantiser else -1
        good = [i for i, v in enumerate(vectors) if v is not None and len(v) == size]
        names: list = [None] * len(vectors)
        codes: list = [None] * len(vectors)
        units: list = [None] * len(vectors)
        if good:
            unit = _unit([vectors[i] for i in good])
            packed = []
            for axes in quantiser.axes:
                signs = (unit - quantiser.mean) @ axes >= 0
                wide = np.zeros((len(unit), 64), np.uint8)
                wide[:, : signs.shape[1]] = signs
                packed.append(np.packbits(wide, axis=1, bitorder="little").view(np.int64)[:, 0])
            for k, i in enumerate(good):
                # 0.0 is added so that both zeros count as one.
                names[i] = xxhash.xxh3_128_hexdigest((vectors[i] + 0.0).tobytes())
                codes[i], units[i] = [int(p[k]) for p in packed], unit[k]
        yield pa.record_batch(
            [
                frame.column(0),
                pa.array(names, pa.string()),
                pa.array(codes, pa.list_(pa.int64())),
                pa.array(units, pa.list_(pa.float64())),
            ],
            names=["ident", "name", "codes", "unit"],
        )


def _tile(cosine: float):
    def compare(key, table):
        units = table["unit"].combine_chunks()
        matrix = units.values.to_numpy().reshape(len(units), -1)
        count = table["copies"].to_numpy()
        role = table["role"].to_numpy()
        names = table["name"].to_pylist()
        linked = matrix @ matrix.T >= cosine
        if (role == 1).any():
            linked &= role[:, None] != role[None, :]  # two cells, or two sides of one
        np.fill_diagonal(linked, False)
        sums = linked.astype(np.float64) @ count.astype(np.float64)
        touched = np.flatnonzero(sums)
        unseen, forest = np.ones(len(names), bool), []
        for root in touched.tolist():
            open_ = [root] if unseen[root] else []
            unseen[root] = False
            while open_:
                i = open_.pop()
                new = np.flatnonzero(linked[i] & unseen).tolist()
                unseen[new] = False
                forest += [(names[i], names[j], 0) for j in new]
                open_ += new
        rows = [(names[i], None, int(round(sums[i]))) for i in touched.tolist()] + forest
        return pa.table(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())],
            names=["u", "v", "links"],
        )

    return compare


def _near_cells(cells: DataFrame, bits: int, rotations: int) -> DataFrame:
    """Pairs of different cells that the tables retrieve, as ``cell``, ``cell2``."""
    tables = min(TABLES, bits)
    width = -(-bits // tables)
    mask = (1 << width) - 1
    keys = []
    for r in range(rotations):
        for t in range(tables):
            part = F.shiftrightunsigned(F.col("codes")[r], t * width).bitwiseAND(F.lit(mask).cast("long"))
            keys.append(F.struct(F.lit(r * tables + t).alias("table"), part.alias("key")))
    own = cells.select("cell", "codes", F.explode(F.array(*keys)).alias("k")).select("cell", "codes", "k.table", "k.key")
    # A probe sets one unset bit: of two substrings that differ in a bit, one side finds the other.
    steps = F.array(*(F.lit(1 << i).cast("long") for i in range(width)), F.lit(0).cast("long"))
    probes = own.select("cell", "codes", "table", "key", F.explode(steps).alias("bit")).where(F.col("key").bitwiseAND(F.col("bit")) == 0)
    probes = probes.select(
        F.col("cell").alias("cell2"), F.col("codes").alias("codes2"), "table", F.col("key").bitwiseOR(F.col("bit")).alias("key")
    )
    apart = sum(F.bit_count(F.col("codes")[r].bitwiseXOR(F.col("codes2")[r])) for r in range(rotations))
    return (
        own.join(probes, ["table", "key"])
        .where(F.col("cell") != F.col("cell2"))
        .where(apart <= int(NEAR * bits * rotations))
        .select(F.least("cell", "cell2").alias("cell"), F.greatest("cell", "cell2").alias("cell2"))
        .distinct()
    )


def link_classes(
    vectors: DataFrame,
    ident: str = "vec_id",
    vector: str = "embedding",
    cosine: float = 0.9,
    sample: int = 20_000,
    rotations: int = ROTATIONS,
) -> DataFrame:
    """Per row: id, ``n_links`` (other rows linked directly), ``component_id`` (smallest id reachable), ``kept``.

    The rotations are learned on about ``sample`` vectors with the smallest hashes; every vector
    is indexed and looked up.  Links found are exact; pairs the tables miss are not links.  Null,
    empty and zero vectors, those with null or non-finite components, and those of another
    length than the sample's most frequent one link with nothing.  Equal vectors link with each
    other.  A row without an id is linked and counted but names no component; ``kept`` is false
    for it.  Other columns are not looked at.
    """
    rows = pick(vectors, ident=ident, vector=vector)
    total = rows.count()
    chosen = rows.select("vector")
    if total > sample:
        chosen = chosen.where(F.pmod(F.xxhash64("vector"), F.lit(1 << 32)) < int(sample / total * (1 << 32)))
    found = [v for v in _vectors(chosen.toArrow()["vector"].combine_chunks()) if v is not None] if total else []
    quantiser = None
    if found:
        sizes = [len(v) for v in found]
        common = max(set(sizes), key=lambda s: (sizes.count(s), s))
        quantiser = learn(_unit([v for v in found if len(v) == common]), rotations=rotations)

    kind = rows.schema["ident"].dataType.simpleString()
    coded = materialise(
        rows.mapInArrow(partial(_code, quantiser), f"ident {kind}, name string, codes array<long>, unit array<double>"), "itq-codes"
    )
    unique = coded.where("name is not null").groupBy("name").agg(
        F.count(F.lit(1)).alias("copies"), F.min("ident").alias("least"), F.first("codes").alias("codes"), F.first("unit").alias("unit")
    )
    unique = materialise(unique.withColumn("cell", F.concat_ws("/", F.col("codes").cast("array<string>"))), "itq-unique")
    cells = unique.groupBy("cell").agg(
        F.first("codes").alias("codes"), F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("sides"), F.count(F.lit(1)).alias("held")
    )
    cells = materialise(cells, "itq-cells")
    size = cells.select("cell", "sides")
    pairs = (
        _near_cells(cells.select("cell", "codes"), quantiser.bits if quantiser else 1, rotations)
        .join(size, "cell")
        .join(size.select(F.col("cell").alias("cell2"), F.col("sides").alias("sides2")), "cell2")
    )
    member = unique.select("cell", "name", "copies", "unit")
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    side = lambda n: F.pmod(F.xxhash64("name", F.lit(9)), n).cast("int")
    first = (
        pairs.join(member, "cell")
        .withColumn("a", side(F.col("sides")))
        .select("cell", "cell2", "a", spread(F.col("sides2")).alias("b"), "name", "copies", "unit", F.lit(0).alias("role"))
    )
    second = (
        pairs.join(member.withColumnRenamed("cell", "cell2"), "cell2")
        .withColumn("b", side(F.col("sides2")))
        .select("cell", "cell2", spread(F.col("sides")).alias("a"), "b", "name", "copies", "unit", F.lit(1).alias("role"))
    )
    own = member.join(cells.where("held > 1").select("cell", "sides"), "cell").withColumn("side", side(F.col("sides")))
    inside = own.select("cell", "side", spread(F.col("sides")).alias("with"), "name", "copies", "unit").select(
        "cell",
        F.col("cell").alias("cell2"),
        F.least("side", "with").alias("a"),
        F.greatest("side", "with").alias("b"),
        "name",
        "copies",
        "unit",
        (F.col("side") > F.col("with")).cast("int").alias("role"),
    )
    tiles = first.unionByName(second).unionByName(inside)
    found_links = materialise(
        tiles.groupBy("cell", "cell2", "a", "b").applyInArrow(_tile(cosine), "u string, v string, links long"), "itq-links"
    )
    degree = found_links.where("v is null").groupBy(F.col("u").alias("name")).agg(F.sum("links").alias("links"))
    roots = components(found_links.where("v is not null").select("u", "v")).withColumnRenamed("node", "name")
    named = unique.select("name", "copies", "least").join(degree, "name", "left").join(roots, "name", "left")
    named = named.withColumn("root", F.coalesce("root", "name"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_name = named.join(ids, "root").select(
        "name", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    return (
        coded.select("ident", "name")
        .join(of_name, "name", "left")
        .select(
            F.col("ident").alias(ident),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("name").isNull(), F.col("ident")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(ident) == F.col("component_id"), F.lit(False)))
    )
