"""Clustering by dimension shards against plain Lloyd rounds in integers."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from isodose.llm import lloyd_shards


def brute(rows, k, rounds, dims, scale=256, seed=2):
    """(id, cluster, distance, cluster inertia, inertia, centroid) per usable vector."""
    points = []
    for ident, v in rows:
        if v is not None and len(v) == dims and all(x is not None and abs(x) < float("inf") for x in v):
            points.append((ident, tuple(int((scale * x) // 1) for x in v)))
    first = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in points)
    centroids = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in points:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, members in groups.items():
            centroids[n] = tuple(sum(column) // len(members) for column in zip(*members, strict=True))
    found = [(i, *nearest(v)) for i, v in points]
    sums = {}
    for _, d, n in found:
        sums[n] = sums.get(n, 0) + d
    return [(i, n, d, sums[n], sum(sums.values()), ",".join(map(str, centroids[n]))) for i, d, n in found]


def compared(df):
    return sorted(map(tuple, df.collect()), key=repr)


def make(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.select("*", *(F.lit("x").alias(c) for c in ("chunk", "shard", "cluster", "ident", "v", "distance", "slice")))


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(3)
    centres = [[rng.uniform(-1, 1) for _ in range(10)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.3) for x in rng.choice(centres)]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 420)]  # copies
    rows += [rows[5], rows[5], (None, rows[7][1]), (None, None), (500, None), (501, []), (502, [1.0] * 9), (503, [0.0] * 10)]
    rows += [(504, [None] + [1.0] * 9), (505, [float("nan")] * 10), (506, [float("inf")] + [0.0] * 9), (507, [-1e-30] * 10)]
    rng.shuffle(rows)
    # As the column holds them: floats.
    import numpy as np

    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


@pytest.mark.parametrize("columns, chunk_rows, broadcast_bytes", [(4, 16, 1 << 20), (3, 7, 0), (10, None, 1 << 20), (1, 50, 0)])
def test_rounds(spark, vectors, columns, chunk_rows, broadcast_bytes):
    df = make(spark, vectors).repartition(5)
    got = lloyd_shards.cluster(df, 12, 3, dims=10, columns=columns, chunk_rows=chunk_rows, broadcast_bytes=broadcast_bytes)
    assert compared(got) == sorted(brute(vectors, 12, 3, 10), key=repr)


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(i, [0.0, 0.0]) for i in range(6)] + [(9, [1.0, 1.0])]
    got = compared(lloyd_shards.cluster(make(spark, rows), 7, 4, dims=2, columns=1))
    assert got == sorted(brute(rows, 7, 4, 2), key=repr)
    assert len({row[1] for row in got}) == 2  # six centroids are alike: one of them takes all


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(1, [0.5, -0.5]), (2, [0.25, 3.0])]
    assert compared(lloyd_shards.cluster(make(spark, rows), 40, 2, dims=2)) == sorted(brute(rows, 40, 2, 2), key=repr)
    for none in ([], [(1, None), (2, [1.0])]):
        df = spark.createDataFrame(none, "vec_id long, embedding array<float>")
        out = lloyd_shards.cluster(df, 3, 2, dims=2)
        assert out.collect() == []
        assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


def test_large_components_stay_exact(spark):
    rows = [(i, [float((-1) ** i * (1 << 25) + 977 * i), float(i << 20)]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = lloyd_shards.cluster(df, 3, 3, dims=2, scale=1, columns=1)
    assert compared(got) == sorted(brute(rows, 3, 3, 2, scale=1), key=repr)
    with pytest.raises(Exception, match="smaller scale"):
        lloyd_shards.cluster(df.withColumn("embedding", F.transform("embedding", lambda x: x * 1e9)), 3, 1, dims=2, scale=1).collect()


def test_any_arrangement_of_rows_gives_the_same(spark, vectors):
    one = compared(lloyd_shards.cluster(make(spark, vectors).coalesce(1), 9, 2, dims=10))
    many = compared(lloyd_shards.cluster(make(spark, vectors[::-1]).repartition(13), 9, 2, dims=10, columns=4))
    assert one == many
