import hashlib
import random

import numpy as np
import pytest

from tallyrec.llm import centroids
from tallyrec.llm.centroids import Centroids, cluster_vectors, pivot_distances
from tallyrec.llm.queries import llm_oracles, op13_centroids

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k=16, rounds=3, width=64):
    """Every vector against every centroid, in Python integers."""
    kept = [
        (i, [int(np.floor(64 * float(np.float32(x)))) for x in v])
        for i, v, *_ in rows
        if v is not None and len(v) == width and all(x is not None and np.isfinite(np.float32(x)) for x in v)
    ]

    def place(row):
        text = f"1:{row[0]}"
        return (row[0] is None, hashlib.sha256(text.encode()).hexdigest(), row[1])

    points = [v for _, v in sorted(kept, key=place)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for c, own in members.items():
            points[c] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    sums = {}
    for _, d, c in found:
        sums[c] = sums.get(c, 0) + d
    top = 2**63 - 1
    return [
        (i, c, min(d, top), min(sums[c], top), min(sum(sums.values()), top),
         hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest())
        for i, d, c in found
    ]


def rows_of(got):
    return sorted((tuple(r)[:6] for r in got.collect()), key=repr)


def odd_rows():
    rng = random.Random(7)
    rows = [(i, [rng.gauss(0, 1) for _ in range(64)], 1) for i in range(300)]
    rows += [(400 + i, [0.5] * 64, 1) for i in range(40)] + [(400, [0.5] * 64, 1), (401, [0.25] * 64, None)]
    rows += [(None, [0.1] * 64, 1), (500, None, 1), (501, [], 1), (502, [1.0] * 63, 1), (503, [1.0] * 65, 1)]
    rows += [(504, [None] + [1.0] * 63, 1), (505, [float("nan")] * 64, 1), (506, [float("-inf")] + [0.0] * 63, 1)]
    return rows


def test_equals_brute_force(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA).repartition(5)
    df = df.selectExpr("*", "1 as cluster", "2 as v", "3 as distance", "4 as to_pivots")
    assert rows_of(cluster_vectors(df, "vec_id", "embedding")) == sorted(brute(odd_rows()), key=repr)


@pytest.mark.parametrize("size", [2.0**25, 1e30])
def test_large_components(spark, size):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) * (size if i % 7 == 0 else 1) for _ in range(4)], 1) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = cluster_vectors(df, "vec_id", "embedding", k=5, width=4)
    assert rows_of(got) == sorted(brute(rows, k=5, width=4), key=repr)


def test_few_and_no_vectors(spark):
    rows = [(3, [1.0] * 64, 1), (4, [-1.0] * 64, 1)]
    got = cluster_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    assert rows_of(got) == sorted(brute(rows), key=repr)
    empty = cluster_vectors(spark.createDataFrame([], SCHEMA), "vec_id", "embedding")
    assert empty.count() == 0 and empty.columns == got.columns


def test_bounds_save_distances_and_lose_none():
    rng = np.random.default_rng(3)
    centres = rng.integers(-400, 400, (16, 8))
    y = np.floor(centres[rng.integers(0, 16, 4000)] + rng.normal(0, 5, (4000, 8)))
    points = centres.tolist()
    pivots = centroids.choose_pivots(y[:256], 8)
    cluster, best, computed = Centroids(points, pivots).nearest(y, pivot_distances(y, pivots))
    squares = ((y[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (cluster == squares.argmin(axis=1)).all() and (best.astype(float) == squares.min(axis=1)).all()
    assert computed.mean() < 3


def test_oracle(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("create view embeddings as select * from '/root/testdata/sf0.001/embeddings.parquet'")
    got = op13_centroids(spark, "/root/testdata/sf0.001")
    want = con.execute(llm_oracles()["op13_centroids"])
    assert got.columns == [d[0] for d in want.description]
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
