import numpy as np
import pytest

from pyspark.sql import functions as F

from tallyrec.llm.cosine import _block_pairs, hadamard, near_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, least=0.98):
    units = []
    for i, v, label in rows:
        ok = v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(v, dtype=np.float32).astype(float) if ok else None
        units.append((i, None if x is None else x / np.sqrt((x * x).sum()), label))
    n, root = [0] * len(units), list(range(len(units)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(units)):
        for b in range(a):
            (_, x, la), (_, y, lb) = units[a], units[b]
            if x is not None and y is not None and la == lb and len(x) == len(y) and x @ y >= least:
                n[a] += 1
                n[b] += 1
                p, q = top(a), top(b)
                root[max(p, q)] = min(p, q)
    groups = {}
    for k, (i, _, _) in enumerate(units):
        groups.setdefault(top(k), []).append(i)
    return sorted((i, n[k], min(groups[top(k)])) for k, (i, _, _) in enumerate(units))


def vectors():
    rng = np.random.default_rng(8)
    rows, k = [], 0
    for size in (1, 2, 40, 7):
        centre = rng.standard_normal(64)
        for _ in range(size):
            k += 1
            rows.append((k, (centre + 0.08 * rng.standard_normal(64)).tolist(), k % 2))
    for k in range(100, 220):
        rows.append((k, rng.standard_normal(64).tolist(), 1))
    rows += [(300 + i, [1.0] * 64, 3) for i in range(25)] + [(400, [2.0] * 64, 3), (401, [1.0] * 64, 4)]
    rows += [(500, None, 1), (501, [0.0] * 64, 1), (502, [None] + [1.0] * 63, 1), (503, [float("nan")] * 64, 1),
             (504, [1.0] * 64, None), (505, [1.0] * 3, 3), (506, [1.0] * 3, 3), (507, [5.0], 3), (508, [], 1)]
    return rows


@pytest.mark.parametrize("block", [256, 8])
def test_equals_brute_force(spark, block):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 as doc", "2 as unit", "3 as m")
    got = near_vectors(df, "vec_id", "embedding", "label", block=block).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    x = np.array([r[1] for r in rows], dtype=float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    label = np.array([r[2] for r in rows])
    want = ((x @ x.T >= 0.98) & (label[:, None] == label)).sum() - len(rows)
    got = near_vectors(df, "vec_id", "embedding", "label").agg({"n_links": "sum"}).first()[0]
    assert got <= want and got >= 0.9 * want


def test_transform_keeps_lengths():
    x = np.random.default_rng(1).standard_normal((3, 16))
    assert np.allclose((hadamard(x) ** 2).sum(axis=1), (x**2).sum(axis=1))


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA), "vec_id", "embedding", "label").count() == 0


def test_block_pairs_of_one_bucket_spread(spark):
    cells = spark.range(100).selectExpr("1 as bucket", "id as part", "cast(100 as bigint) as blocks", "id as members")
    cells = cells.where("part <> 50")  # a block that no vector fell into
    pairs = _block_pairs(cells, ["bucket"]).repartition(16, "bucket", "i", "j")
    found = pairs.select("i", "j", "left", "right", F.spark_partition_id().alias("p")).collect()
    assert sorted((r.i, r.j) for r in found) == sorted((i, j) for j in range(100) for i in range(j) if 50 not in (i, j))
    assert all((r.i, r.j) == (r.left, r.right) for r in found) and len({r.p for r in found}) == 16
