import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrec.llm import topk
from tallyrec.llm.queries import llm_oracles, op8_topk
from tallyrec.llm.topk import top_products

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k=5):
    clean = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, _ in rows
             if v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i in sorted({i for i, _ in clean if i % 50 == 0}):
        q = next(v for j, v in clean if j == i)
        scored = sorted(
            (-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(q, v, strict=True)))), j)
            for j, v in clean
            if j != i and len(v) == len(q)
        )
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("block, queries", [(8192, 256), (16, 2)])
def test_equals_brute_force(spark, monkeypatch, block, queries):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", queries)
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(20)], 1) for i in range(-60, 240)]
    rows += [(1000, None, 1), (1050, [1.0, None], 1), (1100, [float("nan")] * 20, 1), (1150, [float("inf")] * 20, 1),
             (1200, [0.0] * 20, 1), (1201, [1.0] * 20, 1), (1202, [1.0] * 20, 1), (1202, [1.0] * 20, 1), (1250, [2.0, 3.0], 1),
             (1251, [1.0, 1.0], None), (1300, [], 1), (1350, [1e20] * 20, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 as id", "2 as v", "3 as score")
    got = top_products(df, "vec_id", "embedding", F.col("id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_one_query_block_uses_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 8)
    rows = [(i, [float(i % 7), 1.0], 1) for i in range(256)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(1)
    blocks = topk.materialise(topk._vector_rows(df, "vec_id", "embedding", 256.0), "test-blocks")
    assert blocks.count() == 32
    asks = df.where("vec_id = 0").selectExpr("cast(0 as bigint) ask", "array(struct(vec_id as id, embedding as v)) queries")
    met = topk._met(blocks, asks, 1).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert sum(r["count"] for r in met) == 32 and len(met) >= 8 and max(r["count"] for r in met) <= 12


def test_oracle(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("create view embeddings as select * from '/root/testdata/sf0.001/embeddings.parquet'")
    got = op8_topk(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(llm_oracles()["op8_topk"]).fetchall())


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert top_products(df, "vec_id", "embedding", F.col("id") % 50 == 0).count() == 0
