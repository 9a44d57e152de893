import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyrec.config import SearchParams
from tallyrec.functions import blocks
from tallyrec.operators.search import (
    block_counts,
    exact_topk,
    hash_vectors,
    lsh_topk,
    recall_of,
    scored_share,
    search_buckets,
)


def frame(spark, name, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"{name} long, features array<float>")


def brute_force(queries, items, k):
    scores = np.round(np.float32(queries).astype(float) @ np.float32(items).astype(float).T, 12)
    out = []
    for q, row in enumerate(scores):
        best = sorted(range(len(row)), key=lambda i: (-row[i], i))[:k]
        out += [(q, r, i) for r, i in enumerate(best, 1)]
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    items = rng.normal(size=(300, 8)) * rng.uniform(0.1, 3, size=(300, 1))
    items[100:120] = items[0]  # equal vectors: ties
    return rng.normal(size=(90, 8)), items


@pytest.mark.parametrize("block", [7, 50, 1000])
def test_exact_search_equals_brute_force(spark, vectors, block):
    q, i = frame(spark, "query_id", vectors[0]), frame(spark, "item_id", vectors[1])
    got = exact_topk(q, i, 12, block_rows=block).collect()
    assert sorted((r.query_id, r.rank, r.item_id) for r in got) == brute_force(*vectors, 12)


def test_tiny_scores_keep_their_order(spark):
    q = frame(spark, "query_id", [[1e-9, 1e-9]])
    i = frame(spark, "item_id", [[1e-9, 1e-9], [1e-9, 1.001e-9], [2e-9, 0], [1e-9, 1.001e-9]])
    assert [r.item_id for r in exact_topk(q, i, 3).orderBy("rank").collect()] == [1, 3, 0]


def test_fewer_items_than_k(spark):
    q, i = frame(spark, "query_id", [[1, 0]]), frame(spark, "item_id", [[1, 0], [2, 0]])
    assert [r.item_id for r in exact_topk(q, i, 5).orderBy("rank").collect()] == [1, 0]


def test_one_wide_bucket_finds_everything(spark, vectors):
    """With a cell wider than the data every vector shares its bucket or a neighbour's."""
    q, i = frame(spark, "query_id", vectors[0]), frame(spark, "item_id", vectors[1])
    exact = exact_topk(q, i, 5)
    found = lsh_topk(q, i, 5, SearchParams(tables=8, hashes=1, width=100.0))
    assert recall_of(exact, found).first().recall > 0.99


def test_hot_bucket_split_over_tasks_gives_the_same_lists(spark, vectors):
    q, i = frame(spark, "query_id", vectors[0]), frame(spark, "item_id", vectors[1])
    hashed = hash_vectors(q, i, SearchParams(tables=4, hashes=1, width=1.0))
    whole = search_buckets(*hashed, 5).collect()
    split = search_buckets(*hashed, 5, block_rows=20).collect()
    assert sorted(map(str, whole)) == sorted(map(str, split))


def test_lists_hold_no_item_twice_and_share_is_counted(spark, vectors):
    q, i = frame(spark, "query_id", vectors[0]), frame(spark, "item_id", vectors[1])
    hashed = hash_vectors(q, i, SearchParams(tables=6, hashes=2, width=0.5))
    lists = search_buckets(*hashed, 5)
    assert lists.groupBy("query_id", "item_id").count().where("count > 1").count() == 0
    pairs = hashed[0].join(hashed[1], ["table", "bucket"]).count()
    assert scored_share(*hashed, 90, 300).first()[0] == pytest.approx(pairs / (90 * 300))


def test_one_dimensional_factors(spark):
    q, i = frame(spark, "query_id", [[0.5], [2.0]]), frame(spark, "item_id", [[0.0], [3.0], [1.0]])
    found = lsh_topk(q, i, 1, SearchParams(tables=10, hashes=1, width=1.0)).collect()
    assert {r.item_id for r in found} == {1}


def test_zero_vectors_are_searchable(spark):
    q, i = frame(spark, "query_id", [[0.0, 0.0]]), frame(spark, "item_id", [[0.0, 0.0]])
    assert exact_topk(q, i, 1).select(F.col("score")).first()[0] == 0.0
    assert lsh_topk(q, i, 1).count() <= 1


def test_seen_items_are_left_out_before_the_cut(spark, vectors):
    q, i = frame(spark, "query_id", vectors[0]), frame(spark, "item_id", vectors[1])
    full = {}
    for r in exact_topk(q, i, 300).orderBy("query_id", "rank").collect():
        full.setdefault(r.query_id, []).append(r.item_id)
    some = q.withColumn("seen", F.expr("case when query_id % 3 > 0 then sequence(query_id, query_id + 150) end"))
    for block in (40, 1000):
        got = {}
        for r in exact_topk(some, i, 7, block_rows=block).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.item_id)
        for query, order in full.items():
            had = set(range(query, query + 151)) if query % 3 else set()
            assert got[query] == [x for x in order if x not in had][:7]
    every = q.withColumn("seen", F.expr("sequence(0L, 299L)"))
    assert exact_topk(every, i, 7).count() == 0


@pytest.mark.parametrize("bad", [None, [], [1.0, None], [1.0, float("nan")], [float("inf"), 0.0], [1.0, 2.0, 3.0]])
def test_unsound_vectors_are_refused(spark, bad):
    good = spark.createDataFrame([(0, [1.0, 2.0])], "query_id long, features array<float>")
    items = spark.createDataFrame([(0, [1.0, 2.0]), (1, bad)], "item_id long, features array<float>")
    with pytest.raises(Exception, match="null, ragged or not finite"):
        exact_topk(good, items.coalesce(1), 1).collect()


def test_items_are_cut_too_so_that_less_is_sent():
    """200 tasks over as many queries as items: cutting the queries alone would send the items 200 times."""
    sent = {n: sum(block_counts(n, n, 10, 100_000, 200, cut_items=True)) for n in (100_000, 600_000)}
    assert max(sent.values()) < 50 and sent[600_000] <= 1.5 * sent[100_000]
    assert block_counts(100_000, 100_000, 10, 100_000, 200) == (200, 1)
    q_parts, i_parts = block_counts(1_000_000, 250_000, 10, 100_000, 200, cut_items=True)
    assert q_parts >= 10 and i_parts >= 3 and q_parts * i_parts >= 200


def test_vectors_are_stored_once_and_shuffled_once(spark, vectors):
    q, i = frame(spark, "query_id", vectors[0]), frame(spark, "item_id", vectors[1])
    hashed = hash_vectors(q, i, SearchParams(tables=6, hashes=2, width=0.5))
    for side, n in zip(hashed, (90, 300)):
        assert side.count() == 6 * n
        assert sum(spark.read.parquet(f).count() for f in side.inputFiles()) == n
    plan = search_buckets(*hashed, 5)._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "Join [" in line]
    # the vectors' joins; the other kind joins the counts of crowded buckets
    assert sum("LeftOuter" in j and "BroadcastHashJoin" in j for j in joins) == 2
    assert all("FullOuter" in j for j in joins if "SortMergeJoin" in j)


def test_slabs_do_not_change_the_lists(vectors, monkeypatch):
    left = pa.table({"query_id": range(90), "features": [[float(x) for x in v] for v in vectors[0]]})
    right = pa.table({"item_id": range(300), "features": [[float(x) for x in v] for v in vectors[1]]})
    whole = blocks.top_products(left, right, 7)
    monkeypatch.setattr(blocks, "SLAB_CELLS", 1000)
    assert blocks.top_products(left, right, 7).equals(whole)


def test_a_task_holds_few_scores_at_a_time():
    """Scores, not vectors, were most of what a worker held."""
    rng = np.random.default_rng(3)
    sides = [
        pa.table({name: range(4000), "features": pa.array(list(rng.normal(size=(4000, 8)).astype("f4")))})
        for name in ("query_id", "item_id")
    ]
    tracemalloc.start()
    blocks.top_products(*sides, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6


def doubles(left, right, k, monkeypatch):
    """The lists without the first look in single precision."""
    with monkeypatch.context() as m:
        m.setattr(blocks.Coarse, "of", staticmethod(lambda items: None))
        return blocks.top_products(left, right, k)


@pytest.mark.parametrize("kind", ["normal", "whole", "far", "seen", "tiny"])
def test_single_precision_only_finds_the_candidates(kind, monkeypatch):
    rng = np.random.default_rng(9)
    q, i = rng.normal(size=(30, 5)), rng.normal(size=(5000, 5)) * rng.uniform(0.01, 3, size=(5000, 1))
    if kind == "whole":  # many ties
        q, i = np.round(2 * q), np.round(2 * i)
    if kind == "far":  # no product comes near the longest vector
        i[0], q[:, 0] = [1e9, 0, 0, 0, 0], -np.abs(q[:, 0])
    if kind == "tiny":
        q, i = q * 1e-120, i * 1e-120
    q[3] = 0
    left = pa.table({"query_id": range(30), "features": list(q)})
    right = pa.table({"item_id": rng.permutation(5000), "features": list(i)})
    if kind == "seen":
        lists = pa.array([list(range(n * 100)) for n in range(30)], pa.list_(pa.int64()))
        left = left.append_column("seen", lists)
    looked = []
    tops = blocks.Coarse.tops
    monkeypatch.setattr(blocks.Coarse, "tops", lambda *a: looked.append(tops(*a)) or looked[-1])
    monkeypatch.setattr(blocks, "SLAB_CELLS", 10_000)
    found, want = blocks.top_products(left, right, 20), doubles(left, right, 20, monkeypatch)
    assert found.equals(want)
    if kind in ("normal", "seen"):
        assert sum(x is not None for x in looked) >= len(looked) - 2


def test_a_block_of_all_items_gives_whole_lists_that_nothing_merges(spark, vectors):
    q, i = frame(spark, "query_id", vectors[0]), frame(spark, "item_id", vectors[1])
    plan = exact_topk(q, i, 5)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Window" not in plan
    merged = exact_topk(q, i, 5, block_rows=50)
    assert "Window" in merged._jdf.queryExecution().executedPlan().toString()
    # rows that share an id have one list
    twice = q.unionByName(q.where("query_id < 40").withColumn("query_id", (F.col("query_id") / 2).cast("long")))
    for side in (q, twice):
        whole, parts = exact_topk(side, i, 5), exact_topk(side, i, 5, block_rows=50)
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
        assert whole.columns == parts.columns == ["query_id", "rank", "item_id", "score"]


def test_a_pair_scores_the_same_in_every_block():
    """Products of whole blocks are summed in an order of their own: a rounded score then was another one, rarely."""
    rng = np.random.default_rng(2)
    x, items = rng.gamma(0.5, 0.3, size=(200, 4)), rng.gamma(0.5, 0.3, size=(3000, 4))
    left = pa.table({"query_id": range(200), "features": list(x)})
    right = pa.table({"item_id": range(3000), "features": list(items)})
    whole = blocks.top_products(left, right, 100).to_pylist()
    scores = {(r["query_id"], r["item_id"]): r["score"] for r in whole}
    for start in range(0, 3000, 300):
        part = blocks.top_products(left, right.slice(start, 300), 100).to_pylist()
        for r in part:
            assert scores.get((r["query_id"], r["item_id"]), r["score"]) == r["score"]
