import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyrec.config import AlsParams
from tallyrec.operators.factors import als_input, fit_als, recommend
from tallyrec.operators.pruned import pruned_topk, rounds_of
from tallyrec.operators.search import exact_topk
from tallyrec.plans.catalog import _different_rows, _pruned_against_exact
from tallyrec.sources import stage


def vectors(spark, n, name, seed, spread=2.0, dims=6, whole=False):
    """Norms that fall off; ``whole`` numbers make ties."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        size = spread ** rng.uniform(-4, 4)
        x = [rng.gauss(0, 1) * size for _ in range(dims)]
        rows.append((k * 3, [float(round(v)) for v in x] if whole else x))
    return spark.createDataFrame(rows, f"{name} long, features array<double>").repartition(3)


def rows(df):
    return sorted((r.query_id, r["rank"], r.item_id, round(r.score, 9)) for r in df.collect())


@pytest.mark.parametrize("whole", [False, True])
@pytest.mark.parametrize("block_items", [10, 64])
def test_same_rows_as_the_exact_search(spark, whole, block_items):
    queries = vectors(spark, 60, "query_id", 1, whole=whole)
    items = vectors(spark, 300, "item_id", 2, whole=whole)
    found = pruned_topk(queries, items, 7, block_items=block_items)
    assert rows(found.lists) == rows(exact_topk(queries, items, 7))
    assert found.all_pairs == 60 * 300 and found.scored_pairs <= found.all_pairs
    if block_items == 10 and not whole:
        assert found.scored_pairs < 0.5 * found.all_pairs and found.met_blocks < 0.5 * found.all_blocks


def test_seen_items_and_a_query_that_has_most(spark):
    queries = vectors(spark, 20, "query_id", 3)
    items = vectors(spark, 200, "item_id", 4)
    rng = random.Random(5)
    had = [(q * 3, i * 3) for q in range(20) for i in rng.sample(range(200), 5)]
    had += [(0, i * 3) for i in range(196)] + [(3, i * 3) for i in range(200)] + [(6, 999_999)]
    seen = spark.createDataFrame(sorted(set(had)), "query_id long, item_id long")
    by_query = seen.groupBy("query_id").agg(F.collect_set("item_id").alias("seen"))
    want = exact_topk(queries.join(by_query, "query_id", "left"), items, 9)
    for block_items in (16, 500):
        assert rows(pruned_topk(queries, items, 9, seen, block_items=block_items).lists) == rows(want)


def test_few_items_and_empty_sides(spark):
    queries, items = vectors(spark, 5, "query_id", 1), vectors(spark, 4, "item_id", 2)
    assert rows(pruned_topk(queries, items, 10, block_items=2).lists) == rows(exact_topk(queries, items, 10))
    for q, i in ((queries.limit(0), items), (queries, items.limit(0))):
        found = pruned_topk(q, i, 3, block_items=2)
        assert found.lists.count() == 0 and found.scored_pairs == 0


def test_recommend_takes_it_for_large_catalogues(spark):
    rng = random.Random(8)
    pairs = [(u, i, 1 + (u * i) % 3) for u in range(40) for i in rng.sample(range(150), 30)]
    pairs += [(99, i, 1) for i in range(140)]
    fit = fit_als(als_input(spark.createDataFrame(pairs, "user_id long, item_id long, n long")), AlsParams(rank=3, reg=0.1, max_iter=3))
    for unseen in (False, True):
        small, large = recommend(fit, 12, unseen), recommend(fit, 12, unseen, block_items=16)
        assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    mine = [r.item_id for r in recommend(fit, 12, True, block_items=16).where("user_id = 99").collect()]
    assert len(mine) == len({i for _, i, _ in pairs} - set(range(140))) and not set(mine) & set(range(140))


def test_a_query_is_sent_once_per_cell_of_blocks(spark):
    blocks = [(b, 10.0 - b, 5) for b in range(11)]
    cells = [[[b for b, _, _ in cell] for cell in cells] for cells in rounds_of(blocks, 12)]
    assert cells == [[[0]], [[1]], [[2, 3]], [[4, 5], [6, 7]], [[8, 9], [10]]]
    assert rounds_of(blocks, 1) == [[[b] for b in blocks[low:high]] for low, high in ((0, 1), (1, 2), (2, 4), (4, 8), (8, 11))]
    queries, items = vectors(spark, 30, "query_id", 6), vectors(spark, 120, "item_id", 7)
    found = pruned_topk(queries.withColumn("name", F.col("query_id") * 2), items, 4, block_items=5, block_rows=20, carried=["name"])
    assert rows(found.lists) == rows(exact_topk(queries, items, 4))
    assert found.lists.where("name = 2 * query_id").count() == 30 * 4


def test_users_are_compared_in_slices_that_leave_nothing(spark, monkeypatch):
    """A slice's tables are gone before the next is searched; the sums are those of one slice."""
    users, items = vectors(spark, 80, "query_id", 8), vectors(spark, 300, "item_id", 9)
    given, alive = [], []

    def path(session, name, fresh=stage.fresh_path):
        given.append(fresh(session, name))
        alive.append(sum(Path(p).exists() for p in given))
        return given[-1]

    monkeypatch.setattr(stage, "fresh_path", path)
    one = _pruned_against_exact(users, items, 10, 30)
    whole, given[:], alive[:] = max(alive), [], []
    many = _pruned_against_exact(users, items, 10, 30, slice_rows=150)
    assert one == many and one[:3] == (80, 800, 0) and all(one[3:])
    assert len(given) > 3 * whole and max(alive) <= whole + 1
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_different_rows_are_counted_as_often_as_they_differ(spark):
    some = spark.createDataFrame([(1, 2.0), (1, 2.0), (2, 1.0), (3, None)], "a long, b double")
    other = spark.createDataFrame([(1, 2.0), (2, 1.5), (3, None)], "a long, b double")
    assert _different_rows(some, other) == 3 and _different_rows(some, some) == 0
    assert _different_rows(some.limit(0), other) == 3 and _different_rows(some.limit(0), other.limit(0)) == 0
