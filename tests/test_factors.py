import pytest
from pyspark.sql import functions as F

from tallyrec.config import AlsGrid, AlsParams
from tallyrec.operators.factors import (
    als_input,
    fit_als,
    item_factors,
    recommend,
    recommend_builtin,
    user_factors,
)
from tallyrec.plans.catalog import FRACTIONS, _better_left_out, all_queries
from tallyrec.plans.latent import als_grid, als_metrics, lsh_map
from tallyrec.config import SearchParams


@pytest.fixture(scope="module")
def train(spark):
    """Two tastes: even users like items below 100, odd users those above."""
    rows = [(u * 7, i + 100 * (u % 2), 1 + (u + i) % 4) for u in range(20) for i in range(30) if (u + i) % 3]
    return spark.createDataFrame(rows, "user_id long, item_id long, n long")


@pytest.fixture(scope="module")
def fit(train):
    return fit_als(als_input(train), AlsParams(rank=4, reg=0.1, max_iter=5))


def test_index_covers_every_key_once(fit, train):
    for id_map, key, index in (
        (fit.source.user_map, "user_id", "user_index"),
        (fit.source.item_map, "item_id", "item_index"),
    ):
        keys = {r[0] for r in train.select(key).distinct().collect()}
        rows = id_map.collect()
        assert {r[key] for r in rows} == keys
        assert sorted(r[index] for r in rows) == list(range(1, len(keys) + 1))
    assert fit.source.ratings.count() == train.count()


def test_lists_are_ranked_and_unique(fit):
    lists = recommend(fit, 10)
    per_user = lists.groupBy("user_id").agg(
        F.sort_array(F.collect_list("rank")).alias("ranks"), F.countDistinct("item_id").alias("items")
    )
    for row in per_user.collect():
        assert row.ranks == list(range(1, 11)) and row["items"] == 10


def test_recommendations_follow_the_taste(fit):
    lists = recommend(fit, 10).collect()
    right = [((r.user_id // 7) % 2 == 1) == (r.item_id >= 100) for r in lists]
    assert sum(right) / len(right) > 0.95


def test_block_search_agrees_with_the_built_in_recommender(fit):
    ours = {(r.user_id, r.item_id): r.score for r in recommend(fit, 10).collect()}
    theirs = {(r.user_id, r.item_id): r.score for r in recommend_builtin(fit, 10).collect()}
    assert len(set(ours) & set(theirs)) >= 0.98 * len(theirs)
    for pair in set(ours) & set(theirs):
        assert ours[pair] == pytest.approx(theirs[pair], abs=1e-5)


def test_factors_carry_the_original_keys(fit, train):
    for factors, key in ((user_factors(fit), "user_id"), (item_factors(fit), "item_id")):
        rows = factors.collect()
        assert {r[key] for r in rows} == {r[0] for r in train.select(key).distinct().collect()}
        assert all(len(r.features) == 4 and min(r.features) >= 0 for r in rows)


def test_metrics_grid_and_search_runs(spark, train):
    splits = train.withColumn("split", F.when(F.col("item_id") % 5 == 0, "val").otherwise("train"))
    assert {r["split"] for r in als_metrics(splits, list_size=5).collect()} == {"train", "val"}
    grid = AlsGrid(ranks=(1, 2), regs=(0.1,), alphas=(1.0, 5.0))
    rows = als_grid(splits, grid, list_size=5).collect()
    assert len(rows) == 4 * 2
    assert {(r.rank_dim, r.alpha) for r in rows} == {(1, 1.0), (1, 5.0), (2, 1.0), (2, 5.0)}
    searched = lsh_map(splits, AlsParams(rank=2), [SearchParams(4, 1, 0.5)], 5).collect()
    assert {r["split"] for r in searched} == {"train", "val"}


def test_size_runs_cover_every_fraction(spark):
    rows = all_queries()["als_size_runs"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.fraction for r in rows) == list(FRACTIONS)
    sizes = [r.train_rows for r in sorted(rows, key=lambda r: r.fraction)]
    assert sizes == sorted(set(sizes))


def test_a_better_item_left_out_of_an_unseen_list_is_found(fit):
    lists = recommend(fit, 6, unseen=True)
    assert not any(r.better_left_out for r in _better_left_out(fit, lists.where("rank <= 5")).collect())
    worse = _better_left_out(fit, lists.where("rank > 1")).collect()
    assert len(worse) == 20 and sum(r.better_left_out for r in worse) > 10
