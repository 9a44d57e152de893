import random

from pyspark.sql import functions as F

from tallyrec.operators.popularity import (
    active_items,
    damped_vote_lists,
    popularity_list,
    item_popularity,
    rank_items,
    unseen_lists,
)
from tallyrec.operators.ranking import ground_truth

COUNTS = "user_id long, item_id long, n long"


def test_popularity_counts_users_and_ties_go_to_the_smaller_item(spark):
    rows = [(1, 5, 100), (2, 3, 1), (3, 3, 1), (4, 4, 1), (5, 4, 1)]
    best = popularity_list(spark.createDataFrame(rows, COUNTS), 2).orderBy("rank").collect()
    assert [(r.rank, r.item_id, r.score) for r in best] == [(1, 3, 2.0), (2, 4, 2.0)]


def test_damped_vote_by_hand(spark):
    # user 1 ranks 10 over 20, user 2 ranks 20 only
    train = spark.createDataFrame([(1, 10, 5), (1, 20, 2), (2, 20, 1)], COUNTS)
    lists = damped_vote_lists(train, [0, 50], item_percentile=0.0).collect()
    got = {(r.beta, r.rank): (r.item_id, r.score) for r in lists}
    assert got[0, 1] == (10, 100.0)
    assert got[0, 2] == (20, (99 + 100) / 2)
    assert got[50, 1] == (20, 199 / 52)
    assert got[50, 2] == (10, 100 / 51)


def test_items_at_the_percentile_are_kept(spark):
    rows = [(u, i, 1) for i in range(1, 5) for u in range(i)]
    kept = active_items(spark.createDataFrame(rows, COUNTS), 1 / 3).collect()
    assert sorted(r.item_id for r in kept) == [2, 3, 4]


def test_ground_truth_is_ranked_without_gaps(spark):
    rows = [(1, i, i % 3) for i in range(10)]
    got = ground_truth(spark.createDataFrame(rows, COUNTS), 4, ["user_id"]).orderBy("rank").collect()
    assert [(r.rank, r.item_id) for r in got] == [(1, 2), (2, 5), (3, 8), (4, 1)]


def test_unseen_lists_of_a_user_with_most_pairs(spark):
    rng = random.Random(4)
    rows = [(u, i) for u in range(30) for i in rng.sample(range(300), 8)]
    rows += [(77, i) for i in range(300) if i % 41] + [(78, i) for i in range(300)]
    df = spark.createDataFrame([(u, i, 1) for u, i in sorted(set(rows))], COUNTS)
    ranked = rank_items(item_popularity(df), "users")
    order = [r.item_id for r in ranked.orderBy("rank").collect()]
    for slices, head in ((16, 10), (7, 0), (1000, 1000)):
        got = {}
        for r in unseen_lists(ranked, df, 12, slices, head).orderBy("user_id", "rank").collect():
            got.setdefault(r.user_id, []).append(r.item_id)
            assert r.rank == len(got[r.user_id])
        had = {}
        for u, i in rows:
            had.setdefault(u, set()).add(i)
        assert got == {u: want for u, own in had.items() if (want := [i for i in order if i not in own][:12])}


def test_unseen_lists_are_whole(spark):
    train = [(1, 10), (1, 30), (2, 10), (2, 20), (2, 30), (2, 40), (3, 10), (4, 20), (4, 30), (None, 50), (5, 60)]
    df = spark.createDataFrame([(u, i, 1) for u, i in train], COUNTS)
    ranked = rank_items(item_popularity(df), "users").cache()
    order = [r.item_id for r in ranked.orderBy("rank").collect()]
    assert [r.rank for r in ranked.orderBy("rank").collect()] == list(range(1, 7))
    assert order == [10, 30, 20, 40, 50, 60]
    for k in (1, 3, 10):
        got = {}
        for r in unseen_lists(ranked, df, k).orderBy("user_id", "rank").collect():
            got.setdefault(r.user_id, []).append(r.item_id)
            assert r.rank == len(got[r.user_id])
        for user in (1, 2, 3, 4, 5):
            had = {i for u, i in train if u == user}
            assert got.get(user, []) == [i for i in order if i not in had][:k]


def test_unseen_lists_take_more_tasks_as_they_grow(spark):
    """Few bytes become k rows a user, so the bytes must not decide over the tasks."""
    df = spark.createDataFrame([(u, u % 7, 1) for u in range(400)] * 2, COUNTS)
    lists = unseen_lists(rank_items(item_popularity(df), "users"), df, 5, task_rows=100)
    parts = {r._p: r["count"] for r in lists.groupBy(F.spark_partition_id().alias("_p")).count().collect()}
    assert len(parts) > 10 and max(parts.values()) < 400
    assert lists.count() == 400 * 5


def test_unseen_lists_with_repeated_pairs_and_a_hot_user(spark):
    rng = random.Random(8)
    rows = [(u, i) for u in range(20) for i in rng.sample(range(200), 6)] + [(77, i) for i in range(200) if i % 9]
    df = spark.createDataFrame([(u, i, 1) for u, i in sorted(rows)], COUNTS)
    twice = df.unionByName(df.where("item_id % 2 = 0")).unionByName(spark.createDataFrame([(3, None, 1)], COUNTS))
    ranked = rank_items(item_popularity(df), "users")
    want = sorted(map(tuple, unseen_lists(ranked, df, 9, 50, 1000).collect()))
    for slices, head in ((16, 30), (7, 0), (1000, 1000), (16, 150)):
        assert sorted(map(tuple, unseen_lists(ranked, twice, 9, slices, head).collect())) == want
