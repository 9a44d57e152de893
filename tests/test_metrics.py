"""Metrics against hand-made cases and against Spark's own implementations."""

import random
import re

import pytest
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.mllib.evaluation import RankingMetrics
from pyspark.sql import functions as F

from tallyrec.operators.metrics import evaluate
from tallyrec.operators.ranking import ground_truth


def truth_of(spark, by_user):
    rows = [("t", u, i) for u, items in by_user.items() for i in items]
    return spark.createDataFrame(rows, "split string, user_id long, item_id long")


def global_list(spark, items):
    return spark.createDataFrame(list(enumerate(items, 1)), "rank int, item_id long")


def user_lists(spark, by_user):
    rows = [(u, r, i) for u, items in by_user.items() for r, i in enumerate(items, 1)]
    return spark.createDataFrame(rows, "user_id long, rank int, item_id long")


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_truth_shorter_than_list(spark):
    got = one(evaluate(truth_of(spark, {1: [2]}), global_list(spark, [1, 2, 3, 4]), ks=(2,)))
    assert got["map"] == 0.5
    assert got["precision_at_2"] == 0.5
    assert got["recall_at_2"] == 1.0
    assert got["ndcg_at_2"] == pytest.approx(0.6309297536)


def test_truth_longer_than_list(spark):
    got = one(evaluate(truth_of(spark, {1: [1, 2, 3, 4]}), global_list(spark, [1, 2]), ks=(2,)))
    assert got["map"] == 0.5
    assert got["map_at_2"] == 1.0
    assert got["precision_at_2"] == 1.0
    assert got["recall_at_2"] == 0.5
    assert got["ndcg_at_2"] == pytest.approx(1.0)
    assert got["map_hit_norm"] == 1.0


def test_no_hit_counts_as_zero(spark):
    got = one(evaluate(truth_of(spark, {1: [1], 2: [9]}), global_list(spark, [1]), ks=(1,)))
    assert got["users"] == 2
    assert got["map"] == 0.5
    got = one(evaluate(truth_of(spark, {1: [8], 2: [9]}), global_list(spark, [1]), ks=(1,)))
    assert got["map"] == 0 and got["ndcg_at_1"] == 0 and got["map_hit_norm"] == 0


def test_model_without_hits_keeps_its_row(spark):
    lists = spark.createDataFrame([(0, 1, 1), (5, 1, 7)], "beta int, rank int, item_id long")
    got = evaluate(truth_of(spark, {1: [1]}), lists, ks=(), model="beta", values=(0, 5, 9))
    assert {r.beta: r.map for r in got.collect()} == {0: 1.0, 5: 0.0, 9: 0.0}


def test_repeated_list_item_is_rejected(spark):
    truth = truth_of(spark, {1: [1, 2]})
    with pytest.raises(Exception, match="repeated key"):
        evaluate(truth, global_list(spark, [1, 1, 2])).collect()
    with pytest.raises(Exception, match="repeated key"):
        evaluate(truth, user_lists(spark, {1: [1, 1, 2]})).collect()


def test_population(spark):
    truth = truth_of(spark, {1: [1], 2: [1]})
    lists = user_lists(spark, {1: [1], 3: [1]})
    both = one(evaluate(truth, lists, ks=(), population="both"))
    assert (both["users"], both["map"]) == (1, 1.0)
    everyone = one(evaluate(truth, lists, ks=()))
    assert (everyone["users"], everyone["map"]) == (2, 0.5)
    with pytest.raises(ValueError):
        evaluate(truth, lists, population="lists")


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="rank"):
        evaluate(truth_of(spark, {1: [1]}), truth_of(spark, {1: [1]}).select("item_id"))


@pytest.fixture(scope="module")
def random_lists():
    rng = random.Random(3)
    truth = {u: rng.sample(range(40), rng.randint(1, 15)) for u in range(30)}
    lists = {u: rng.sample(range(40), rng.randint(1, 12)) for u in range(30)}
    return truth, lists


def test_agrees_with_ranking_metrics(spark, random_lists):
    truth, lists = random_lists
    got = one(evaluate(truth_of(spark, truth), user_lists(spark, lists), ks=(3, 10)))
    pairs = spark.sparkContext.parallelize(
        [([float(i) for i in lists[u]], [float(i) for i in truth[u]]) for u in truth]
    )
    theirs = RankingMetrics(pairs)
    assert got["map"] == pytest.approx(theirs.meanAveragePrecision)
    for k in (3, 10):
        assert got[f"map_at_{k}"] == pytest.approx(theirs.meanAveragePrecisionAt(k))
        assert got[f"precision_at_{k}"] == pytest.approx(theirs.precisionAt(k))
        assert got[f"recall_at_{k}"] == pytest.approx(theirs.recallAt(k))
        assert got[f"ndcg_at_{k}"] == pytest.approx(theirs.ndcgAt(k))


def test_agrees_with_ranking_evaluator(spark, random_lists):
    truth, lists = random_lists
    df = spark.createDataFrame(
        [([float(i) for i in lists[u]], [float(i) for i in truth[u]]) for u in truth],
        "prediction array<double>, label array<double>",
    )
    got = one(evaluate(truth_of(spark, truth), user_lists(spark, lists), ks=()))
    assert got["map"] == pytest.approx(RankingEvaluator().evaluate(df))


def test_each_model_answers_for_its_own_users(spark):
    truth = spark.createDataFrame([("t", 1, 10), ("t", 2, 20)], "split string, user_id long, item_id long")
    lists = spark.createDataFrame(
        [("a", 1, 1, 10), ("b", 1, 1, 10), ("b", 2, 1, 99)],
        "model string, user_id long, rank int, item_id long",
    )
    got = evaluate(truth, lists, ks=(), model="model", values=["a", "b", "c"], population="both").collect()
    assert {r["model"]: (r["users"], r["map"]) for r in got} == {"a": (1, 1.0), "b": (2, 0.5)}


def test_short_lists_are_met_by_long_truth_in_more_tasks(spark):
    """One list row a user meets 30 rows of truth: the longer side decides over the tasks."""
    truth = {u: [u, *range(1000, 1029)] for u in range(20)}
    df = evaluate(truth_of(spark, truth), user_lists(spark, {u: [u] for u in range(20)}), ks=(1,), task_rows=50)
    plan = df._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(user_id#\d+L, item_id#\d+L, (\d+)\), REPARTITION_BY_NUM", plan)
    assert len(dealt) == 2 and set(dealt) == {"12"}
    got = one(df)
    assert (got["users"], got["precision_at_1"]) == (20, 1.0)


def test_truth_of_per_user_lists_is_stored(spark):
    """It is counted, sized, joined: none of these ranks it once more."""
    ranked = ground_truth(truth_of(spark, {1: [1, 2], 2: [3]}).withColumn("n", F.lit(1)), 1)
    df = evaluate(ranked, user_lists(spark, {1: [2, 1], 2: [3]}), ks=())
    # what is left numbers hits, not rows of the truth
    assert "WindowGroupLimit" not in df._jdf.queryExecution().executedPlan().toString()
    assert one(df)["map"] == 0.75
