"""Folds: equal to the plain window, even with a user holding most of the rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyrec.config import SplitParams
from tallyrec.functions.keys import hash_key, key_below
from tallyrec.operators.interactions import count_interactions, user_activity
from tallyrec.operators.split import (
    assign_folds,
    hashed_rank,
    ntile_of,
    split_counts,
    uncovered_users,
)


def skewed_counts(spark):
    """User 7 and the rows without a user hold a third each; the rest is spread out."""
    rows = [(7, i, 1) for i in range(3000)] + [(None, i, 1) for i in range(3000)]
    rows += [(100 + u, (u * 31 + j) % 5000, 1 + j % 3) for u in range(600) for j in range(u % 11)]
    return spark.createDataFrame(rows, "user_id long, item_id long, n long")


def plain_folds(counts, seed=10, folds=5):
    w = Window.partitionBy("user_id")
    order = w.orderBy(hash_key(seed, "user_id", "item_id"), "item_id")
    return counts.withColumn("size", F.count("*").over(w)).withColumn(
        "fold", F.ntile(folds).over(order)
    )


def rows_of(df):
    return sorted(map(str, df.select("user_id", "item_id", "n", "size", "fold").collect()))


@pytest.mark.parametrize("skew", [{}, {"min_hot_rows": 100, "max_hot": 1000}, {"min_hot_rows": 1}])
def test_same_folds_as_the_window(spark, skew):
    counts = skewed_counts(spark)
    folded = assign_folds(counts, user_activity(counts), **skew)
    assert rows_of(folded) == rows_of(plain_folds(counts))


def test_hot_user_is_cut_into_even_slices(spark):
    counts = skewed_counts(spark).withColumn("_key", hash_key(1, "user_id", "item_id"))
    loads = user_activity(counts).select("user_id", F.col("pairs").alias("load"))
    ranked = hashed_rank(counts, ["user_id"], "_key", ["item_id"], loads, min_hot_rows=200)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    # the slices the ranking windows work on
    hot = counts.where("user_id = 7").select(
        F.floor(F.conv(F.hex(F.substring("_key", 1, 4)), 16, 10).cast("double") / 2**32 * 15)
    )
    sizes = [r["count"] for r in hot.groupBy(hot.columns[0]).count().collect()]
    assert len(sizes) == 15 and max(sizes) < 300


def test_result_does_not_depend_on_partitioning(spark):
    counts = skewed_counts(spark)
    seen = []
    for shuffles, parts in (("1", 1), ("8", 13)):
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        moved = counts.repartition(parts)
        seen.append(rows_of(assign_folds(moved, user_activity(moved), min_hot_rows=500)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1]


@pytest.mark.parametrize("tiles", [1, 2, 5, 7])
def test_ntile_formula(spark, tiles):
    df = spark.range(1, 30).select(F.explode(F.sequence(F.lit(1), F.col("id"))).alias("pos"), "id")
    w = Window.partitionBy("id").orderBy("pos")
    both = df.select(
        ntile_of(F.col("pos"), F.col("id"), tiles).alias("a"), F.ntile(tiles).over(w).alias("b")
    )
    assert both.where("a != b").count() == 0


def test_small_user_has_no_validation_row(spark):
    counts = spark.createDataFrame([(1, i, 1) for i in range(4)], "user_id long, item_id long, n long")
    folded = assign_folds(counts, user_activity(counts))
    assert sorted(r.fold for r in folded.collect()) == [1, 2, 3, 4]
    assert [(r.user_id, r.size) for r in uncovered_users(user_activity(counts)).collect()] == [(1, 4)]


def test_splits_partition_the_training_counts(spark):
    log = spark.createDataFrame(
        [("train", u, i) for u in range(20) for i in range(u + 1)]
        + [("test", u, i) for u in range(5) for i in range(9)],
        "kind string, user_id long, item_id long",
    )
    counts = count_interactions(log, ["kind"])
    splits = split_counts(counts, user_activity(counts, ["kind"]), SplitParams(percentile_cut=0.5))
    sizes = {r["split"]: r["count"] for r in splits.groupBy("split").count().collect()}
    kept = sum(u + 1 for u in range(20) if u + 1 >= 10.5)
    assert sizes["train"] + sizes["val"] == kept
    assert sizes["test"] == 45
    assert splits.groupBy("split", "user_id", "item_id").count().where("count > 1").count() == 0


def test_null_item_is_a_pair_but_not_an_item(spark):
    counts = spark.createDataFrame([(1, None, 2), (1, 5, 1)], "user_id long, item_id long, n long")
    assert user_activity(counts).first().asDict() == {"user_id": 1, "items": 1, "pairs": 2}


def test_samples_are_nested(spark):
    rows = spark.range(2000).select(F.lit(1).alias("u"), F.col("id").alias("i"))
    key = hash_key("s", "u", "i")
    small = {r.i for r in rows.where(key_below(key, 0.1)).collect()}
    large = {r.i for r in rows.where(key_below(key, 0.5)).collect()}
    assert small < large and 120 < len(small) < 280 and 880 < len(large) < 1120
    assert rows.where(key_below(key, 1.0)).count() == 2000
