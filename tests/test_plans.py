"""The physical plans keep what makes them scale."""

import re

import pytest
from pyspark.sql import functions as F

from tallyrec.operators import ids
from tallyrec.operators.interactions import count_interactions, user_activity
from tallyrec.operators.metrics import evaluate
from tallyrec.operators.popularity import damped_vote_lists, popularity_list
from tallyrec.operators.ranking import ground_truth
from tallyrec.operators.search import exact_topk
from tallyrec.operators.split import split_counts
from tallyrec.plans.sweep import size_sweep
from tallyrec.sources import fixtures

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def splits(spark, tmp_path_factory):
    counts = count_interactions(fixtures.orders_interactions(spark, SF), ["kind"])
    path = str(tmp_path_factory.mktemp("plans") / "splits")
    split_counts(counts, user_activity(counts, ["kind"])).write.partitionBy("split").parquet(path)
    return spark.read.parquet(path)


def test_counting_reads_only_the_key_columns(spark):
    plan = plan_of(count_interactions(fixtures.orders_interactions(spark, SF), ["kind"]))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "partial_count" in plan


def test_split_filter_reaches_the_scan(spark):
    log = fixtures.orders_interactions(spark, SF)
    plan = plan_of(log.where(F.col("ts") < F.lit("1998-01-01").cast("timestamp_ntz")))
    assert re.search(r"PushedFilters: \[.*LessThan\(o_orderdate", plan)


def test_ranking_limits_groups_before_the_shuffle(splits):
    plan = plan_of(ground_truth(splits))
    final, partial = plan.index("Final"), plan.index("Partial")
    assert final < plan.index("Exchange hashpartitioning") < partial


def test_popularity_takes_the_top_without_a_total_sort(splits):
    plan = plan_of(popularity_list(splits.where("split = 'train'")))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
    assert "PartitionFilters: [isnotnull(split" in plan


def test_votes_of_all_betas_share_one_pass(splits):
    train = splits.where("split = 'train'")
    plan = plan_of(damped_vote_lists(train, [0, 10, 50]))
    assert "LeftSemi" in plan
    assert len(re.findall(r"Window \[row_number\(\) windowspecdefinition\(user_id", plan)) == 1


@pytest.mark.parametrize("name", ["evaluate", "ids", "size", "search", "splits"])
def test_no_cross_join(spark, splits, name):
    train = splits.where("split = 'train'").drop("split")
    counts = count_interactions(fixtures.orders_interactions(spark, SF), ["kind"])
    vectors = fixtures.table(spark, SF, "embeddings").withColumnRenamed("embedding", "features")
    df = {
        "evaluate": lambda: evaluate(ground_truth(splits), popularity_list(train)),
        "ids": lambda: ids.dense_ids(train, "item_id", "i"),
        "size": lambda: size_sweep(splits, (0.5, 1.0)),
        "search": lambda: exact_topk(
            vectors.withColumnRenamed("vec_id", "query_id"),
            vectors.withColumnRenamed("vec_id", "item_id"),
            3,
        ),
        "splits": lambda: split_counts(counts, user_activity(counts, ["kind"])),
    }[name]()
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_ids_gather_only_bucket_totals_in_one_place(spark):
    keys = spark.range(1000).select(F.col("id").alias("k"))
    plan = plan_of(ids.dense_ids(keys, "k", "i"))
    single = plan[plan.index("Exchange SinglePartition") :].splitlines()
    # directly below the only gathering exchange: the aggregate over 4096 buckets
    assert "HashAggregate(keys=[_bucket" in "\n".join(single[:4])


def test_metrics_shuffle_the_ground_truth_once(spark, splits):
    df = evaluate(ground_truth(splits), popularity_list(splits.where("split = 'train'")))
    df.collect()
    plan = plan_of(df).split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 2  # ground truth, popularity
    assert plan.count("ReusedExchange") >= 2


def test_hot_key_of_an_encoding_join_is_split(spark, tmp_path):
    """Half of the log has one key; adaptive execution spreads it over tasks."""
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    hot = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id"))
    log = spark.range(0, 40000, 1, 8).select(
        (F.col("id") % 50).alias("user_id"), hot.cast("string").alias("recording_msid")
    )
    items = log.select("recording_msid").distinct().withColumn("track_id", F.xxhash64("recording_msid"))
    users = log.select("user_id").distinct().withColumn("u_id", F.col("user_id"))
    for name, df in (("log", log), ("items", items), ("users", users)):
        df.write.parquet(f"{tmp_path}/{name}")
    log, items, users = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("log", "items", "users"))
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        encoded = ids.encode(log, items, users, trusted=True)
        assert len(encoded.collect()) == 40000
        assert "skew=true" in plan_of(encoded)
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
