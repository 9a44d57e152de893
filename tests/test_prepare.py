"""The shared front of every run takes more tasks as its rows grow, whatever few bytes they compress to."""

import datetime

import pytest
from pyspark.sql import functions as F

from tallyrec.operators.ranking import ground_truth
from tallyrec.plans.prepare import split_truth
from tallyrec.sources import fixtures


@pytest.fixture
def sf_dir(spark, tmp_path):
    """200 orders of four lines, one of 100; a line without an order, one without a key, orders that repeat or have none."""
    day = datetime.datetime(1999, 12, 1)
    orders = [(o, o % 17, day + datetime.timedelta(days=o % 60)) for o in range(200)]
    orders += [orders[7], (None, 1, day), (900, None, day), (901, 3, None)]
    lines = [(o, o * 7 % 50 + i) for o in range(200) for i in range(4)] + [(5, i) for i in range(100)]
    lines += [(777, 1), (None, 2), (900, 3), (901, None)]
    schema = "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"
    spark.createDataFrame(orders, schema).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_lines_are_joined_in_tasks_that_grow_with_them(spark, sf_dir):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log = fixtures.orders_interactions(spark, sf_dir, task_rows=50)
        parts = {r._p: r["count"] for r in log.groupBy(F.spark_partition_id().alias("_p")).count().collect()}
        assert len(parts) > 10 and max(parts.values()) < 200
        plain = fixtures.orders_interactions(spark, sf_dir)
        assert log.count() == plain.count() == 200 * 4 + 100 + 4 + 2
        assert log.exceptAll(plain).isEmpty() and plain.exceptAll(log).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_truth_of_splits_is_ranked_in_tasks_that_grow_with_them(spark, tmp_path):
    """One file, read by one task, a hot user in it: dealt out, no task sorts more than its share."""
    rows = [("train", 1, i, i % 7) for i in range(500)] + [("val", u, i, 1) for u in range(40) for i in range(8)]
    rows += [("val", None, 1, 2), ("train", 2, None, 1), ("val", 3, 5, 1)]
    df = spark.createDataFrame(rows, "split string, user_id long, item_id long, n long")
    df.coalesce(1).write.partitionBy("split").parquet(f"{tmp_path}/splits")
    splits = spark.read.schema(df.schema).parquet(f"{tmp_path}/splits")
    truth = split_truth(splits, 5, task_rows=50)
    plan = truth._jdf.queryExecution().executedPlan().toString()
    # read, dealt out by number, cut to k in every task, shuffled to the user's task, cut again
    steps = [plan.index(s) for s in ("Final", "ENSURE_REQUIREMENTS", "Partial", "REPARTITION_BY_NUM", "FileScan")]
    assert steps == sorted(steps) and "item_id" in plan[steps[3] - 60 : steps[3]]
    want = ground_truth(splits, 5)
    assert truth.count() == want.count() and truth.exceptAll(want).isEmpty()
