"""Adapters that shape the star-schema and event tables as interaction logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrec.operators.ranking import TASK_ROWS, tasks_of

ORDERS_CUT = "2000-01-01 00:00:00"  # fixed value: first test-split timestamp
EVENTS_CUT = "2024-01-25 00:00:00"  # fixed value: first test-split timestamp
ORDERS_SMALL_CUT = "1998-01-01 00:00:00"  # the reduced training split ends here


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _kind(ts: Column, cut: str) -> Column:
    return F.when(ts < F.lit(cut).cast("timestamp_ntz"), "train").otherwise("test")


def orders_interactions(spark: SparkSession, sf_dir: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """(kind, user_id, item_id, ts): customers buying parts; pairs rarely repeat.

    Lines are counted (from the files' footers). More than ``task_rows`` to a core are joined in tasks of about that
    many: two keys a row compress to few bytes, and the task that joins them groups them too.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    tasks = tasks_of(lines, lines.count(), task_rows)
    if tasks > spark.sparkContext.defaultParallelism:
        lines, orders = lines.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        _kind(F.col("o_orderdate"), ORDERS_CUT).alias("kind"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("o_orderdate").alias("ts"),
    )


def events_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, user_id, item_id, ts): users acting on 100 things; pairs repeat often."""
    events = table(spark, sf_dir, "events")
    item = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        _kind(F.col("ts"), EVENTS_CUT).alias("kind"), "user_id", item.alias("item_id"), "ts"
    )


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as tracks: every fifth has no canonical key, every seventh an empty one."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    canonical = (
        F.when(key % 5 == 0, F.lit(None).cast("string"))
        .when(key % 7 == 0, F.lit(""))
        .otherwise(F.concat("p_name", F.lit("|"), "p_brand"))
    )
    return part.select(
        F.col("p_partkey").alias("item_id"),
        F.concat(F.lit("m-"), key.cast("string")).alias("recording_msid"),
        canonical.alias("recording_mbid"),
        F.col("p_name").alias("track_name"),
        F.col("p_brand").alias("artist_name"),
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as submissions of recordings: canonical keys shared by four, one by a ninth of all, some missing or
    empty; names shared by some, some in another script or without a letter."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    canonical = (
        F.when(key % 5 == 0, F.lit(None).cast("string"))
        .when(key % 7 == 0, F.lit(""))
        .when(key % 9 == 0, F.lit("b-hot"))
        .otherwise(F.concat(F.lit("b-"), F.floor(key / 4).cast("string")))
    )
    title = (
        F.when(key % 11 == 0, F.concat(F.lit("Песня "), F.floor(key / 22).cast("string")))
        .when(key % 13 == 0, F.lit("!!!"))
        .otherwise(F.col("p_name"))
    )
    return part.select(
        F.concat(F.lit("m-"), key.cast("string")).alias("recording_msid"),
        canonical.alias("recording_mbid"),
        title.alias("track_name"),
        F.concat("p_brand", F.lit("/"), (key % 17).cast("string")).alias("artist_name"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
