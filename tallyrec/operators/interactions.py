"""From an event log to per-user item counts, activity profiles and thresholds.

``by`` names extra grouping columns (for example the provenance of the rows),
so that one plan serves several tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.schemas import require_columns


def count_interactions(
    log: DataFrame, by: Sequence[str] = (), user: str = "user_id", item: str = "item_id"
) -> DataFrame:
    """Events per (user, item) as ``n``; hot pairs shrink to one row before the shuffle."""
    require_columns(log, [*by, user, item], "count_interactions")
    return log.groupBy(*by, F.col(user).alias("user_id"), F.col(item).alias("item_id")).agg(
        F.count(F.lit(1)).alias("n")
    )


def user_activity(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per user: distinct non-null ``items``, and ``pairs``, where a null item counts too."""
    return counts.groupBy(*by, "user_id").agg(
        F.count("item_id").alias("items"), F.count(F.lit(1)).alias("pairs")
    )


def _histogram(sizes: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """How many rows have each value. The distinct sizes of groups that sum to N
    rows number at most sqrt(2N), so everything after this step is small."""
    return sizes.groupBy(*by, column).agg(F.count(F.lit(1)).alias("_freq"))


def exact_percentile(
    sizes: DataFrame, column: str, fraction: float, by: Sequence[str] = ()
) -> DataFrame:
    """Exact interpolated percentile of a group-size column, as ``threshold``."""
    return (
        _histogram(sizes, column, by)
        .groupBy(*by)
        .agg(F.percentile(column, fraction, F.col("_freq")).alias("threshold"))
    )


def activity_threshold(
    activity: DataFrame, fraction: float, by: Sequence[str] = ()
) -> DataFrame:
    """Percentile of the users' distinct-item counts."""
    return exact_percentile(activity, "items", fraction, by)


def activity_profile(activity: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Minimum, quartiles, maximum and mean of the users' distinct-item counts."""
    weight = F.col("_freq")
    quartiles = F.percentile("items", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), weight)
    profile = (
        _histogram(activity, "items", by)
        .groupBy(*by)
        .agg(
            F.min("items").alias("min_items"),
            quartiles.alias("_q"),
            F.max("items").alias("max_items"),
            (F.sum(F.col("items") * weight) / F.sum(weight)).alias("avg_items"),
        )
    )
    return profile.select(
        *by,
        "min_items",
        F.col("_q")[0].alias("q1"),
        F.col("_q")[1].alias("q2"),
        F.col("_q")[2].alias("q3"),
        "max_items",
        "avg_items",
    )


def active_users(activity: DataFrame, fraction: float, by: Sequence[str] = ()) -> DataFrame:
    """Users with at least the percentile's number of pairs (the threshold is kept)."""
    limits = activity_threshold(activity, fraction, by)
    if not by:
        return activity.where(F.col("pairs") >= limits.scalar())
    # one row per `by` label, and labels are given in code: always a handful
    kept = activity.join(F.broadcast(limits), list(by)).where("pairs >= threshold")
    return kept.drop("threshold")


def table_shapes(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Row count of each split, with the width of the table."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns) - len(by)).alias("n_columns")
    )
