"""Ranking metrics over long-form lists, computed as joins and aggregates.

Definitions (h = index of a hit among the hits, r = its rank in the list):

* ``map``            sum(h / r) / |ground truth|, averaged over users
* ``map_hit_norm``   sum(h / r) / hits, 0 without hits, averaged over users
* ``map_at_k``       the same over ranks <= k, divided by min(|ground truth|, k)
* ``precision_at_k`` hits in the first k / k
* ``recall_at_k``    hits in the first k / |ground truth|
* ``ndcg_at_k``      sum(1 / ln(r + 1)) over the ideal sum for min(|ground truth|, k)
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrec.operators.ranking import TASK_ROWS, tasks_of
from tallyrec.schemas import require_columns, unique_by
from tallyrec.sources.stage import materialise


def evaluate(
    truth: DataFrame,
    lists: DataFrame,
    *,
    ks: Sequence[int] = (100,),
    groups: Sequence[str] = ("split",),
    model: str | None = None,
    values: Sequence[object] = (),
    population: str = "truth",
    list_size: int = 100,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """One row of metrics per ``groups`` (and per ``model`` value).

    ``truth`` has (groups.., user_id, item_id), each item once per user.
    ``lists`` has (rank, item_id) for a global list, plus user_id for per-user
    lists, plus whichever of ``groups`` it depends on, plus the ``model`` column
    whose possible ``values`` are given so that a model without any hit still
    gets its row of zeros. ``population`` says which users are averaged over:
    every user with ground truth, or ("both") those who also have a list, of the
    model at hand if there are several; a model without any such user has no row.
    With per-user lists the truth is stored, both are counted first and joined in tasks of about ``task_rows`` rows of
    the longer one.
    """
    require_columns(truth, [*groups, "user_id", "item_id"], "evaluate: truth")
    require_columns(lists, ["rank", "item_id", *([model] if model else [])], "evaluate: lists")
    if population not in ("truth", "both"):
        raise ValueError(f"unknown population {population!r}")
    per_user = "user_id" in lists.columns
    shared = [g for g in groups if g in lists.columns]
    owner = [*shared, *(["user_id"] if per_user else [])]
    models = [model] if model else []

    # rows without a user are nobody's ground truth; said once, so that every
    # branch below reads the same shuffled data
    truth = truth.where(" and ".join(f"{c} is not null" for c in ["user_id", *groups]))
    if per_user:
        truth = materialise(truth.select(*groups, "user_id", "item_id"), "truth")
    sizes = truth.groupBy("user_id", *groups).agg(F.count("item_id").alias("_m"))
    listed, pairs = lists.where(F.col("rank") <= list_size), truth.select(*groups, "user_id", "item_id")
    if per_user:
        # dealt out by their rows: grouping lists before a shuffle would hold every row of a task and merge none, and
        # short lists can meet many times as much truth
        tasks = tasks_of(lists, max(lists.count(), truth.count()), task_rows)
        listed, pairs = (side.repartition(tasks, *owner, "item_id") for side in (listed, pairs))
    listed = unique_by(listed, [*models, *owner, "item_id"], ["rank"], "list item")
    counted = sizes
    if per_user:
        if population == "both":
            # a model answers for the users it has a list for, not for another model's
            owners = lists.select(*models, *owner).distinct()
            counted = sizes.join(owners, owner)
    else:
        # list_size rows per model value and shared group, all named by the caller
        listed = F.broadcast(listed)
    hits = pairs.join(listed, [*owner, "item_id"])

    scored = _user_sums(hits, ["user_id", *groups, *models], ks).join(
        sizes, ["user_id", *groups]
    )
    names, metrics = _user_metrics(ks)
    sums = scored.groupBy(*groups, *models).agg(
        *[F.sum(metric).alias(name) for name, metric in zip(names, metrics)]
    )

    if model and per_user and population == "both":
        users = counted.groupBy(*groups, model).agg(F.count(F.lit(1)).alias("users"))
    else:
        users = counted.groupBy(*groups).agg(F.count(F.lit(1)).alias("users"))
        if model:
            users = users.withColumn(model, F.explode(F.array(*[F.lit(v) for v in values])))
    averaged = [
        (F.coalesce(F.col(n), F.lit(0.0)) / F.col("users")).alias(n) for n in names
    ]
    # both sides hold one row per group and model
    return users.join(F.broadcast(sums), [*groups, *models], "left").select(
        *groups, *models, "users", *averaged
    )


def _user_sums(hits: DataFrame, keys: Sequence[str], ks: Sequence[int]) -> DataFrame:
    """Per user: hits and gains overall and within each k (at most one list long)."""
    order = Window.partitionBy(*keys).orderBy("rank")
    found = hits.select(*keys, "rank", F.row_number().over(order).alias("_h"))
    ratio = F.col("_h").cast("double") / F.col("rank")
    gain = F.lit(1.0) / F.log(F.col("rank") + F.lit(1.0))
    sums = [F.sum(ratio).alias("_ap"), F.count(F.lit(1)).alias("_hits")]
    for k in ks:
        near = F.col("rank") <= k
        sums += [
            F.count_if(near).alias(f"_hits_{k}"),
            F.sum(F.when(near, ratio).otherwise(0.0)).alias(f"_ap_{k}"),
            F.sum(F.when(near, gain).otherwise(0.0)).alias(f"_dcg_{k}"),
        ]
    return found.groupBy(*keys).agg(*sums)


def _user_metrics(ks: Sequence[int]) -> tuple[list[str], list[Column]]:
    size = F.col("_m").cast("double")
    names = ["map", "map_hit_norm"]
    metrics = [F.col("_ap") / size, F.col("_ap") / F.col("_hits")]
    for k in ks:
        ideal = F.element_at(_ideal_gains(k), F.least(F.col("_m"), F.lit(k)).cast("int"))
        names += [f"map_at_{k}", f"precision_at_{k}", f"recall_at_{k}", f"ndcg_at_{k}"]
        metrics += [
            F.col(f"_ap_{k}") / F.least(size, F.lit(float(k))),
            F.col(f"_hits_{k}") / F.lit(float(k)),
            F.col(f"_hits_{k}") / size,
            F.col(f"_dcg_{k}") / ideal,
        ]
    return names, metrics


def _ideal_gains(k: int) -> Column:
    """Running sums of 1 / ln(i + 1), i = 1..k: the gain of a list that only hits."""
    return F.array(*[F.lit(g) for g in accumulate(1.0 / math.log(i + 1.0) for i in range(1, k + 1))])
