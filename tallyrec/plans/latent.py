"""Latent-factor runs: fit, recommend, evaluate, and the grid and size sweeps."""

from __future__ import annotations

import time
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.config import AlsGrid, AlsParams, ForestParams, SearchParams
from tallyrec.operators.factors import (
    AlsInput,
    als_input,
    fit_als,
    item_factors,
    recommend,
    release,
    user_factors,
)
from tallyrec.operators.forest import forest_topk
from tallyrec.operators.metrics import evaluate
from tallyrec.operators.search import lsh_topk
from tallyrec.plans.prepare import split_truth
from tallyrec.plans.sweep import sample_pairs
from tallyrec.sources.stage import materialise
from tallyrec.sources.tables import write_artifact


def label_of(params: AlsParams) -> str:
    return f"{params.rank}-{params.reg}-{params.alpha}"


def point_lists(source: AlsInput, p: AlsParams, k: int, export: str | None = None) -> tuple[DataFrame, dict]:
    """(model, rank_dim, reg, alpha, user_id, rank, item_id, score) of one grid point, and the seconds of its fit.

    ``export`` names a folder to leave the point's factors in, by model. The lists are lazy but for the
    factors they are searched in, which are stored.
    """
    start = time.monotonic()
    fit = fit_als(source, p)
    seconds = time.monotonic() - start
    if export:
        write_artifact(user_factors(fit), export, f"als-user-factors-{label_of(p)}")
        write_artifact(item_factors(fit), export, f"als-item-factors-{label_of(p)}")
    lists = recommend(fit, k).select(
        F.lit(label_of(p)).alias("model"),
        F.lit(p.rank).alias("rank_dim"),
        F.lit(float(p.reg)).alias("reg"),
        F.lit(float(p.alpha)).alias("alpha"),
        "user_id", "rank", "item_id", "score",
    )
    release(fit)
    return lists, {"fit_seconds": seconds}


def fitted_lists(source: AlsInput, points: Sequence[AlsParams], k: int) -> DataFrame:
    """The lists of every grid point, stored one after the other; each fit is distributed."""
    return reduce(
        DataFrame.unionByName, [materialise(point_lists(source, p, k)[0], "als-lists") for p in points]
    )


def als_metrics(
    splits: DataFrame,
    params: AlsParams = AlsParams(),
    ks: Sequence[int] = (),
    list_size: int = 100,
    population: str = "both",
) -> DataFrame:
    """Metrics of one fit on train, val and test, over users with list and ground truth."""
    lists = materialise(recommend(fit_als(als_input(_train(splits)), params), list_size), "als-lists")
    truth = split_truth(splits, list_size)
    return evaluate(truth, lists, ks=ks, population=population, list_size=list_size)


def als_grid(splits: DataFrame, grid: AlsGrid = AlsGrid(), list_size: int = 100) -> DataFrame:
    """(model, rank_dim, reg, alpha, split, users, map) for every point of the grid."""
    points = grid.points()
    lists = fitted_lists(als_input(_train(splits)), points, list_size)
    scores = evaluate(
        split_truth(splits, list_size), lists, ks=(), model="model",
        values=[label_of(p) for p in points], population="both", list_size=list_size,
    )
    settings = splits.sparkSession.createDataFrame(
        [(label_of(p), p.rank, float(p.reg), float(p.alpha)) for p in points],
        "model string, rank_dim int, reg double, alpha double",
    )
    # one row per grid point
    return scores.join(F.broadcast(settings), "model").select(
        *settings.columns, "split", "users", "map"
    )


def als_size_sweep(
    splits: DataFrame,
    fractions: Sequence[float],
    params: AlsParams = AlsParams(),
    list_size: int = 100,
    split: str = "val",
) -> DataFrame:
    """(fraction, train_rows, fit_seconds, users, map): ALS on growing samples."""
    train = _train(splits)
    truth = split_truth(splits.where(F.col("split") == split), list_size)
    rows = []
    for fraction in fractions:
        source = als_input(sample_pairs(train, fraction))
        start = time.monotonic()
        fit = fit_als(source, params)
        seconds = time.monotonic() - start
        lists = materialise(recommend(fit, list_size), "als-lists")
        scores = evaluate(truth, lists, ks=(), population="both", list_size=list_size)
        size = source.ratings.agg(F.count(F.lit(1)).alias("c")).scalar()
        rows.append(
            scores.select(
                F.lit(float(fraction)).alias("fraction"),
                size.alias("train_rows"),
                F.lit(seconds).alias("fit_seconds"),
                "users", "map",
            )
        )
    return reduce(DataFrame.unionByName, rows)


Search = SearchParams | ForestParams


def search_label(search: Search) -> str:
    if isinstance(search, ForestParams):
        return f"{search.trees}t@{search.search_items}"
    return f"{search.tables}x{search.hashes}@{search.width}"


def approximate_topk(queries: DataFrame, items: DataFrame, k: int, search: Search) -> DataFrame:
    """(query_id, rank, item_id, score) by hash tables or by a forest of trees."""
    if isinstance(search, ForestParams):
        return forest_topk(queries, items, k, search)
    return lsh_topk(queries, items, k, search)


def searched_lists(
    users: DataFrame, items: DataFrame, searches: Sequence[Search], k: int
) -> DataFrame:
    """(search, user_id, rank, item_id, score) of approximate search over stored factors."""
    found = [
        approximate_topk(users.withColumnRenamed("user_id", "query_id"), items, k, s).select(
            F.lit(search_label(s)).alias("search"),
            F.col("query_id").alias("user_id"),
            "rank", "item_id", "score",
        )
        for s in searches
    ]
    return materialise(reduce(DataFrame.unionByName, found), "lsh-lists")


def search_scores(
    truth: DataFrame, lists: DataFrame, searches: Sequence[Search], list_size: int = 100
) -> DataFrame:
    """(split, search, users, map, map_hit_norm) of every search setting."""
    return evaluate(
        truth, lists, ks=(), model="search", values=[search_label(s) for s in searches],
        population="both", list_size=list_size,
    )


def lsh_map(
    splits: DataFrame,
    params: AlsParams,
    searches: Sequence[Search],
    list_size: int = 100,
) -> DataFrame:
    """Accuracy of lists found by approximate search over the factors of one fit."""
    fit = fit_als(als_input(_train(splits)), params)
    users = materialise(user_factors(fit), "user-factors")
    items = materialise(item_factors(fit), "item-factors")
    lists = searched_lists(users, items, searches, list_size)
    return search_scores(split_truth(splits, list_size), lists, searches, list_size)


def _train(splits: DataFrame) -> DataFrame:
    return splits.where("split = 'train'").drop("split")
