"""Sweeps: damping constants, split seeds and training-set sizes, each as one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.config import SplitParams, VoteParams
from tallyrec.functions.keys import hash_key, key_below
from tallyrec.operators.interactions import activity_threshold
from tallyrec.operators.metrics import evaluate
from tallyrec.operators.popularity import damped_vote_lists, popularity_list
from tallyrec.operators.ranking import ground_truth
from tallyrec.operators.split import hashed_rank, ntile_of
from tallyrec.plans.prepare import split_truth
from tallyrec.sources.stage import materialise


def beta_sweep(
    splits: DataFrame,
    vote: VoteParams = VoteParams(),
    list_size: int = 100,
    ks: Sequence[int] = (),
) -> DataFrame:
    """(split, beta, users, map, ..) of the damped vote model for every beta.

    ``splits`` is read three times, so pass a stage table.
    """
    train = splits.where("split = 'train'").drop("split")
    lists = damped_vote_lists(train, vote.betas, vote.item_percentile, list_size)
    return evaluate(
        split_truth(splits, list_size), lists, ks=ks, model="beta", values=vote.betas,
        list_size=list_size,
    )


def best_of(
    results: DataFrame, parameter: str, metric: str = "map", choose_on: str = "val"
) -> DataFrame:
    """The parameter value with the best validation metric, with all its splits.

    Ties go to the smaller value. ``best_at_edge`` warns that the optimum may
    lie outside the searched range.
    """
    per_split = [
        F.max(F.when(F.col("split") == s, F.col(metric))).alias(f"{s}_{metric}")
        for s in ("train", "val", "test")
    ]
    wide = results.groupBy(parameter).agg(*per_split)
    ends = wide.agg(F.min(parameter).alias("_lo"), F.max(parameter).alias("_hi"))
    lowest, highest = ends.select("_lo").scalar(), ends.select("_hi").scalar()
    chosen = wide.orderBy(F.desc(f"{choose_on}_{metric}"), F.asc(parameter)).limit(1)
    at_edge = (F.col(parameter) == lowest) | (F.col(parameter) == highest)
    return chosen.withColumn("best_at_edge", at_edge)


def seed_sweep(
    counts: DataFrame,
    activity: DataFrame,
    seeds: Sequence[int],
    params: SplitParams = SplitParams(),
    list_size: int = 100,
) -> DataFrame:
    """(seed, users, map) of the popularity model on the validation fold of each seed."""
    grid = F.explode(F.array(*[F.lit(int(s)) for s in seeds])).alias("seed")
    # the seed leads the hashed text, exactly as in a single split
    keyed = counts.select("*", grid).withColumn(
        "_key", hash_key(None, "seed", "user_id", "item_id")
    )
    loads = activity.select(grid, "user_id", F.col("pairs").alias("load"))
    ranked = hashed_rank(keyed, ["user_id", "seed"], "_key", ["item_id"], loads)
    limit = activity_threshold(activity, params.percentile_cut).scalar()
    in_train = ntile_of(F.col("pos"), F.col("size"), params.folds) < params.folds
    folds = materialise(
        ranked.where(F.col("size") >= limit).select(
            in_train.alias("in_train"), "seed", "user_id", "item_id", "n"
        ),
        "seed-folds",
        partition_by="in_train",
    )
    lists = popularity_list(folds.where("in_train"), list_size, by=["seed"])
    truth = ground_truth(folds.where("not in_train"), list_size, ["user_id", "seed"])
    return evaluate(truth, lists, ks=(), groups=["seed"], list_size=list_size).select(
        "seed", "users", "map"
    )


def spread(results: DataFrame, metric: str = "map") -> DataFrame:
    """Mean and sample deviation of a metric over the rows of a sweep."""
    return results.agg(
        F.count(metric).alias("runs"),
        F.avg(metric).alias(f"mean_{metric}"),
        F.stddev_samp(metric).alias(f"stddev_{metric}"),
    )


def sample_pairs(train: DataFrame, fraction: float, seed: int = 10) -> DataFrame:
    """A reproducible sample of the pairs: smaller fractions are subsets of larger ones."""
    return train.where(key_below(hash_key(f"size|{seed}", "user_id", "item_id"), fraction))


def size_sweep(
    splits: DataFrame,
    fractions: Sequence[float],
    seed: int = 10,
    list_size: int = 100,
    split: str = "val",
) -> DataFrame:
    """(fraction, train_rows, users, map): popularity fitted on growing samples."""
    train = splits.where("split = 'train'").withColumn(
        "_key", hash_key(f"size|{seed}", "user_id", "item_id")
    )
    # the fractions a pair belongs to; null where it does not, dropped by the filter
    grid = F.explode(
        F.array(*[F.when(key_below(F.col("_key"), f), F.lit(float(f))) for f in fractions])
    )
    sampled = train.select("user_id", "item_id", "n", grid.alias("fraction")).where(
        "fraction is not null"
    )
    lists = popularity_list(sampled, list_size, by=["fraction"])
    truth = split_truth(splits.where(F.col("split") == split), list_size)
    scores = evaluate(
        truth, lists, ks=(), model="fraction", values=[float(f) for f in fractions],
        list_size=list_size,
    )
    sizes = sampled.groupBy("fraction").agg(F.count(F.lit(1)).alias("train_rows"))
    # one row per fraction
    return scores.join(F.broadcast(sizes), "fraction", "left").select(
        "fraction", F.coalesce("train_rows", F.lit(0)).alias("train_rows"), "users", "map"
    )
