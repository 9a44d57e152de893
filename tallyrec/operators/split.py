"""Reproducible per-user splits that survive a user holding most of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrec.config import SplitParams
from tallyrec.functions.keys import hash_key, key_position
from tallyrec.operators.interactions import activity_threshold
from tallyrec.schemas import require_columns

MAX_HOT = 100_000  # most groups (and twice that, slices) ever broadcast
MIN_HOT_ROWS = 1_000_000  # smaller groups are never worth slicing


def hashed_rank(
    rows: DataFrame,
    groups: Sequence[str],
    key: str,
    ties: Sequence[str],
    loads: DataFrame,
    *,
    max_hot: int = MAX_HOT,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Add ``pos``, the rank of each row in its group by (key, ties), and ``size``.

    Equal to ``row_number()`` and ``count(*)`` over the group, but no task ever
    sorts a whole hot group. ``loads`` has (groups.., load) with the row count
    of each group. A group holding over 1/``max_hot`` of all rows is cut into
    slices along its hashed key; slices are ranked apart and shifted by the rows
    in lower slices. Fewer than ``max_hot`` groups can be that large and they
    have at most twice as many slices, which bounds both broadcasts.
    """
    total = loads.agg(F.coalesce(F.sum("load"), F.lit(0)).alias("total"))
    limit = F.greatest(F.lit(float(min_hot_rows)), total.scalar() / F.lit(float(max_hot)))
    hot = loads.select(
        *[F.col(g).alias(f"_hot_{g}") for g in groups],
        F.ceil(F.col("load") / limit).alias("_slices"),
    ).where("_slices > 1")

    slice_no = F.floor(key_position(F.col(key)) * F.col("_slices"))
    sliced = (
        rows.join(F.broadcast(hot), _same(groups), "left")
        .withColumn("_slice", F.when(F.col("_slices").isNotNull(), slice_no).otherwise(0))
        .drop(*[f"_hot_{g}" for g in groups])
    )

    slice_rows = (
        sliced.where("_slices is not null")
        .groupBy(*groups, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    whole = Window.partitionBy(*groups)
    lower = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = slice_rows.select(
        *[F.col(g).alias(f"_hot_{g}") for g in groups],
        F.col("_slice").alias("_hot_slice"),
        F.coalesce(F.sum("_rows").over(lower), F.lit(0)).alias("_shift"),
        F.sum("_rows").over(whole).alias("_total"),
    )

    part = Window.partitionBy(*groups, "_slice")
    ranked = sliced.withColumn("_pos", F.row_number().over(part.orderBy(key, *ties))).withColumn(
        "_size", F.count(F.lit(1)).over(part)
    )
    on_slice = _same(groups) & (F.col("_slice") == F.col("_hot_slice"))
    return ranked.join(F.broadcast(shifts), on_slice, "left").select(
        *rows.columns,
        (F.col("_pos") + F.coalesce("_shift", F.lit(0))).alias("pos"),
        F.coalesce("_total", "_size").alias("size"),
    )


def _same(groups: Sequence[str]) -> Column:
    """Null-safe, so that the rows without a user form a group like any other."""
    return reduce(
        lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_hot_{g}")) for g in groups]
    )


def ntile_of(pos: Column, size: Column, tiles: int) -> Column:
    """The bucket ``ntile(tiles)`` gives row ``pos`` of ``size`` rows."""
    small = F.floor(size / F.lit(tiles))  # rows in the later, shorter buckets
    longer = size % F.lit(tiles)  # buckets with one row more
    border = longer * (small + 1)
    return F.when(pos <= border, F.ceil(pos / (small + 1))).otherwise(
        longer + F.ceil((pos - border) / F.greatest(small, F.lit(1)))
    )


def assign_folds(
    counts: DataFrame,
    activity: DataFrame,
    params: SplitParams = SplitParams(),
    by: Sequence[str] = (),
    **skew: int,
) -> DataFrame:
    """Add ``fold`` (1..folds, even per user, random by hash) and ``size`` (pairs per user).

    ``activity`` is :func:`user_activity` of the same counts. A user with fewer
    pairs than folds has no row in the last folds.
    """
    require_columns(counts, [*by, "user_id", "item_id", "n"], "assign_folds")
    keyed = counts.withColumn("_key", hash_key(params.seed, "user_id", "item_id"))
    loads = activity.select(*by, "user_id", F.col("pairs").alias("load"))
    # the most selective column first: sorting compares it before anything else
    ranked = hashed_rank(keyed, ["user_id", *by], "_key", ["item_id"], loads, **skew)
    return ranked.withColumn("fold", ntile_of(F.col("pos"), F.col("size"), params.folds)).drop(
        "_key", "pos"
    )


def split_counts(
    counts: DataFrame, activity: DataFrame, params: SplitParams = SplitParams(), **skew: int
) -> DataFrame:
    """(split, user_id, item_id, n) from counts tagged ``kind`` = train or test.

    Users below the activity percentile of their own kind are dropped. The last
    fold of a training user is its validation split; test rows have no folds.
    """
    # two rows: one per kind
    limits = F.broadcast(activity_threshold(activity, params.percentile_cut, ["kind"]))
    active = activity.join(limits, "kind").where(F.col("pairs") >= F.col("threshold"))
    active = active.select("kind", "user_id", "pairs")
    known = active.select(F.col("kind").alias("_kind"), F.col("user_id").alias("_user"))
    # a user without id is a user like any other here
    same = (F.col("kind") == F.col("_kind")) & F.col("user_id").eqNullSafe(F.col("_user"))
    kept = counts.join(known, same, "left_semi")
    train = assign_folds(
        kept.where("kind <> 'test'"), active.where("kind <> 'test'"), params, by=["kind"], **skew
    )
    split = F.when(F.col("fold") < params.folds, "train").otherwise("val")
    return train.select(split.alias("split"), "user_id", "item_id", "n").unionByName(
        kept.where("kind = 'test'").select(F.lit("test").alias("split"), "user_id", "item_id", "n")
    )


def uncovered_users(activity: DataFrame, params: SplitParams = SplitParams()) -> DataFrame:
    """Users too small to have a validation row, from :func:`user_activity` alone."""
    return activity.where(F.col("pairs") < params.folds).select(
        "user_id", F.col("pairs").alias("size")
    )
