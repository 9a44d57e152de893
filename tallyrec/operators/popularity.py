"""Popularity and damped-vote recommenders: one global list for everybody."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrec.operators.interactions import exact_percentile
from tallyrec.operators.ranking import TASK_ROWS, ground_truth, tasks_of, top_per_group
from tallyrec.sources.stage import materialise


def item_popularity(train: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Users who interacted with each item, as ``users`` (not plays)."""
    return train.groupBy(*by, "item_id").agg(F.count(F.lit(1)).alias("users"))


def top_items(scored: DataFrame, score: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    """(by.., rank, item_id, score): the ``k`` best items, overall or per ``by`` group."""
    order = [F.desc(score), F.asc("item_id")]
    if by:
        best = top_per_group(scored, by, order, k)
    else:
        # the window only ever sees the k rows the limit leaves
        numbered = F.row_number().over(Window.orderBy(*order))
        best = scored.orderBy(*order).limit(k).withColumn("rank", numbered)
    return best.select(*by, "rank", "item_id", F.col(score).cast("double").alias("score"))


def popularity_list(train: DataFrame, k: int = 100, by: Sequence[str] = ()) -> DataFrame:
    return top_items(item_popularity(train, by), "users", k, by)


def active_items(train: DataFrame, fraction: float) -> DataFrame:
    """Items at or above the given percentile of item popularity."""
    popularity = item_popularity(train)
    threshold = exact_percentile(popularity, "users", fraction)
    return popularity.where(F.col("users") >= threshold.scalar())


def item_votes(train: DataFrame, item_percentile: float, list_size: int = 100) -> DataFrame:
    """Points and voters per item: each user gives its r-th item list_size+1-r points.

    The active items are staged, so that the join of a hot item's rows with them
    can be split over several tasks.
    """
    active = materialise(active_items(train, item_percentile).select("item_id"), "active-items")
    kept = train.join(active, "item_id", "left_semi")
    ballots = ground_truth(kept, list_size, groups=["user_id"])
    return ballots.groupBy("item_id").agg(
        F.sum(F.lit(list_size + 1) - F.col("rank")).alias("points"),
        F.count(F.lit(1)).alias("voters"),
    )


def damped_scores(votes: DataFrame, betas: Sequence[int]) -> DataFrame:
    """(beta, item_id, score) with score = points / (voters + beta), for every beta."""
    grid = F.explode(F.array(*[F.lit(int(b)) for b in betas])).alias("beta")
    score = F.col("points").cast("double") / (F.col("voters") + F.col("beta"))
    return votes.select("*", grid).select("beta", "item_id", score.alias("score"))


def damped_vote_lists(
    train: DataFrame,
    betas: Sequence[int],
    item_percentile: float = 0.05,
    k: int = 100,
) -> DataFrame:
    """The ``k`` items with the best damped mean vote, one list per beta."""
    scores = damped_scores(item_votes(train, item_percentile, k), betas)
    return top_items(scores, "score", k, by=["beta"])


def name_items(lists: DataFrame, tracks: DataFrame) -> DataFrame:
    """Attach track and artist names to a global list (at most ``k`` rows: broadcast)."""
    return tracks.join(F.broadcast(lists), "item_id").select(
        *lists.columns, "track_name", "artist_name"
    )


def rank_items(scored: DataFrame, score: str, more: Sequence[str] = ()) -> DataFrame:
    """(rank, item_id, score, more..) of all items, best first, ties to the smaller item.

    Range partitions are ranked apart and shifted by the rows before them, one number
    per partition; no task sorts all items.
    """
    order = [F.desc(score), F.asc("item_id")]
    dealt = scored.select("item_id", score, *more).repartitionByRange(*order)
    # stored, so that a row's partition is the same wherever it is read
    dealt = materialise(dealt.withColumn("_part", F.spark_partition_id()), "ranked-items")
    totals = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    lower = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("_part", F.coalesce(F.sum("_rows").over(lower), F.lit(0)).alias("_shift"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        dealt.withColumn("_pos", local)
        .join(F.broadcast(shifts), "_part")
        .select(
            (F.col("_pos") + F.col("_shift")).alias("rank"),
            "item_id",
            F.col(score).cast("double").alias("score"),
            *more,
        )
    )


#: Global ranks of a slice within which one task numbers a user's items, and the ranks every task is told.
SLICE_RANKS = 1 << 18
HEAD_RANKS = 100_000


def unseen_lists(
    ranked: DataFrame,
    train: DataFrame,
    k: int = 100,
    slice_ranks: int = SLICE_RANKS,
    head_ranks: int = HEAD_RANKS,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """(user_id, rank, item_id, score): every user's ``k`` best items not yet had.

    ``ranked`` is :func:`rank_items`. If a user's seen items stand at global ranks
    r1 < r2 < ..., the p-th unseen item stands at p plus the number of j with
    r_j - j < p; so only seen items near the top matter, and the lists are whole
    (k rows, or all unseen items if there are fewer). Seen items with equal r_j - j are a run without
    gaps and one row with their number, so a user has at most k such rows, however many items. They
    are numbered slice by slice of the global ranks, so no task sorts all items of a hot user.
    Users become k rows each in tasks of about ``task_rows`` rows, whatever their number.
    """
    ranks = materialise(ranked.select(F.col("rank").cast("bigint").alias("rank"), "item_id", "score"), "global-ranks")
    users = train.where("user_id is not null").groupBy("user_id").agg(F.count(F.lit(1)).alias("_pairs"))
    users = materialise(users, "train-users")
    # a place of p stands below p and the user's items
    reach = k + (users.agg(F.max("_pairs")).first()[0] or 0)
    skips = _runs_of_seen(ranks, train, users, k, reach, slice_ranks, head_ranks)
    wanted = users.select("user_id").join(skips, "user_id", "left")
    wanted = wanted.repartition(tasks_of(users, users.count() * k, task_rows), "user_id").select(
        "user_id",
        F.coalesce("_skips", F.array().cast("array<struct<unseen_before:bigint,n:bigint>>")).alias("_skips"),
        F.explode(F.sequence(F.lit(1), F.lit(k))).alias("place"),
    )
    before = F.filter("_skips", lambda x: x["unseen_before"] < F.col("place"))
    at = F.col("place") + F.aggregate(before, F.lit(0).cast("bigint"), lambda s, x: s + x["n"])
    wanted = wanted.select("user_id", "place", at.alias("_at"))
    of_rank = ranks.withColumnRenamed("rank", "_at")
    # nearly all places are near the top: told to every task; what is deeper is spread over many ranks
    top, deep = F.col("_at") <= head_ranks, F.col("_at") > head_ranks
    found = wanted.where(top).join(F.broadcast(of_rank.where(top & (F.col("_at") <= reach))), "_at")
    if reach > head_ranks:
        found = found.unionByName(wanted.where(deep).join(of_rank.where(deep), "_at"))
    return found.select("user_id", F.col("place").alias("rank"), "item_id", "score")


def _runs_of_seen(
    ranks: DataFrame, train: DataFrame, users: DataFrame, k: int, reach: int, slice_ranks: int, head_ranks: int
) -> DataFrame:
    """(user_id, _skips): how many seen items have how many unseen ones (fewer than ``k``) before them.

    An item with fewer than ``k`` unseen ones before it has a rank below ``k`` and the user's items. So most users
    are met by the top ranks alone, which every task is told; those with more items are too few to matter there.
    """
    rank_of = ranks.select("item_id", "rank").where(F.col("rank") <= reach)
    seen = train.where("user_id is not null").select("user_id", "item_id")
    found = seen.join(F.broadcast(rank_of.where(F.col("rank") <= head_ranks)), "item_id")
    if reach > head_ranks:
        hot = users.where(F.col("_pairs") + k > head_ranks).select("user_id")
        far = seen.join(F.broadcast(hot), "user_id", "left_semi")
        found = found.unionByName(far.join(rank_of.where(F.col("rank") > head_ranks), "item_id"))
    found = found.select("user_id", "rank", F.floor(F.col("rank") / F.lit(slice_ranks)).alias("_slice"))
    local = Window.partitionBy("user_id", "_slice").orderBy("rank")
    # a pair that repeats is numbered once
    seen = found.withColumn("_pos", F.dense_rank().over(local)).withColumn("_last", F.lag("rank").over(local))
    seen = seen.where("_last is null or _last <> rank").drop("_last")
    seen = materialise(seen, "seen-ranks")
    lower = Window.partitionBy("user_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        seen.groupBy("user_id", "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("user_id", "_slice", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_shift"))
    )
    numbered = seen.join(shifts, ["user_id", "_slice"])
    return (
        numbered.select("user_id", (F.col("rank") - F.col("_pos") - F.col("_shift")).alias("unseen_before"))
        .where(F.col("unseen_before") < k)
        .groupBy("user_id", "unseen_before")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("user_id")
        .agg(F.collect_list(F.struct("unseen_before", "n")).alias("_skips"))
    )
