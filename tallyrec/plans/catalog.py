"""Every operator as a named query over the given tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyrec.config import AlsGrid, AlsParams, ForestParams, SearchParams, SplitParams, VoteParams
from tallyrec.functions.keys import normalised_key
from tallyrec.functions.lists import as_doubles, from_array, head_of, to_arrays
from tallyrec.operators import ids
from tallyrec.operators.factors import (
    AlsFit,
    als_input,
    fit_als,
    item_factors,
    recommend,
    recommend_builtin,
    staged_factors,
    user_factors,
)
from tallyrec.operators.forest import forest_topk, grow_forest, plant
from tallyrec.operators.interactions import (
    active_users,
    activity_profile,
    activity_threshold,
    count_interactions,
    table_shapes,
    user_activity,
)
from tallyrec.operators.linked import linked_items
from tallyrec.operators.metrics import evaluate
from tallyrec.operators.popularity import (
    active_items,
    damped_vote_lists,
    name_items,
    item_popularity,
    popularity_list,
    rank_items,
    unseen_lists,
)
from tallyrec.operators.pruned import norm_blocks, pruned_topk
from tallyrec.operators.ranking import ground_truth
from tallyrec.operators.search import (
    exact_topk,
    hash_vectors,
    lsh_topk,
    number_part,
    recall_of,
    scored_share,
    search_buckets,
)
from tallyrec.operators.split import assign_folds, uncovered_users
from tallyrec.plans.latent import als_grid, als_metrics, als_size_sweep, lsh_map
from tallyrec.plans.prepare import Counted, count_log, prepare_splits, split_truth
from tallyrec.plans.sweep import beta_sweep, best_of, seed_sweep, size_sweep, spread
from tallyrec.schemas import LISTS
from tallyrec.sources import fixtures
from tallyrec.sources.stage import fresh_path, materialise, passing_work
from tallyrec.sources.tables import read_artifact, read_csv, tag, write_artifact, write_csv

Query = Callable[[SparkSession, str], DataFrame]

STABILITY_SEEDS = (10, 11, 12)
UNSEEN_LIST = 20
FRACTIONS = (0.1, 0.25, 0.5, 1.0)
EVENTS_LIST = 10  # the events log has only 100 items
BETAS = VoteParams().betas
#: Published settings of the forest: ten and twenty trees, 100 and 500 items looked at per tree.
FORESTS = tuple(ForestParams(t, 100 * t * m) for t in (10, 20) for m in (1, 5))
PRUNED_BLOCK = 64
#: List rows that are searched, stored and compared at a time: about 70 bytes of disk each.
SLICE_ROWS = 1 << 24
SEARCHES = (
    SearchParams(tables=10, hashes=4, width=0.5),
    SearchParams(tables=20, hashes=4, width=0.5),
    SearchParams(tables=10, hashes=3, width=0.5),
    SearchParams(tables=20, hashes=3, width=0.5),
)

_QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles at nine digits, so that another engine's summation order cannot show."""
    return df.withColumns({c: F.round(c, 9) for c, t in df.dtypes if t == "double"})


def _longs(df: DataFrame) -> DataFrame:
    """Integers as bigint, the type a SQL engine counts in."""
    return df.withColumns({c: F.col(c).cast("bigint") for c, t in df.dtypes if t == "int"})


def _out(df: DataFrame) -> DataFrame:
    return _longs(_rounded(df))


def _only(counted: Counted, kind: str) -> Counted:
    return Counted(
        *[t.where(F.col("kind") == kind).drop("kind") for t in (counted.counts, counted.activity)]
    )


def _train(splits: DataFrame) -> DataFrame:
    return splits.where("split = 'train'").drop("split")


# --- counting, profiles, splits -------------------------------------------------


@_query
def interaction_counts(spark, sf_dir):
    return count_interactions(fixtures.events_interactions(spark, sf_dir), ["kind"])


@_query
def interaction_counts_orders(spark, sf_dir):
    return count_interactions(fixtures.orders_interactions(spark, sf_dir), ["kind"])


def _activity(log: DataFrame) -> DataFrame:
    return user_activity(count_interactions(log, ["kind"]), ["kind"])


@_query
def activity_profile_events(spark, sf_dir):
    activity = _activity(fixtures.events_interactions(spark, sf_dir))
    return _out(activity_profile(activity, ["kind"]))


@_query
def activity_profile_orders(spark, sf_dir):
    activity = _activity(fixtures.orders_interactions(spark, sf_dir))
    return _out(activity_profile(activity, ["kind"]))


@_query
def activity_thresholds(spark, sf_dir):
    """The cuts of the popularity run (0.05) and of the latent-factor run (0.2)."""
    activity = _activity(fixtures.orders_interactions(spark, sf_dir))
    cuts = [
        activity_threshold(activity, p, ["kind"]).withColumn("fraction", F.lit(p))
        for p in (0.05, 0.2)
    ]
    return _out(ids.union_all(cuts))


@_query
def active_user_pairs(spark, sf_dir):
    activity = materialise(_activity(fixtures.orders_interactions(spark, sf_dir)), "activity")
    return active_users(activity, 0.2, ["kind"])


@_query
def split_assignments(spark, sf_dir):
    counted = count_log(fixtures.events_interactions(spark, sf_dir))
    return assign_folds(counted.counts, counted.activity, by=["kind"])


@_query
def split_assignments_orders(spark, sf_dir):
    counted = count_log(fixtures.orders_interactions(spark, sf_dir))
    return assign_folds(counted.counts, counted.activity, by=["kind"])


@_query
def split_sizes(spark, sf_dir):
    return _longs(table_shapes(prepare_splits(fixtures.orders_interactions(spark, sf_dir)), ["split"]))


@_query
def split_sizes_latent(spark, sf_dir):
    """The latent-factor run's harder activity cut, on the events log."""
    log = fixtures.events_interactions(spark, sf_dir)
    return _longs(table_shapes(prepare_splits(log, SplitParams(percentile_cut=0.2)), ["split"]))


@_query
def users_without_validation(spark, sf_dir):
    counted = _only(count_log(fixtures.orders_interactions(spark, sf_dir)), "train")
    return uncovered_users(counted.activity)


# --- ground truth ---------------------------------------------------------------


@_query
def ground_truth_long(spark, sf_dir):
    return _out(split_truth(prepare_splits(fixtures.events_interactions(spark, sf_dir))))


@_query
def ground_truth_lists(spark, sf_dir):
    """Lists of at most five items, as text; the arrays are cut from longer ones."""
    truth = split_truth(prepare_splits(fixtures.events_interactions(spark, sf_dir)))
    lists = to_arrays(truth, ["split", "user_id"], ["item_id"])
    return lists.select(
        "split", "user_id", F.array_join(head_of("item_id", 5), ",").alias("gt"),
        F.size("item_id").cast("bigint").alias("n_items"),
    )


@_query
def ground_truth_flattened(spark, sf_dir):
    """Arrays back to long form: the ranks survive the round trip."""
    truth = split_truth(prepare_splits(fixtures.orders_interactions(spark, sf_dir)))
    lists = to_arrays(truth, ["split", "user_id"], ["item_id"])
    doubles = lists.withColumn("item", as_doubles("item_id"))
    return _longs(from_array(doubles, ["split", "user_id"], "item", "item"))


# --- popularity and damped votes ------------------------------------------------


@_query
def popularity_top100(spark, sf_dir):
    return _out(popularity_list(_train(prepare_splits(fixtures.orders_interactions(spark, sf_dir)))))


@_query
def popularity_report(spark, sf_dir):
    """The hundred most widely bought items of the whole log, with their names."""
    counts = count_interactions(fixtures.orders_interactions(spark, sf_dir))
    tracks = fixtures.tracks(spark, sf_dir)
    return _out(name_items(popularity_list(counts), tracks))


@_query
def popularity_as_arrays(spark, sf_dir):
    best = popularity_list(_train(prepare_splits(fixtures.events_interactions(spark, sf_dir))))
    row = to_arrays(best.withColumn("model", F.lit("popularity")), ["model"], ["item_id", "score"])
    scores = F.transform("score", lambda s: s.cast("bigint"))
    return row.select(
        "model", F.array_join("item_id", ",").alias("pred"), F.array_join(scores, ",").alias("scores")
    )


@_query
def active_item_counts(spark, sf_dir):
    splits = prepare_splits(fixtures.orders_interactions(spark, sf_dir))
    return active_items(_train(splits), VoteParams().item_percentile)


@_query
def damped_vote_top100(spark, sf_dir):
    splits = prepare_splits(fixtures.orders_interactions(spark, sf_dir))
    return _out(damped_vote_lists(_train(splits), [50]))


@_query
def damped_vote_grid(spark, sf_dir):
    splits = prepare_splits(fixtures.events_interactions(spark, sf_dir))
    return _out(damped_vote_lists(_train(splits), BETAS))


# --- metrics and sweeps ---------------------------------------------------------


def _popularity_metrics(log: DataFrame, ks: Sequence[int], k: int) -> DataFrame:
    splits = prepare_splits(log)
    return evaluate(split_truth(splits), popularity_list(_train(splits), k), ks=ks, list_size=k)


@_query
def map_popularity(spark, sf_dir):
    log = fixtures.orders_interactions(spark, sf_dir)
    return _out(_popularity_metrics(log, (), 100).select("split", "users", "map"))


@_query
def map_hit_norm(spark, sf_dir):
    log = fixtures.events_interactions(spark, sf_dir)
    metrics = _popularity_metrics(log, (), EVENTS_LIST)
    return _out(metrics.select("split", "users", "map", "map_hit_norm"))


@_query
def map_popularity_unseen(spark, sf_dir):
    """Popularity without the items a user already has in training."""
    splits = prepare_splits(fixtures.orders_interactions(spark, sf_dir))
    train = _train(splits)
    lists = unseen_lists(rank_items(item_popularity(train), "users"), train, UNSEEN_LIST)
    metrics = evaluate(split_truth(splits), lists, ks=(10,), list_size=UNSEEN_LIST)
    return _out(metrics)


@_query
def map_popularity_unseen_100(spark, sf_dir):
    """The same with lists of the published size."""
    size = SplitParams().list_size
    splits = prepare_splits(fixtures.orders_interactions(spark, sf_dir))
    train = _train(splits)
    lists = unseen_lists(rank_items(item_popularity(train), "users"), train, size)
    return _out(evaluate(split_truth(splits), lists, ks=(10,), list_size=size))


@_query
def unseen_list_sizes(spark, sf_dir):
    """Every user's popularity list of unseen items is whole: k items, or all there are."""
    train = _train(prepare_splits(fixtures.orders_interactions(spark, sf_dir)))
    lists = unseen_lists(rank_items(item_popularity(train), "users"), train, UNSEEN_LIST)
    return _longs(lists.groupBy("user_id").agg(F.count(F.lit(1)).alias("items"), F.sum("item_id").alias("total")))


@_query
def ranking_metrics_at_k(spark, sf_dir):
    log = fixtures.orders_interactions(spark, sf_dir)
    return _out(_popularity_metrics(log, (10, 100), 100))


@_query
def ranking_metrics_at_k_events(spark, sf_dir):
    log = fixtures.events_interactions(spark, sf_dir)
    return _out(_popularity_metrics(log, (1, 5, 10), EVENTS_LIST))


@_query
def beta_sweep_orders(spark, sf_dir):
    splits = prepare_splits(fixtures.orders_interactions(spark, sf_dir))
    return _out(beta_sweep(splits).select("split", "beta", "users", "map"))


@_query
def beta_sweep_events(spark, sf_dir):
    splits = prepare_splits(fixtures.events_interactions(spark, sf_dir))
    return _out(beta_sweep(splits, list_size=EVENTS_LIST).select("split", "beta", "users", "map"))


@_query
def beta_best(spark, sf_dir):
    splits = prepare_splits(fixtures.events_interactions(spark, sf_dir))
    return _out(best_of(beta_sweep(splits, list_size=EVENTS_LIST), "beta"))


def _seed_runs(spark, sf_dir) -> DataFrame:
    counted = _only(count_log(fixtures.events_interactions(spark, sf_dir)), "train")
    return seed_sweep(counted.counts, counted.activity, STABILITY_SEEDS, list_size=EVENTS_LIST)


@_query
def split_seed_runs(spark, sf_dir):
    return _out(_seed_runs(spark, sf_dir))


@_query
def split_stability(spark, sf_dir):
    return _out(spread(_seed_runs(spark, sf_dir)))


@_query
def size_sweep_popularity(spark, sf_dir):
    splits = prepare_splits(fixtures.orders_interactions(spark, sf_dir))
    return _out(size_sweep(splits, FRACTIONS))


# --- ids ------------------------------------------------------------------------


def _keyed_log(spark, sf_dir) -> DataFrame:
    return fixtures.orders_interactions(spark, sf_dir).select(
        "kind", "ts", "user_id",
        F.concat(F.lit("m-"), F.col("item_id").cast("string")).alias("recording_msid"),
    )


def _id_sources(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Tagged users and tagged tracks of three overlapping splits."""
    small = F.col("ts") < F.lit(fixtures.ORDERS_SMALL_CUT).cast("timestamp_ntz")
    keys = _keyed_log(spark, sf_dir).select(
        "user_id", "recording_msid", "kind", small.alias("small")
    )
    seen = materialise(keys.distinct(), "seen")
    tracks = fixtures.tracks(spark, sf_dir)
    parts = [
        (seen.where("kind = 'train'"), "train"),
        (seen.where("small"), "train"),
        (seen.where("kind = 'test'"), "test"),
    ]
    users = [tag(p.select("user_id").distinct(), kind) for p, kind in parts]
    known = [
        tag(
            tracks.join(p.select("recording_msid").distinct(), "recording_msid", "left_semi"),
            kind,
            ["recording_msid", "recording_mbid"],
        )
        for p, kind in parts
    ]
    return ids.union_all(users), ids.union_all(known)


@_query
def user_ids(spark, sf_dir):
    return ids.user_ids(_id_sources(spark, sf_dir)[0])


@_query
def item_ids(spark, sf_dir):
    return ids.item_ids(_id_sources(spark, sf_dir)[1])


def _maps(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    users, tracks = _id_sources(spark, sf_dir)
    return materialise(ids.item_ids(tracks), "items"), materialise(ids.user_ids(users), "users")


@_query
def encoded_interactions(spark, sf_dir):
    # both maps are unique by construction
    return ids.encode(_keyed_log(spark, sf_dir), *_maps(spark, sf_dir), trusted=True)


@_query
def encoded_interaction_counts(spark, sf_dir):
    items, users = _maps(spark, sf_dir)
    return ids.encoded_counts(_keyed_log(spark, sf_dir), items, users, ["kind"], trusted=True)


@_query
def unmatched_interactions(spark, sf_dir):
    """Encoding against the maps of the test split alone leaves rows without an id."""
    users, tracks = _id_sources(spark, sf_dir)
    items = ids.item_ids(tracks.where("type = 'test'"))
    known = ids.user_ids(users.where("type = 'test'"))
    return ids.unmatched(ids.encode(_keyed_log(spark, sf_dir), items, known))


@_query
def id_source_shapes(spark, sf_dir):
    users, tracks = _id_sources(spark, sf_dir)
    sizes = [
        table_shapes(t, ["type"]).withColumn("source", F.lit(name))
        for t, name in ((users, "users"), (tracks, "tracks"))
    ]
    return _longs(ids.union_all(sizes))


@_query
def item_groups(spark, sf_dir):
    groups = ids.item_groups(_id_sources(spark, sf_dir)[1])
    return groups.select(
        "long_id", "chunk",
        F.array_join("members.recording_msid", ",").alias("msids"),
        F.array_join("members.types", ";").alias("types"),
    )


@_query
def ungrouped_items(spark, sf_dir):
    return ids.ungroup_items(ids.item_groups(_id_sources(spark, sf_dir)[1], chunk=2))


@_query
def normalised_item_keys(spark, sf_dir):
    return fixtures.tracks(spark, sf_dir).select(
        "recording_msid", normalised_key("track_name", "artist_name").alias("concat_id")
    )


@_query
def linked_item_ids(spark, sf_dir):
    """Submissions linked by canonical key or by name, through any number of others."""
    return linked_items(fixtures.submissions(spark, sf_dir))


# --- artifacts ------------------------------------------------------------------


@_query
def artifact_round_trip(spark, sf_dir):
    base = fresh_path(spark, "artifacts")
    counts = count_interactions(fixtures.orders_interactions(spark, sf_dir), ["kind"])
    write_artifact(counts, base, "base-counts")
    return read_artifact(spark, base, "base-counts").groupBy("kind").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("n").alias("events")
    )


@_query
def partitioned_truth(spark, sf_dir):
    """Ground truth stored by split, read back for validation users only."""
    base = fresh_path(spark, "artifacts")
    truth = split_truth(prepare_splits(fixtures.events_interactions(spark, sf_dir)))
    write_artifact(truth, base, "base-truth", ["split"])
    return _longs(read_artifact(spark, base, "base-truth").where("split = 'val'"))


@_query
def stored_vote_runs(spark, sf_dir):
    """All vote lists in one table partitioned by beta instead of one name per run."""
    base = fresh_path(spark, "artifacts")
    splits = prepare_splits(fixtures.orders_interactions(spark, sf_dir))
    write_artifact(damped_vote_lists(_train(splits), BETAS), base, "pred-vote", ["beta"])
    stored = read_artifact(spark, base, "pred-vote").where(F.col("beta").isin(10, 100))
    return _out(stored)


@_query
def csv_round_trip(spark, sf_dir):
    path = fresh_path(spark, "artifacts") + "/recommendations.csv"
    counts = count_interactions(fixtures.orders_interactions(spark, sf_dir))
    truth = ground_truth(counts, 100, ["user_id"])
    write_csv(truth.withColumn("score", F.col("n").cast("double")).drop("n"), path)
    return _out(read_csv(spark, path, LISTS))


# --- latent factors and search --------------------------------------------------


@_query
def als_top100(spark, sf_dir):
    splits = prepare_splits(fixtures.orders_interactions(spark, sf_dir))
    return recommend(fit_als(als_input(_train(splits))), 100)


@_query
def als_list_faults(spark, sf_dir):
    """What is wrong with the ALS lists: order, repeats, scores that are not the factors' product."""
    fit = fit_als(als_input(_train(prepare_splits(fixtures.orders_interactions(spark, sf_dir)))))
    lists = materialise(recommend(fit, 100), "als-lists")
    users = user_factors(fit).withColumnRenamed("features", "u")
    items = item_factors(fit).withColumnRenamed("features", "v")
    return _longs(_list_faults(lists, users, items))


def _list_faults(lists: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """users, rows, repeats, order_faults and score_faults of ``lists``; vectors ``u`` by user_id, ``v`` by item_id."""
    # number by number, which is compiled; a lambda is not
    dims = max(side.agg(F.max(F.size(v))).first()[0] or 0 for side, v in ((users, "u"), (items, "v")))
    product = sum((F.get("u", F.lit(j)).cast("double") * F.get("v", F.lit(j)) for j in range(dims)), F.lit(0.0))
    before = F.lag("score").over(Window.partitionBy("user_id").orderBy("rank"))
    # few items may be listed by many: these are small and stored, so that Spark can tell; users come last, as
    # the rest is by user too
    listed = materialise(items.join(lists.select("item_id").distinct(), "item_id", "left_semi"), "listed-vectors")
    seen = lists.join(listed, "item_id").join(users, "user_id")
    # the vectors end here, multiplied once: what is sorted by user are numbers
    seen = seen.select("user_id", "rank", "item_id", "score", product.alias("_product"))
    off = F.abs(F.col("score") - F.col("_product")) > 1e-6 * F.abs("_product") + 1e-12
    seen = seen.select("user_id", "rank", "item_id", "score", off.alias("_off")).withColumn("_before", before)
    per_user = seen.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("item_id").alias("different"),
        F.count_if(F.col("score") > F.col("_before")).alias("order_faults"),
        F.count_if("_off").alias("score_faults"),
    )
    return per_user.agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("rows").alias("rows"),
        F.sum(F.col("rows") - F.col("different")).alias("repeats"),
        F.sum("order_faults").alias("order_faults"),
        F.sum("score_faults").alias("score_faults"),
    )


@_query
def als_fit_faults(spark, sf_dir):
    """Users whose factor does not solve its own equation, given the items' factors (rank 1)."""
    params = AlsParams()
    fit = fit_als(als_input(_train(prepare_splits(fixtures.orders_interactions(spark, sf_dir)))), params)
    items = fit.model.itemFactors.select(F.col("id").alias("item_index"), F.col("features")[0].cast("double").alias("v"))
    users = fit.model.userFactors.select(F.col("id").alias("user_index"), F.col("features")[0].cast("double").alias("u"))
    items, users = materialise(items, "als-items"), materialise(users, "als-users")
    squares = items.agg(F.sum(F.col("v") * F.col("v"))).scalar()
    sure = F.col("score").cast("double") * params.alpha
    terms = fit.source.ratings.join(items, "item_index").groupBy("user_index").agg(
        F.sum((1 + sure) * F.col("v")).alias("right"),
        F.sum(sure * F.col("v") * F.col("v")).alias("left"),
        F.count(F.lit(1)).alias("n"),
    )
    solved = F.greatest(F.lit(0.0), F.col("right") / (squares + F.col("left") + params.reg * F.col("n")))
    off = F.abs(F.col("u") - solved) > 1e-3 * F.greatest(solved, F.lit(1e-3))
    checked = users.join(terms, "user_index", "full")
    return _longs(
        checked.agg(
            F.count(F.lit(1)).alias("users"),
            F.count_if(F.coalesce(off, F.lit(True))).alias("off"),
        )
    )


@_query
def als_top100_builtin(spark, sf_dir):
    """The built-in recommender; as lists of item ids in rank order."""
    splits = prepare_splits(fixtures.events_interactions(spark, sf_dir))
    lists = recommend_builtin(fit_als(als_input(_train(splits))), 100)
    return to_arrays(lists, ["user_id"], ["item_id"])


@_query
def als_unseen(spark, sf_dir):
    """ALS lists without the items a user already has: per user their size and what they hold."""
    train = _train(prepare_splits(fixtures.orders_interactions(spark, sf_dir)))
    lists = recommend(fit_als(als_input(train)), UNSEEN_LIST, unseen=True)
    had = train.select("user_id", "item_id", F.lit(1).alias("had"))
    sizes = lists.join(had, ["user_id", "item_id"], "left").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("items"), F.count("had").alias("seen_items"),
        F.max("rank").alias("last_rank"), F.count_distinct("item_id").alias("different"),
    )
    return _longs(sizes)


@_query
def als_unseen_100(spark, sf_dir):
    """The same with lists of the published size, and whether a left-out item scores above the last kept."""
    train = _train(prepare_splits(fixtures.orders_interactions(spark, sf_dir)))
    fit = fit_als(als_input(train))
    lists = materialise(recommend(fit, SplitParams().list_size, unseen=True), "als-lists")
    had = train.select("user_id", "item_id", F.lit(1).alias("had"))
    sizes = lists.join(had, ["user_id", "item_id"], "left").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("items"), F.count("had").alias("seen_items"),
        F.max("rank").alias("last_rank"), F.count_distinct("item_id").alias("different"),
    )
    return _longs(sizes.join(_better_left_out(fit, lists), "user_id"))


def _better_left_out(fit: AlsFit, lists: DataFrame) -> DataFrame:
    """(user_id, better_left_out): 1 if an item neither had nor listed beats the user's last listed one."""
    listed = lists.join(fit.source.user_map, "user_id").join(fit.source.item_map, "item_id")
    listed = listed.select("user_index", "item_index", F.col("score").cast("float").alias("score"))
    rest = replace(fit, source=replace(fit.source, ratings=fit.source.ratings.unionByName(listed)))
    best = recommend(rest, 1, unseen=True).select("user_id", F.col("score").alias("best"))
    last = lists.groupBy("user_id").agg(F.min("score").alias("last"))
    better = F.coalesce(F.col("best") > F.col("last"), F.lit(False)).cast("bigint")
    return last.join(best, "user_id", "left").select("user_id", better.alias("better_left_out"))


@_query
def als_factors(spark, sf_dir):
    splits = prepare_splits(fixtures.events_interactions(spark, sf_dir))
    fit = fit_als(als_input(_train(splits)), AlsParams(rank=8, reg=0.1, max_iter=3))
    sides = [
        user_factors(fit).select(F.lit("user").alias("side"), F.col("user_id").alias("key"), "features"),
        item_factors(fit).select(F.lit("item").alias("side"), F.col("item_id").alias("key"), "features"),
    ]
    return materialise(ids.union_all(sides), "factors")


@_query
def als_scores(spark, sf_dir):
    splits = prepare_splits(fixtures.events_interactions(spark, sf_dir), SplitParams(percentile_cut=0.2))
    return als_metrics(splits, ks=(5, 10), list_size=EVENTS_LIST)


@_query
def als_grid_scores(spark, sf_dir):
    splits = prepare_splits(fixtures.events_interactions(spark, sf_dir), SplitParams(percentile_cut=0.2))
    grid = AlsGrid(ranks=(1, 4), regs=(0.1, 2.0), alphas=(5.0,))
    return als_grid(splits, grid, list_size=EVENTS_LIST)


@_query
def als_size_runs(spark, sf_dir):
    splits = prepare_splits(fixtures.events_interactions(spark, sf_dir))
    return als_size_sweep(splits, FRACTIONS, list_size=EVENTS_LIST)


def _vectors(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Every embedding both as a query and as an item."""
    vectors = fixtures.table(spark, sf_dir, "embeddings")
    return (
        vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("features")),
        vectors.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("features")),
    )


@_query
def exact_topk_search(spark, sf_dir):
    # scores carry forty bits, so fewer digits than elsewhere are beyond doubt
    found = exact_topk(*_vectors(spark, sf_dir), 10)
    return _longs(found.withColumn("score", F.round("score", 6)))


@_query
def lsh_topk_search(spark, sf_dir):
    return lsh_topk(*_vectors(spark, sf_dir), 10, SEARCHES[0])


@_query
def lsh_recall(spark, sf_dir):
    """Recall of the true ten best against the share of pairs scored, per setting."""
    queries, items = _vectors(spark, sf_dir)
    exact = materialise(exact_topk(queries, items, 10), "exact")
    n_queries, n_items = queries.count(), items.count()
    rows = []
    for s in SEARCHES:
        hashed = hash_vectors(queries, items, s)
        share = scored_share(*hashed, n_queries, n_items)
        rows.append(
            recall_of(exact, search_buckets(*hashed, 10)).select(
                F.lit(s.tables).alias("tables"), F.lit(s.hashes).alias("hashes"),
                F.lit(s.width).alias("width"), "recall", share.scalar().alias("scored_share"),
            )
        )
    return ids.union_all(rows)


@_query
def lsh_map_scores(spark, sf_dir):
    """Accuracy of hashed search over fitted factors, on train, val and test."""
    splits = prepare_splits(fixtures.events_interactions(spark, sf_dir))
    return lsh_map(splits, AlsParams(rank=8, reg=0.1, max_iter=3), SEARCHES, EVENTS_LIST)


@_query
def pruned_topk_search(spark, sf_dir):
    """The rows of the exact search, from items in blocks of falling norm."""
    found = pruned_topk(*_vectors(spark, sf_dir), 10, block_items=PRUNED_BLOCK).lists
    return _longs(found.withColumn("score", F.round("score", 6)))


def _orders_factors(spark, sf_dir, rank: int) -> tuple[DataFrame, DataFrame]:
    splits = prepare_splits(fixtures.orders_interactions(spark, sf_dir))
    return staged_factors(fit_als(als_input(_train(splits)), AlsParams(rank=rank, reg=0.1, max_iter=3)))


@_query
def als_pruned_search(spark, sf_dir):
    """The best half percent of the items by bound-pruned search over fitted factors, against the exact
    search: rows that differ, and whether half of the pairs was saved."""
    rows = []
    for rank in (1, 4):
        users, items = _orders_factors(spark, sf_dir, rank)
        n_items = items.count()
        found = _pruned_against_exact(users, items, max(1, n_items // 200), max(1, n_items // PRUNED_BLOCK))
        rows.append((rank, *found))
    kind = "factors bigint, users bigint, rows bigint, different_rows bigint, half_saved boolean, half_skipped boolean"
    return spark.createDataFrame(rows, kind)


def _pruned_against_exact(
    users: DataFrame, items: DataFrame, k: int, block_items: int, slice_rows: int = SLICE_ROWS
) -> tuple[int, int, int, bool, bool]:
    """users, rows, different_rows, half_saved and half_skipped of :func:`als_pruned_search`, all users in slices.

    Lists are as many rows as users times ``k``, which grows with users x items. Slices of users (by a hash of their id)
    are searched and compared in turn, and what a slice has stored and shuffled is removed before the next.
    """
    spark = users.sparkSession
    parts = max(1, math.ceil(users.count() * k / slice_rows))
    placed = norm_blocks(items, block_items)
    sums = [0] * 7
    for part in range(parts):
        with passing_work(spark):
            some = users.where(number_part("query_id", F.lit(parts)) == part)
            exact = materialise(exact_topk(some, items, k), "exact")
            pruned = pruned_topk(some, items, k, block_items=block_items, placed=placed)
            sizes = exact.agg(F.count_distinct("query_id").alias("users"), F.count(F.lit(1)).alias("rows")).first()
            found = (
                sizes["users"], sizes["rows"], _different_rows(exact, pruned.lists),
                pruned.scored_pairs, pruned.all_pairs, pruned.met_blocks, pruned.all_blocks,
            )
        sums = [s + n for s, n in zip(sums, found)]
    n_users, rows, off, scored, pairs, met, blocks = sums
    return n_users, rows, off, 2 * scored <= pairs, 2 * met <= blocks


def _different_rows(some: DataFrame, other: DataFrame) -> int:
    """Rows that one of two tables has more often, as many times as it does: both differences in one shuffle."""
    both = some.withColumn("_n", F.lit(1)).unionByName(other.withColumn("_n", F.lit(-1)))
    per_row = both.groupBy(*some.columns).agg(F.abs(F.sum("_n")).alias("_n"))
    return per_row.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]


@_query
def als_forest_faults(spark, sf_dir):
    """Faults of lists found by forests over fitted factors, and whether a quarter of all pairs gives a recall of 0.9."""
    users, items = _orders_factors(spark, sf_dir, 4)
    n_users, n_items = users.count(), items.count()
    k = max(1, n_items // 200)
    exact = materialise(exact_topk(users, items, k), "exact")
    u = users.select(F.col("query_id").alias("user_id"), F.col("features").alias("u"))
    v = items.withColumnRenamed("features", "v")
    rows = []
    for trees in (4, 10):
        params = ForestParams(trees, max(trees, n_items // 4), leaf_items=8)
        forest = grow_forest(items, params)
        lists = materialise(forest_topk(users, items, k, params, forest=forest), "forest-lists")
        share = scored_share(*plant(users, items, params, forest, counted=True), n_users, n_items).scalar()
        rows.append(
            _list_faults(lists.withColumnRenamed("query_id", "user_id"), u, v).select(
                F.lit(trees).alias("trees"), "users", "repeats", "order_faults", "score_faults",
                (recall_of(exact, lists).scalar() >= 0.9).alias("recall_90"), (share < 0.5).alias("half_saved"),
            )
        )
    return _longs(ids.union_all(rows))


@_query
def als_forest_recall(spark, sf_dir):
    """Recall of the true hundred best against the share of pairs scored, at the published settings."""
    users, items = _orders_factors(spark, sf_dir, 4)
    exact = materialise(exact_topk(users, items, 100), "exact")
    n_users, n_items = users.count(), items.count()
    rows = []
    for params in FORESTS:
        forest = grow_forest(items, params)
        rows.append(
            recall_of(exact, forest_topk(users, items, 100, params, forest=forest)).select(
                F.lit(params.trees).alias("trees"), F.lit(params.search_items).alias("search_items"), "recall",
                scored_share(*plant(users, items, params, forest, counted=True), n_users, n_items).scalar().alias("scored_share"),
            )
        )
    return ids.union_all(rows)


@_query
def als_forest_map_scores(spark, sf_dir):
    """Accuracy of forest search over fitted factors, on train, val and test, at the published settings."""
    splits = prepare_splits(fixtures.events_interactions(spark, sf_dir))
    return lsh_map(splits, AlsParams(rank=8, reg=0.1, max_iter=3), FORESTS, EVENTS_LIST)
