"""The batch runs from split files to scored models.

    spark-submit launch.py popularity --data DIR --out DIR
    spark-submit launch.py stability  --data DIR --out DIR
    spark-submit launch.py ids        --data DIR --out DIR
    spark-submit launch.py latent     --data DIR --out DIR --ranks 1 4
    spark-submit launch.py search     --data DIR --out DIR --model 4-2.0-5.0
    spark-submit launch.py sizes      --data DIR --out DIR

``--data`` of popularity and ids holds ``interactions_<split>.parquet``,
``tracks_<split>.parquet`` and ``users_<split>.parquet``; latent reads what ids
left, search and sizes read what latent left. Artifacts go to ``--out``; popularity, stability and
latent go on where an earlier attempt with the same inputs and settings broke off.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Sequence
from dataclasses import replace
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrec.config import (
    LATENT_SPLIT,
    AlsGrid,
    AlsParams,
    ForestParams,
    SearchParams,
    SplitParams,
    VoteParams,
)
from tallyrec.operators import ids
from tallyrec.operators.factors import AlsInput, als_input
from tallyrec.operators.interactions import activity_profile, table_shapes, user_activity
from tallyrec.operators.metrics import evaluate
from tallyrec.operators.popularity import damped_vote_lists, name_items, popularity_list
from tallyrec.operators.ranking import ground_truth
from tallyrec.operators.search import recall_of
from tallyrec.plans.latent import (
    Search,
    als_size_sweep,
    label_of,
    point_lists,
    search_label,
    search_scores,
    searched_lists,
)
from tallyrec.plans.prepare import count_log, split_rows
from tallyrec.plans.sweep import best_of, seed_sweep, size_sweep, spread
from tallyrec.session import build_session
from tallyrec.sources.manifest import Run
from tallyrec.sources.stage import materialise, temporary_stages
from tallyrec.sources.tables import read_artifact, read_split, tag, write_artifact


def _log(train: DataFrame, test: DataFrame, item: str) -> DataFrame:
    columns = ["user_id", F.col(item).alias("item_id")]
    return ids.union_all(
        [
            df.select(F.lit(kind).alias("kind"), *columns)
            for df, kind in ((train, "train"), (test, "test"))
        ]
    )


def popularity_run(
    spark: SparkSession,
    data: str,
    out: str,
    train_name: str = "train",
    split: SplitParams = SplitParams(),
    vote: VoteParams = VoteParams(),
    item: str = "recording_msid",
) -> DataFrame:
    """Split, fit both popularity models, score them; returns the best beta's row.

    Leaves base-splits, base-profile, base-shapes, base-truth, pred-baseline, pred-named, pred-vote,
    base-metrics and vote-metrics. A broken run goes on where it stopped.
    """
    train_log, train_tracks, _ = read_split(spark, data, train_name)
    test_log, _, _ = read_split(spark, data, "test")
    k = split.list_size
    run = Run(spark, out, "popularity", [train_log, test_log, train_tracks], split, vote, item)
    with temporary_stages(spark):
        splits = run.stage(
            "base-splits", lambda: split_rows(_log(train_log, test_log, item), split), ["split"]
        )
        train = splits.where("split = 'train'").drop("split")
        run.stage("base-profile", lambda: activity_profile(user_activity(splits, ["split"]), ["split"]))
        run.stage("base-shapes", lambda: table_shapes(splits, ["split"]))
        truth = run.stage("base-truth", lambda: ground_truth(splits, k), ["split"])
        popular = run.stage("pred-baseline", lambda: popularity_list(train, k))
        names = train_tracks.select(F.col(item).alias("item_id"), "track_name", "artist_name")
        run.stage("pred-named", lambda: name_items(popular, names))
        run.stage("base-metrics", lambda: evaluate(truth, popular, ks=(k,), list_size=k))
        voted = run.stage(
            "pred-vote", lambda: damped_vote_lists(train, vote.betas, vote.item_percentile, k), ["beta"]
        )
        scores = run.stage(
            "vote-metrics",
            lambda: evaluate(truth, voted, ks=(), model="beta", values=vote.betas, list_size=k),
        )
    return best_of(scores, "beta")


def stability_run(
    spark: SparkSession,
    data: str,
    out: str,
    train_name: str = "train",
    split: SplitParams = SplitParams(),
    seeds: Sequence[int] = (10, 11, 12),
    fractions: Sequence[float] = (0.1, 0.25, 0.5, 1.0),
    item: str = "recording_msid",
) -> DataFrame:
    """Popularity over several seeds of the split, and over growing shares of the training pairs.

    Leaves seed-metrics and size-metrics (which needs base-splits of the popularity run in ``out``);
    returns mean and deviation over the seeds.
    """
    log, _, _ = read_split(spark, data, train_name)
    splits = read_artifact(spark, out, "base-splits")
    run = Run(spark, out, "stability", [log, splits], split, tuple(seeds), tuple(fractions), item)

    def over_seeds() -> DataFrame:
        counted = count_log(log.select(F.lit("train").alias("kind"), "user_id", F.col(item).alias("item_id")))
        return seed_sweep(
            counted.counts.drop("kind"), counted.activity.drop("kind"), seeds, split, split.list_size
        )

    with temporary_stages(spark):
        scores = run.stage("seed-metrics", over_seeds)
        run.stage("size-metrics", lambda: size_sweep(splits, fractions, split.seed, split.list_size))
    return spread(scores)


def ids_run(
    spark: SparkSession,
    data: str,
    out: str,
    splits: Sequence[tuple[str, str]] = (
        ("train_small", "train"),
        ("train", "train"),
        ("test", "test"),
    ),
) -> DataFrame:
    """Give users and recordings dense ids and encode every split with them.

    Leaves user-numbers, recording-numbers and numbered-<split>;
    returns the rows left without an id, per split.
    """
    inputs = {name: read_split(spark, data, name) for name, _ in splits}
    users = ids.union_all([tag(inputs[n][2], kind, ["user_id"]) for n, kind in splits])
    tracks = ids.union_all(
        [tag(inputs[n][1], kind, ["recording_msid", "recording_mbid"]) for n, kind in splits]
    )
    write_artifact(ids.user_ids(users), out, "user-numbers")
    write_artifact(ids.item_ids(tracks), out, "recording-numbers")
    user_map = read_artifact(spark, out, "user-numbers")
    item_map = read_artifact(spark, out, "recording-numbers")
    missing = []
    for name, _ in splits:
        encoded = ids.encode(inputs[name][0], item_map, user_map, trusted=True)
        write_artifact(encoded, out, f"numbered-{name}")
        stored = read_artifact(spark, out, f"numbered-{name}")
        missing.append(ids.unmatched(stored).withColumn("split", F.lit(name)))
    return ids.union_all(missing)


def latent_run(
    spark: SparkSession,
    data: str,
    out: str,
    train_name: str = "train_small",
    split: SplitParams = LATENT_SPLIT,
    grid: AlsGrid = AlsGrid(),
) -> DataFrame:
    """Fit every grid point on the encoded splits in ``data`` and score its lists.

    Leaves als-splits, als-truth, als-lists, als-user-factors and als-item-factors (one per model each) and
    als-metrics, with the seconds that a model's fit and its lists took. A broken run goes on
    where it stopped, with the first model that has no lists yet.
    """
    train_log, test_log = (
        read_artifact(spark, data, f"numbered-{n}") for n in (train_name, "test")
    )
    # events without an id cannot be recommended or learned from
    log = _log(train_log, test_log, "track_id").where("item_id is not null and user_id is not null")
    k = split.list_size
    points = grid.points()
    run = Run(spark, out, "latent", [train_log, test_log], split)
    with temporary_stages(spark):
        splits = run.stage("als-splits", lambda: split_rows(log, split), ["split"])
        truth = run.stage("als-truth", lambda: ground_truth(splits, k), ["split"])
        source: list[AlsInput] = []  # indexed only if a model is to be fitted

        def lists_of(point: AlsParams) -> tuple[DataFrame, dict]:
            if not source:
                source.append(als_input(splits.where("split = 'train'").drop("split")))
            return point_lists(source[0], point, k, export=out)

        lists, times = [], []
        for p in points:
            fitted = Run(spark, out, "latent", [train_log, test_log], split, p)
            name = f"als-lists-{label_of(p)}"
            lists.append(fitted.stage(name, lambda p=p: lists_of(p)))
            facts = fitted.facts(name)
            times.append((label_of(p), facts["fit_seconds"], facts["seconds"] - facts["fit_seconds"]))
        start = time.monotonic()
        scored = materialise(
            evaluate(
                truth, ids.union_all(lists), ks=(k,), model="model",
                values=[label_of(p) for p in points], population="both", list_size=k,
            ),
            "als-scores",
        )
        seconds = F.lit(time.monotonic() - start).alias("evaluate_seconds")
        known = spark.createDataFrame(times, "model string, fit_seconds double, predict_seconds double")
        # one row per model
        write_artifact(scored.join(F.broadcast(known), "model").select("*", seconds), out, "als-metrics")
    return read_artifact(spark, out, "als-metrics")


def search_run(
    spark: SparkSession,
    data: str,
    out: str,
    model: str,
    searches: Sequence[Search],
    list_size: int = 100,
) -> DataFrame:
    """Approximate search over one model's exported factors, against exact search.

    Leaves lsh-pred (by search), lsh-metrics and lsh-recall; returns
    (search, recall) joined to the metrics of every split.
    """
    users = read_artifact(spark, data, f"als-user-factors-{model}")
    items = read_artifact(spark, data, f"als-item-factors-{model}")
    truth = read_artifact(spark, data, "als-truth")
    exact = read_artifact(spark, data, f"als-lists-{model}")
    exact = exact.where(F.col("rank") <= list_size).withColumnRenamed("user_id", "query_id")

    write_artifact(searched_lists(users, items, searches, list_size), out, "lsh-pred", ["search"])
    found = read_artifact(spark, out, "lsh-pred")
    write_artifact(search_scores(truth, found, searches, list_size), out, "lsh-metrics")
    recalls = [
        recall_of(
            exact,
            found.where(F.col("search") == search_label(s)).withColumnRenamed("user_id", "query_id"),
        ).withColumn("search", F.lit(search_label(s)))
        for s in searches
    ]
    write_artifact(ids.union_all(recalls), out, "lsh-recall")
    # one row per search setting
    recall = F.broadcast(read_artifact(spark, out, "lsh-recall"))
    return read_artifact(spark, out, "lsh-metrics").join(recall, "search")


def sizes_run(
    spark: SparkSession,
    data: str,
    out: str,
    fractions: Sequence[float] = (0.1, 0.25, 0.5, 1.0),
    params: AlsParams = AlsParams(),
    list_size: int = 100,
) -> DataFrame:
    """Accuracy and fit time of ALS against the share of the training pairs."""
    splits = read_artifact(spark, data, "als-splits")
    write_artifact(als_size_sweep(splits, fractions, params, list_size), out, "als-sizes")
    return read_artifact(spark, out, "als-sizes")


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyrec")
    parser.add_argument("run", choices=["popularity", "stability", "ids", "latent", "search", "sizes"])
    parser.add_argument("--data", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--train", help="name of the training split")
    parser.add_argument("--betas", type=int, nargs="+", default=list(VoteParams().betas))
    parser.add_argument("--ranks", type=int, nargs="+", default=list(AlsGrid().ranks))
    parser.add_argument("--regs", type=float, nargs="+", default=list(AlsGrid().regs))
    parser.add_argument("--alphas", type=float, nargs="+", default=list(AlsGrid().alphas))
    parser.add_argument("--model", help="label rank-reg-alpha of the fit to search")
    parser.add_argument("--tables", type=int, nargs="+", default=[10, 20])
    parser.add_argument("--hashes", type=int, nargs="+", default=[2])
    parser.add_argument("--widths", type=float, nargs="+", default=[0.25, 0.5])
    parser.add_argument("--fractions", type=float, nargs="+", default=[0.1, 0.25, 0.5, 1.0])
    parser.add_argument("--trees", type=int, nargs="+", default=[], help="search forests of so many trees")
    parser.add_argument("--search-items", type=int, nargs="+", default=[1000])
    parser.add_argument("--seeds", type=int, nargs="+", default=[10, 11, 12])
    parser.add_argument("--cut", type=float, help="percentile of activity below which users are dropped")
    parser.add_argument("--seed", type=int, help="seed of the split")
    parser.add_argument("--list-size", type=int, help="longest list")
    parser.add_argument("--iterations", type=int, default=AlsGrid().max_iter)
    args = parser.parse_args(argv)
    spark = build_session(f"tallyrec-{args.run}")
    named = {"train_name": args.train} if args.train else {}
    given = {"percentile_cut": args.cut, "seed": args.seed, "list_size": args.list_size}
    split = replace(
        LATENT_SPLIT if args.run == "latent" else SplitParams(),
        **{name: value for name, value in given.items() if value is not None},
    )
    if args.run == "popularity":
        vote = VoteParams(betas=tuple(args.betas))
        result = popularity_run(spark, args.data, args.out, split=split, vote=vote, **named)
    elif args.run == "stability":
        result = stability_run(
            spark, args.data, args.out, split=split, seeds=args.seeds, fractions=args.fractions, **named
        )
    elif args.run == "ids":
        result = ids_run(spark, args.data, args.out)
    elif args.run == "search":
        if args.trees:
            searches = [ForestParams(*s) for s in product(args.trees, args.search_items)]
        else:
            searches = [SearchParams(*s) for s in product(args.tables, args.hashes, args.widths)]
        model = args.model or label_of(AlsParams())
        result = search_run(spark, args.data, args.out, model, searches, split.list_size)
    elif args.run == "sizes":
        result = sizes_run(
            spark, args.data, args.out, args.fractions, AlsParams(max_iter=args.iterations), split.list_size
        )
    else:
        grid = AlsGrid(tuple(args.ranks), tuple(args.regs), tuple(args.alphas), args.iterations)
        result = latent_run(spark, args.data, args.out, split=split, grid=grid, **named)
    result.show(100, truncate=False)


if __name__ == "__main__":
    main()
