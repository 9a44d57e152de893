"""Artifacts on disk, and the batch runs from split files to scores."""

import pytest
from pyspark.sql import functions as F

from tallyrec.config import AlsGrid, SearchParams, SplitParams
from tallyrec.plans.runs import ids_run, latent_run, popularity_run, search_run, sizes_run
from tallyrec.schemas import LISTS, TRACKS
from tallyrec.sources.stage import materialise
from tallyrec.sources.tables import (
    read_artifact,
    read_csv,
    read_split,
    write_artifact,
    write_csv,
)


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """Three splits of string-keyed logs with their dimension tables."""
    base = str(tmp_path_factory.mktemp("data"))
    spans = {"train": (0, 40), "train_small": (0, 20), "test": (10, 30)}
    for name, (lo, hi) in spans.items():
        log = [
            (f"u{u}", f"m{(u * 7 + j * j) % 60}") for u in range(lo, hi) for j in range(5 + u % 20)
        ]
        spark.createDataFrame(log, "user_id string, recording_msid string").write.parquet(
            f"{base}/interactions_{name}.parquet"
        )
        tracks = [
            (f"m{i}", [None, "", f"mb{i // 4}"][i % 3], f"Song {i}", f"Artist {i % 9}")
            for i in range(60)
        ]
        spark.createDataFrame(tracks, TRACKS).write.parquet(f"{base}/tracks_{name}.parquet")
        spark.createDataFrame([(f"u{u}",) for u in range(lo, hi)], "user_id string").write.parquet(
            f"{base}/users_{name}.parquet"
        )
    return base


def test_read_split(spark, data):
    log, tracks, users = read_split(spark, data, "train_small")
    assert users.count() == 20 and tracks.count() == 60
    assert log.columns == ["user_id", "recording_msid"]


def test_artifact_is_overwritten_and_partitioned(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "split string, x int")
    for _ in range(2):
        write_artifact(df, str(tmp_path), "t", ["split"])
    back = read_artifact(spark, str(tmp_path), "t")
    assert back.count() == 2
    pruned = back.where("split = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in pruned


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 1, 10, 0.5), (1, 2, 11, 0.25)]
    write_csv(spark.createDataFrame(rows, LISTS), str(tmp_path / "c"))
    assert sorted(tuple(r) for r in read_csv(spark, str(tmp_path / "c"), LISTS).collect()) == rows


def test_stage_table_keeps_rows_and_schema(spark):
    df = spark.range(10).select(F.col("id"), (F.col("id") % 2).cast("string").alias("half"))
    back = materialise(df, "t", partition_by="half")
    assert back.where("half = '1'").count() == 5
    assert dict(back.dtypes) == dict(df.dtypes)


def test_popularity_run(spark, data, tmp_path):
    out = str(tmp_path)
    best = popularity_run(spark, data, out, split=SplitParams(list_size=20)).collect()
    assert len(best) == 1 and best[0].val_map > 0
    named = read_artifact(spark, out, "pred-named")
    assert named.count() == 20 and "artist_name" in named.columns
    scores = read_artifact(spark, out, "vote-metrics")
    assert scores.count() == 3 * 6
    top = scores.where("split = 'val'").orderBy(F.desc("map"), "beta").first()
    assert top.beta == best[0].beta
    assert read_artifact(spark, out, "base-metrics").count() == 3


def test_ids_then_latent_run(spark, data, tmp_path):
    out = str(tmp_path)
    missing = ids_run(spark, data, out).collect()
    assert {(r.no_item, r.no_user) for r in missing} == {(0, 0)}
    encoded = read_artifact(spark, out, "numbered-train")
    assert encoded.count() == read_split(spark, data, "train")[0].count()
    scores = latent_run(
        spark, out, out, "train_small", SplitParams(percentile_cut=0.2, list_size=10), AlsGrid(ranks=(1, 3))
    ).collect()
    assert {r.model for r in scores} == {"1-2.0-5.0", "3-2.0-5.0"}
    assert {r["split"] for r in scores} == {"train", "val", "test"}

    searches = [SearchParams(tables=4, hashes=1, width=0.5), SearchParams(tables=8, hashes=1, width=2.0)]
    found = search_run(spark, out, out, "3-2.0-5.0", searches, list_size=10).collect()
    assert len(found) == 2 * 3
    recall = {r.search: r.recall for r in found}
    assert 0 < recall["4x1@0.5"] <= recall["8x1@2.0"] <= 1

    sizes = {r.fraction: r for r in sizes_run(spark, out, out, (0.5, 1.0), list_size=10).collect()}
    assert 0 < sizes[0.5].train_rows < sizes[1.0].train_rows
    assert sizes[1.0].fit_seconds > 0
