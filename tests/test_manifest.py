"""A run that breaks goes on where it stopped, and leaves nothing but its artifacts."""

import os

import pytest
from pyspark.sql import functions as F

from tallyrec.config import AlsGrid, SplitParams
from tallyrec.plans import runs
from tallyrec.sources.manifest import Run, fingerprint
from tallyrec.sources.stage import materialise, stage_root, temporary_stages
from tallyrec.sources.tables import read_artifact
from tests.test_sources import data  # noqa: F401


@pytest.fixture()
def table(spark, tmp_path):
    def write(rows, name="in"):
        spark.createDataFrame(rows, "a int, b string").write.mode("overwrite").parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    return write


def test_stages_are_built_once(spark, tmp_path, table):
    source, built = table([(1, "x"), (2, "y")]), []

    def build(name, broken=False):
        def make():
            built.append(name)
            if broken:
                raise RuntimeError("lost")
            return source.withColumn("stage", F.lit(name)), {"rows": 2}

        return make

    first = Run(spark, str(tmp_path), "r", [source], 1)
    first.stage("one", build("one"))
    with pytest.raises(RuntimeError):
        first.stage("two", build("two", broken=True))
    again = Run(spark, str(tmp_path), "r", [source], 1)
    assert again.stage("one", build("one")).count() == again.stage("two", build("two")).count() == 2
    assert built == ["one", "two", "two"] and again.written == ["two"]
    assert again.facts("one")["rows"] == 2 and again.facts("one")["seconds"] > 0
    # another parameter or input starts afresh
    Run(spark, str(tmp_path), "r", [source], 2).stage("one", build("one"))
    assert built[3:] == ["one"]
    assert Run(spark, str(tmp_path), "r", [source], 1).facts("one") == {"seconds": None}


def test_fingerprint_follows_the_files(spark, table):
    first = table([(1, "x")])
    before = fingerprint([first], "s")
    assert fingerprint([first], "s") == before != fingerprint([first], "t")
    assert fingerprint([table([(1, "x"), (3, "long text")])], "s") != before


def test_temporary_stages_are_removed(spark):
    root = stage_root(spark)
    before = set(os.listdir(root))
    with pytest.raises(ValueError), temporary_stages(spark):
        materialise(spark.range(3), "gone")
        assert len(set(os.listdir(root)) - before) == 1
        raise ValueError
    assert set(os.listdir(root)) == before


def test_popularity_run_goes_on(spark, data, tmp_path, monkeypatch):  # noqa: F811
    out, root = str(tmp_path), stage_root(spark)
    before, calls = set(os.listdir(root)), []
    split, votes = runs.split_rows, runs.damped_vote_lists
    monkeypatch.setattr(runs, "split_rows", lambda *a: calls.append("split") or split(*a))

    def broken(*a):
        raise RuntimeError("lost")

    monkeypatch.setattr(runs, "damped_vote_lists", broken)
    params = SplitParams(list_size=20)
    with pytest.raises(RuntimeError):
        runs.popularity_run(spark, data, out, split=params)
    monkeypatch.setattr(runs, "damped_vote_lists", lambda *a: calls.append("votes") or votes(*a))
    best = runs.popularity_run(spark, data, out, split=params).collect()
    assert calls == ["split", "votes"] and len(best) == 1
    assert runs.popularity_run(spark, data, out, split=params).collect() == best and len(calls) == 2
    profile = {r["split"]: r for r in read_artifact(spark, out, "base-profile").collect()}
    shapes = {r["split"]: r.n_rows for r in read_artifact(spark, out, "base-shapes").collect()}
    assert set(profile) == set(shapes) == {"train", "val", "test"}
    assert profile["train"].min_items <= profile["train"].q2 <= profile["train"].max_items
    stable = runs.stability_run(spark, data, out, split=params, seeds=(1, 2), fractions=(0.5, 1.0)).collect()
    assert stable[0].runs == 2 and read_artifact(spark, out, "size-metrics").count() == 2
    assert set(os.listdir(root)) == before


def test_latent_run_fits_only_new_models(spark, data, tmp_path, monkeypatch):  # noqa: F811
    out = str(tmp_path)
    runs.ids_run(spark, data, out)
    fitted, plain = [], runs.point_lists
    monkeypatch.setattr(runs, "point_lists", lambda s, p, *a, **k: fitted.append(p.rank) or plain(s, p, *a, **k))
    params = SplitParams(percentile_cut=0.2, list_size=10)
    runs.latent_run(spark, out, out, "train_small", params, AlsGrid(ranks=(1,)))
    scores = runs.latent_run(spark, out, out, "train_small", params, AlsGrid(ranks=(1, 3))).collect()
    assert fitted == [1, 3] and {r.model for r in scores} == {"1-2.0-5.0", "3-2.0-5.0"}
    assert all(r.fit_seconds > 0 and r.predict_seconds > 0 and r.evaluate_seconds > 0 for r in scores)
