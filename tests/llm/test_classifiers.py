import zlib

import duckdb
import numpy as np

from tallyrec.llm.language import codewords, fit_languages, held_out, keep_known, predict_languages
from tallyrec.llm.linear import pack_sparse, unpack_sparse
from tallyrec.llm.quality import (
    LABELLERS,
    Shape,
    _pattern_code,
    _unpack_code,
    estimate_accuracies,
    fit_quality,
    keep_good,
    score_quality,
    votes,
)

SF = "/root/testdata/sf0.1"
EDGES = [(-1, None, "en"), (-2, "", "en"), (-3, "123 !?", "fr"), (-4, "The the of and " * 40_000, None), (-5, "the cat", None), (-5, "the cat", None)]


def test_held_out_accuracy_of_languages(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    edges = spark.createDataFrame(EDGES, "doc_id bigint, text string, lang string").repartition(2)
    df = df.select("doc_id", "text", "lang").union(edges).selectExpr("*", "1 as score", "2 as lang_pred", "3 as id")
    model = fit_languages(df, "doc_id", "text", "lang")
    got = predict_languages(df, "doc_id", "text", model).withColumn("held", held_out("doc_id")).collect()
    known = dict(duckdb.sql(f"select doc_id, lang from '{SF}/documents.parquet'").fetchall())
    right = [r["lang_pred"] == known[r["doc_id"]] for r in got if r["held"] and r["doc_id"] >= 0]
    assert np.mean(right) > 0.99
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    edge = {r["doc_id"]: r for r in got if r["doc_id"] < 0}
    assert {edge[i]["lang_pred"] for i in (-1, -2, -3)} == {"und"}
    assert edge[-4]["lang_pred"] == "en" and sum(r["doc_id"] == -5 for r in got) == 2
    kept = keep_known(df, "text", model)
    assert kept.columns == df.columns
    ids = {r[0] for r in kept.select("doc_id").collect()}
    assert not ids & {-1, -2, -3} and len(ids) >= 0.999 * len(known)


def test_languages_without_anything_to_learn(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id bigint, text string, lang string")
    assert fit_languages(df, "doc_id", "text", "lang") is None
    assert [r["lang_pred"] for r in predict_languages(df, "doc_id", "text", None).collect()] == ["und"]
    assert predict_languages(df.limit(0), "doc_id", "text", None).count() == 0


def test_lang_source_and_id_are_no_inputs(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_languages(df, "doc_id", "text", "lang")
    changed = df.selectExpr("doc_id", "text", "'xx' as lang", "'s' as source")
    a, b = (sorted(map(tuple, predict_languages(x, "doc_id", "text", model).collect())) for x in (df, changed))
    assert a == b


def test_codewords_differ():
    for n in (1, 2, 3, 4, 7, 12):
        code = codewords(n)
        assert len({tuple(c) for c in code.tolist()}) == n and len(code) == n


def test_accuracies_are_recovered():
    rng = np.random.default_rng(2)
    truth = rng.random(20_000) < 0.7
    real = np.array([0.95, 0.9, 0.85, 0.8, 0.7, 0.65])
    right = rng.random((len(truth), len(real))) < real
    vote = np.where(right, truth[:, None], ~truth[:, None]) * 2
    vote[rng.random(vote.shape) < 0.3] = 1
    patterns, counts = np.unique(vote, axis=0, return_counts=True)
    found, good, prior = estimate_accuracies(patterns, counts.astype(float))
    assert np.abs(found - real).max() < 0.03 and abs(prior - 0.7) < 0.03


def test_quality_against_labels(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    edges = spark.createDataFrame([(i, t) for i, t, _ in EDGES], "doc_id bigint, text string").repartition(2)
    df = df.select("doc_id", "text").union(edges).selectExpr("*", "1 as score", "2 as kept", "3 as pattern")
    model = fit_quality(df, "doc_id", "text")
    got = score_quality(df, "doc_id", "text", model).collect()
    kept = {r["doc_id"]: r["kept"] for r in got}
    labels = dict(duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall())
    good = [kept[i] for i, q in labels.items() if q]
    bad = [not kept[i] for i, q in labels.items() if not q]
    assert np.mean(good) > 0.995 and np.mean(bad) > 0.97
    assert set(model.accuracy) == set(LABELLERS)
    assert not kept[-1] and not kept[-2] and not kept[-4] and sum(r["doc_id"] == -5 for r in got) == 2
    rows = keep_good(df, "text", model)
    assert rows.columns == df.columns
    assert {r[0] for r in rows.select("doc_id").collect()} == {i for i, k in kept.items() if k}


def test_quality_without_anything_to_learn(spark):
    df = spark.createDataFrame([(1, None), (2, "  ")], "doc_id bigint, text string")
    assert fit_quality(df, "doc_id", "text") is None
    assert [r["kept"] for r in score_quality(df, "doc_id", "text", None).collect()] == [False, False]
    assert score_quality(df.limit(0), "doc_id", "text", None).count() == 0


def test_votes():
    clean = "A sentence of plain words stands here. Another one follows it, and then a third one ends the text."
    assert 0 not in votes(Shape.of(clean))
    for bad in ("a### b$$$ c%%% d*** e&&& f### g$$$ h%%%", "one | two | three | four | five | six | seven | eight", "NO!! NO!! YES!! WELL!! THIS!! IS!! LOUD!! VERY!!", "the the the the the the the the the the the the"):
        assert votes(Shape.of(bad)).count(0) >= 2, bad
    assert all(_unpack_code(_pattern_code(v)) == v for v in ([0] * 10, [2] * 10, [0, 1, 2] * 3 + [1]))
    row = np.array([0, 0.5, 0, 2], dtype=np.float32)
    assert unpack_sparse(pack_sparse(row), 4).tolist() == row.tolist()
