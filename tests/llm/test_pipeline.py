import duckdb
import numpy as np
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tallyrec.llm.queries import WORD_MODEL
from tests.llm.test_jaccard import shingles

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame(
        [(-1, None, None, None, None), (-2, "", "en", "s", 0), (-3, "### $$$ %%%", "en", "s", 11)], docs.schema
    )
    docs = docs.union(extra).withColumnsRenamed({}).selectExpr("*", "7 as score", "8 as place")
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = corpus_pipeline.materialise(stage(spark, before, SF), f"test-{k}")
        seen.append(docs)
        if k < 3:
            assert docs.columns == before.columns
            rows = {r["doc_id"]: r for r in before.collect()}
            assert all(rows[r["doc_id"]] == r for r in docs.collect())
    ids = [{r[0] for r in d.select("doc_id").distinct().collect()} for d in seen]
    assert not ids[0] & {-1, -2, -3} and ids[0] >= ids[1] >= ids[2] == ids[3]
    # stage 3 keeps the smallest id of each group, found by comparing all pairs
    text = {r["doc_id"]: r["text"] for r in seen[1].collect()}
    sets = {i: shingles(t) for i, t in text.items()}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(sets)
    for n, i in enumerate(order):
        for j in order[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    assert ids[2] == {top(i) for i in sets}
    # stage 4 holds every id of what is left
    library = Tokenizer.from_file(WORD_MODEL)
    total = sum(len(library.encode(text[i], add_special_tokens=False).ids) + 1 for i in ids[2])
    assert sum(r["length"] for r in seen[3].collect()) == total


def test_good_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = corpus_pipeline.materialise(stage(spark, docs, "/root/testdata/sf0.01"), "test-good")
    kept = {r[0] for r in docs.select("doc_id").collect()}
    labels = duckdb.sql("select doc_id, quality from '/root/testdata/sf0.01/labels.parquet'").fetchall()
    assert np.mean([i in kept for i, q in labels if q]) > 0.99
    assert np.mean([i not in kept for i, q in labels if not q]) > 0.9


def test_registered():
    names = entry.queries().keys()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert entry.oracle_sql().keys() <= names
