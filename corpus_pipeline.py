"""A corpus pipeline over the table documents: four operators in turn.

1. language ID: documents whose text is not clearly in a learned language go;
2. quality classifier: documents that the scorer rejects go;
3. n-gram Jaccard join: one document (the smallest doc_id) of each group of copies stays;
4. packing: what is left becomes sequences of tokens.

The first three return the columns of documents, rows as they are. Each stage's result
is written to the shared checkpoint folder and read again, so a lost executor costs no
finished stage. Null texts and texts without a letter go at stage 1; empty tables pass
through as empty; rows that share an id are told apart by their texts at stage 3: of equal or
linked ones one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyrec.llm import jaccard, language, packing, quality
from tallyrec.llm.queries import END_ID, SEQUENCE, WORD_MODEL, workers_find_package
from tallyrec.sources.stage import materialise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_find_package(spark)
    model = language.fit_languages(docs, "doc_id", "text", "lang")
    return language.keep_known(docs, "text", model)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_find_package(spark)
    return quality.keep_good(docs, "text", quality.fit_quality(docs, "doc_id", "text"))


def jaccard_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_find_package(spark)
    return jaccard.one_of_each(docs, "doc_id", "text")


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_find_package(spark)
    return packing.pack(docs, "doc_id", "text", WORD_MODEL, END_ID, SEQUENCE)


STAGES = [
    ("language ID", language_id),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", jaccard_groups),
    ("packing", pack_documents),
]

#: Training, hashing and packing have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages on the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
