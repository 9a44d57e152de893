"""Helpers shared by the operators that work on Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that are handled at once; a longer text is a group of its own.
GROUP_BYTES = 1 << 20


def text_groups(
    batch: pa.RecordBatch, column: int, limit: int = GROUP_BYTES
) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of neighbouring rows of about ``limit`` characters: first row, texts."""
    texts: list[str | None] = []
    start = size = 0
    for row, value in enumerate(batch.column(column)):
        text = value.as_py()
        texts.append(text)
        size += len(text) if text else 0
        if size >= limit:
            yield start, texts
            texts, start, size = [], row + 1, 0
    if texts:
        yield start, texts


def give_back_memory() -> None:
    """Returns what a finished task has freed to the system; workers live on and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_arrow(
    df: DataFrame,
    columns: list[str],
    function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: T.StructType | str,
) -> DataFrame:
    """``function`` over the batches of just ``columns``; names never clash with others."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back_memory()

    return df.select(*(F.col(f"`{c}`") for c in columns)).mapInArrow(run, schema)


def keep_rows(
    df: DataFrame, column: str, decide: Callable[[list], list[bool]], limit: int = GROUP_BYTES
) -> DataFrame:
    """Rows of ``df``, all columns as they are, for whose ``column`` ``decide`` says so."""
    at = df.columns.index(column)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept: list[bool] = []
            if pa.types.is_string(batch.column(at).type):
                for _, texts in text_groups(batch, at, limit):
                    kept.extend(decide(texts))
            else:
                kept = list(decide(batch.column(at).to_pylist()))
            yield batch.filter(pa.array(kept, pa.bool_()))
        give_back_memory()

    return df.mapInArrow(run, df.schema)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Smaller Arrow batches while large rows (whole blocks, whole sets) are worked on.

    Spark counts the rows of a batch, not their bytes. What is to use the setting must be
    planned and run inside.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
