"""Ranked lists per group, with ties going to the smaller item."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: List rows one task holds: about a hundred bytes each where they are grouped and sorted.
TASK_ROWS = 1 << 20


def tasks_of(df: DataFrame, rows: int, task_rows: int = TASK_ROWS) -> int:
    """Tasks for that many rows. Adaptive execution would merge them by compressed bytes, and lists compress well."""
    small = min(df.sparkSession.sparkContext.defaultParallelism, math.ceil(16 * rows / task_rows))
    return max(1, small, math.ceil(rows / task_rows))


def dealt_rows(stored: DataFrame, keys: Sequence[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """The rows of a stored table in tasks of about ``task_rows``, once a core would read more: a file's splits go by bytes."""
    tasks = tasks_of(stored, stored.count(), task_rows)
    return stored.repartition(tasks, *keys) if tasks > stored.sparkSession.sparkContext.defaultParallelism else stored


def top_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """Add ``rank`` and keep the ``k`` first rows of every group.

    Spark limits each group before the shuffle as well as after it, so a hot
    group sends at most ``k`` rows per input partition to its task.
    """
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def ground_truth(
    counts: DataFrame, k: int = 100, groups: Sequence[str] = ("user_id", "split")
) -> DataFrame:
    """The ``k`` most frequent items of every user, in long form."""
    ranked = top_per_group(counts, groups, [F.desc("n"), F.asc("item_id")], k)
    return ranked.select(*groups, "rank", "item_id", "n")
