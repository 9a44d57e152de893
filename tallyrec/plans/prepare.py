"""The shared front of every run: count, profile and split an interaction log once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyrec.config import SplitParams
from tallyrec.operators.interactions import count_interactions, user_activity
from tallyrec.operators.ranking import TASK_ROWS, dealt_rows, ground_truth
from tallyrec.operators.split import split_counts
from tallyrec.sources.stage import materialise


@dataclass(frozen=True)
class Counted:
    """Stage tables with one row per (kind, user, item) and per (kind, user)."""

    counts: DataFrame
    activity: DataFrame


def count_log(log: DataFrame) -> Counted:
    """Aggregate a log tagged ``kind``; the only pass over the raw events."""
    counts = materialise(count_interactions(log, ["kind"]), "counts")
    return Counted(counts, materialise(user_activity(counts, ["kind"]), "activity"))


def split_rows(log: DataFrame, params: SplitParams = SplitParams()) -> DataFrame:
    """(split, user_id, item_id, n), to be written by the caller."""
    counted = count_log(log)
    return split_counts(counted.counts, counted.activity, params)


def prepare_splits(log: DataFrame, params: SplitParams = SplitParams()) -> DataFrame:
    """Stage table (split, user_id, item_id, n), partitioned by split."""
    return materialise(split_rows(log, params), "splits", partition_by="split")


def split_truth(splits: DataFrame, k: int = SplitParams.list_size, task_rows: int = TASK_ROWS) -> DataFrame:
    """:func:`ground_truth` of stored splits. A hot user's rows are dealt out too, and cut to ``k`` in every task."""
    return ground_truth(dealt_rows(splits, ["user_id", "split", "item_id"], task_rows), k)
