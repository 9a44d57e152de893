"""Conversions between long-form ranked lists and array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_arrays(lists: DataFrame, groups: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per group with its ``values`` as arrays in rank order.

    Meant for ranked lists, whose groups are bounded by the list size.
    """
    entries = F.array_sort(F.collect_list(F.struct("rank", *values)))
    grouped = lists.groupBy(*groups).agg(entries.alias("_entries"))
    return grouped.select(*groups, *[F.col(f"_entries.{v}").alias(v) for v in values])


def from_array(df: DataFrame, groups: Sequence[str], array: str, value: str) -> DataFrame:
    """Long form of an array column, with the 1-based ``rank`` of each element."""
    return df.select(*groups, F.posexplode(array).alias("_pos", value)).select(
        *groups, (F.col("_pos") + 1).alias("rank"), value
    )


def head_of(array: str, k: int) -> Column:
    return F.slice(array, 1, k)


def as_doubles(array: str) -> Column:
    return F.transform(array, lambda x: x.cast("double"))
