"""Column contracts between operators, and the checks made at their borders."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRACKS = T.StructType(
    [
        T.StructField("recording_msid", T.StringType()),
        T.StructField("recording_mbid", T.StringType()),
        T.StructField("track_name", T.StringType()),
        T.StructField("artist_name", T.StringType()),
    ]
)
# Long-form ranked list of one user; a global list has no user_id.
LISTS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def require_columns(df: DataFrame, columns: Iterable[str], where: str) -> DataFrame:
    """Return ``df`` unchanged, or fail early naming the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{where}: missing column(s) {missing}; got {df.columns}")
    return df


def unique_by(df: DataFrame, keys: Sequence[str], values: Sequence[str], what: str) -> DataFrame:
    """``df`` reduced to one row per key; a repeated key fails the query.

    The grouping is on the key the caller joins on next, so the check adds a
    hash aggregate but no exchange of its own.
    """
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"), *[F.any_value(v).alias(v) for v in values]
    )
    return grouped.select(
        *keys, *[_if_single(F.col(v), df.schema[v].dataType, what).alias(v) for v in values]
    )


def _if_single(value: Column, dtype: T.DataType, what: str) -> Column:
    return F.when(F.col("_copies") == 1, value).otherwise(
        F.raise_error(F.lit(f"{what}: repeated key")).cast(dtype)
    )
