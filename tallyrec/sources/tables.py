"""Inputs of a run, and the artifacts its stages leave behind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_split(
    spark: SparkSession, path: str, name: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Interactions, tracks and users of one named split (``train``, ``test``, ...)."""
    return tuple(
        spark.read.parquet(f"{path}/{table}_{name}.parquet")
        for table in ("interactions", "tracks", "users")
    )


def tag(df: DataFrame, kind: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``df`` (or some of its columns) with its provenance in a ``type`` column."""
    kept = df.select(*columns) if columns else df
    return kept.withColumn("type", F.lit(kind))


def write_artifact(
    df: DataFrame, base: str, name: str, partition_by: Sequence[str] = ()
) -> None:
    """Overwrite one stage artifact.

    ``partition_by`` takes low-cardinality columns only (split, beta, rank):
    one directory per user would bury the name node in small files.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{base}/{name}.parquet")


def read_artifact(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def write_csv(lists: DataFrame, path: str) -> None:
    """Export long-form lists as CSV with a header (one row per recommended item)."""
    lists.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
