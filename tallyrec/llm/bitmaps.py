"""Bounded bitmaps of column values: a first, approximate filter before exact joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BLOCK = 32_768  # bits of one value of bitmap_construct_agg


def bitmap(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """One bit for each value modulo ``bits``, eight to a byte. At most ``bits / 8`` bytes reach the driver.

    A value that is in ``df`` is always found; others by chance only, more of them as
    the table grows, so an exact join must follow.
    """
    slot = F.pmod(F.col(column), F.lit(bits))
    parts = (
        df.select((slot / _BLOCK).cast("bigint").alias("block"), (slot % _BLOCK).alias("at"))
        .groupBy("block")
        .agg(F.bitmap_construct_agg("at").alias("bits"))
    )
    found = np.zeros(bits // 8, dtype=np.uint8)
    for row in parts.collect():
        at = row["block"] * _BLOCK // 8
        some = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)[: len(found) - at]
        found[at : at + len(some)] = some
    return found


def in_bitmap(found: np.ndarray, values: np.ndarray) -> np.ndarray:
    slot = np.mod(values, 8 * len(found))
    return (found[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
