"""Key expressions: hashed sort keys, canonical item keys, normalised text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(prefix: object, *columns: str) -> Column:
    """Eight bytes of md5 over ``prefix|col|col...`` (no prefix where it is None).

    Sorting by it is a reproducible shuffle: it depends on the values and the
    prefix, never on how the rows happen to be partitioned. Nulls hash as ''.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    if prefix is not None:
        parts = [F.lit(str(prefix)), *parts]
    text = F.concat_ws("|", *parts)
    return F.unhex(F.substring(F.md5(text), 1, 16))


def key_position(key: Column) -> Column:
    """Where a hashed key lies in [0, 1), in key order."""
    return F.conv(F.hex(F.substring(key, 1, 4)), 16, 10).cast("double") / F.lit(float(2**32))


def key_below(key: Column, fraction: float) -> Column:
    """Whether a hashed key falls in the lowest ``fraction`` of the key range."""
    if fraction >= 1:
        return F.lit(True)
    return key < F.unhex(F.lit(f"{round(fraction * 2**32):08x}"))


def canonical_key(mbid: str, msid: str) -> Column:
    """The shared recording key where there is one, else the submission's own key."""
    return F.coalesce(F.nullif(F.col(mbid), F.lit("")), F.col(msid))


def normalised_key(*columns: str) -> Column:
    """Lower-cased letters and digits of the columns, run together."""
    return F.concat_ws("", *[F.regexp_replace(F.lower(c), "[^a-z0-9]+", "") for c in columns])
