"""Dense surrogate ids, canonical item ids, and encoding of interactions with them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrec.functions.keys import canonical_key
from tallyrec.operators.split import hashed_rank
from tallyrec.schemas import unique_by
from tallyrec.sources.stage import materialise


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of several splits of one table, matched by column name, repeats kept."""
    return reduce(DataFrame.unionByName, tables)


def number_rows(df: DataFrame, key: str, id_name: str, digits: int = 3) -> DataFrame:
    """Add ids 1..N to a table with one row per (non-null) key, in md5 order of the key.

    The keys are ranked apart in 16^digits buckets of md5 prefixes, then shifted
    by the rows in lower buckets. md5 fills the buckets evenly whatever the keys
    look like, and the result depends on the keys alone: not on partitioning,
    sampling or a recomputed task. Only the bucket totals (16^digits rows) are
    ever in one place.
    """
    md5 = F.md5(F.col(key).cast("string"))
    bucketed = df.select(
        "*", F.substring(md5, 1, digits).alias("_bucket"), F.unhex(md5).alias("_md5")
    )
    totals = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    lower = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(
        F.col("_bucket").alias("_of"), F.coalesce(F.sum("_rows").over(lower), F.lit(0)).alias("_shift")
    )
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy("_md5"))
    return (
        bucketed.withColumn("_pos", local)
        .join(F.broadcast(shifts), F.col("_bucket") == F.col("_of"))
        .select(*df.columns, (F.col("_pos") + F.col("_shift")).alias(id_name))
    )


def dense_ids(keys: DataFrame, key: str, id_name: str, digits: int = 3) -> DataFrame:
    """(key, id): ids 1..N over the distinct non-null keys of a table."""
    distinct = keys.select(key).where(F.col(key).isNotNull()).distinct()
    return number_rows(distinct, key, id_name, digits)


def user_ids(users: DataFrame) -> DataFrame:
    """(user_id, u_id, types) from tagged users of all splits: one row per user."""
    tagged = users.where("user_id is not null").groupBy("user_id").agg(
        F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types")
    )
    # staged because both the buckets and their totals read it
    numbered = number_rows(materialise(tagged, "tagged-users"), "user_id", "u_id")
    return numbered.select("user_id", "u_id", "types")


def canonical_items(tracks: DataFrame) -> DataFrame:
    """(recording_msid, long_id, types): one canonical key per submission key.

    Where splits disagree the smallest canonical key wins, so the map cannot fan
    out. An empty canonical key counts as missing; an empty submission key is
    dropped.
    """
    one = tracks.groupBy("recording_msid").agg(
        F.min(F.nullif("recording_mbid", F.lit(""))).alias("recording_mbid"),
        F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"),
    )
    keyed = one.withColumn("long_id", canonical_key("recording_mbid", "recording_msid"))
    return keyed.where("long_id != ''").select("recording_msid", "long_id", "types")


def item_ids(tracks: DataFrame) -> DataFrame:
    """(track_id, recording_msid, types): submissions of one recording share the id."""
    items = materialise(canonical_items(tracks), "canonical-items")
    return items.join(dense_ids(items, "long_id", "track_id"), "long_id").select(
        "track_id", "recording_msid", "types"
    )


def checked_map(id_map: DataFrame, key: str, id_name: str) -> DataFrame:
    """The map as a stage table; a key it lists twice fails the query."""
    return materialise(unique_by(id_map, [key], [id_name], f"{key} map"), "id-map")


def encode(
    log: DataFrame, item_map: DataFrame, user_map: DataFrame, trusted: bool = False
) -> DataFrame:
    """Replace the string keys of a log by (user_id, track_id), keeping every row.

    Rows without a match keep a null id (see :func:`unmatched`). Maps must be
    unique by key or rows would multiply, which is checked unless ``trusted``.
    Both maps should be stored tables: a join of plain scans is one whose hot
    keys adaptive execution can split over several tasks.
    """
    items = item_map.select("recording_msid", "track_id")
    users = user_map.select("user_id", "u_id")
    if not trusted:
        items = checked_map(items, "recording_msid", "track_id")
        users = checked_map(users, "user_id", "u_id")
    return (
        log.join(items, "recording_msid", "left")
        .join(users, "user_id", "left")
        .drop("recording_msid", "user_id")
        .withColumnRenamed("u_id", "user_id")
    )


def unmatched(encoded: DataFrame) -> DataFrame:
    """How many encoded rows lack an item id, and how many a user id."""
    return encoded.agg(
        F.count_if(F.col("track_id").isNull()).alias("no_item"),
        F.count_if(F.col("user_id").isNull()).alias("no_user"),
    )


def encoded_counts(
    log: DataFrame,
    item_map: DataFrame,
    user_map: DataFrame,
    by: Sequence[str] = (),
    trusted: bool = False,
) -> DataFrame:
    """(by.., user_id, item_id, n) of a log in surrogate ids.

    The log is counted before it meets the maps, so the joins move one row per
    distinct pair instead of one per event, then counts of submissions that
    share a recording are added up.
    """
    pairs = log.groupBy(*by, "user_id", "recording_msid").agg(F.count(F.lit(1)).alias("n"))
    return (
        encode(pairs, item_map, user_map, trusted)
        .groupBy(*by, "user_id", F.col("track_id").alias("item_id"))
        .agg(F.sum("n").alias("n"))
    )


def item_groups(tracks: DataFrame, chunk: int = 1000) -> DataFrame:
    """(long_id, chunk, members): the submissions that share a recording.

    ``members`` is an array of (pos, recording_msid, types). The members of a recording
    are numbered by hash and packed into arrays of at most ``chunk``, so the group of a
    hot key is many rows, never one.
    """
    items = materialise(canonical_items(tracks), "canonical-items").withColumn(
        "_key", F.unhex(F.md5("recording_msid"))
    )
    loads = items.groupBy("long_id").agg(F.count(F.lit(1)).alias("load"))
    ranked = hashed_rank(items, ["long_id"], "_key", ["recording_msid"], loads)
    numbered = ranked.withColumn("chunk", F.floor((F.col("pos") - 1) / F.lit(chunk)))
    members = F.array_sort(F.collect_list(F.struct("pos", "recording_msid", "types")))
    return numbered.groupBy("long_id", "chunk").agg(members.alias("members"))


def ungroup_items(groups: DataFrame) -> DataFrame:
    """(long_id, recording_msid, types): the members of :func:`item_groups`, one per row."""
    return groups.select("long_id", F.inline("members")).drop("pos")
