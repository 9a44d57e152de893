"""Item ids over two keys: submissions that share a canonical key or a name, directly or through others, are one item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrec.operators.components import components
from tallyrec.operators.ids import dense_ids
from tallyrec.sources.stage import materialise


def name_key(title: str, artist: str) -> Column:
    """Lower-cased letters and digits of any script, title and artist apart; null if either has none."""
    parts = [F.regexp_replace(F.lower(F.col(c)), r"[^\p{L}\p{N}]+", "") for c in (title, artist)]
    whole = (F.length(parts[0]) > 0) & (F.length(parts[1]) > 0)
    return F.when(whole, F.concat(parts[0], F.lit("|"), parts[1]))


def linked_items(tracks: DataFrame) -> DataFrame:
    """(recording_msid, linked_key, track_id): one row per submission key.

    Two submissions are linked if they share a non-empty ``recording_mbid``, or title and artist after
    :func:`name_key`; a submission may have several rows, and each links. ``linked_key`` is the smallest
    submission key of all that are linked, ``track_id`` numbers those from 1. An empty key, title or artist links
    nothing; an empty submission key is dropped.

    A key shared by many links each of them with the first only, so its edges are as many as its rows;
    the join that finds the first is one that adaptive execution splits on a hot key.
    """
    named = tracks.where(F.nullif("recording_msid", F.lit("")).isNotNull())
    numbered = materialise(dense_ids(named, "recording_msid", "_n"), "linked-numbers")
    keys = F.array(
        F.struct(F.lit("mbid").alias("kind"), F.nullif("recording_mbid", F.lit("")).alias("key")),
        F.struct(F.lit("name").alias("kind"), name_key("track_name", "artist_name").alias("key")),
    )
    shared = (
        named.select("recording_msid", F.explode(keys).alias("_k"))
        .select("recording_msid", "_k.kind", "_k.key")
        .where("key is not null")
        .distinct()
        .join(numbered, "recording_msid")
        .select("kind", "key", F.col("_n").alias("b"))
    )
    shared = materialise(shared, "linked-keys")
    first = shared.groupBy("kind", "key").agg(F.min("b").alias("a"), F.count(F.lit(1)).alias("n"))
    first = materialise(first.where("n > 1").drop("n"), "linked-first")
    roots = components(shared.join(first, ["kind", "key"]).select("a", "b"))
    rooted = numbered.join(roots.withColumnRenamed("v", "_n"), "_n", "left").select(
        "recording_msid", F.coalesce("root", "_n").alias("_root")
    )
    smallest = rooted.groupBy("_root").agg(F.min("recording_msid").alias("linked_key"))
    linked = materialise(rooted.join(smallest, "_root").select("recording_msid", "linked_key"), "linked-items")
    ids = materialise(dense_ids(linked, "linked_key", "track_id"), "linked-ids")
    return linked.join(ids, "linked_key").select("recording_msid", "linked_key", "track_id")
