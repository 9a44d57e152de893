import pytest
from pyspark.sql import functions as F

from tallyrec.operators import ids
from tallyrec.sources.tables import tag

TRACK = "recording_msid string, recording_mbid string"


def tagged_tracks(spark, rows, kind="train"):
    return tag(spark.createDataFrame(rows, TRACK), kind)


def test_ids_are_dense_and_independent_of_partitioning(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), F.col("id") % 3000).alias("key"))
    first = {r.key: r.i for r in ids.dense_ids(keys, "key", "i").collect()}
    second = {r.key: r.i for r in ids.dense_ids(keys.repartition(3), "key", "i", digits=2).collect()}
    assert sorted(first.values()) == list(range(1, 3001))
    assert first == second


def test_user_in_three_splits_gets_one_id(spark):
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    everyone = ids.union_all([tag(users, "train"), tag(users, "train"), tag(users, "test")])
    assert everyone.count() == 9
    got = ids.user_ids(everyone).collect()
    assert sorted(r.u_id for r in got) == [1, 2, 3]
    assert {r.types for r in got} == {"test,train"}


def test_canonical_key_rules(spark):
    tracks = tagged_tracks(
        spark,
        [("a", "X"), ("b", "X"), ("c", None), ("d", ""), ("e", "Z"), ("e", "Y"), ("", None)],
    )
    got = {r.recording_msid: r.long_id for r in ids.canonical_items(tracks).collect()}
    assert got == {"a": "X", "b": "X", "c": "c", "d": "d", "e": "Y"}
    numbered = {r.recording_msid: r.track_id for r in ids.item_ids(tracks).collect()}
    assert numbered["a"] == numbered["b"]
    assert sorted(set(numbered.values())) == [1, 2, 3, 4]


def test_encoding_keeps_every_row(spark):
    users = tag(spark.createDataFrame([(1,), (2,)], "user_id long"), "train")
    users = ids.union_all([users, users, users])
    tracks = tagged_tracks(spark, [("a", "X"), ("b", ""), ("a", "X")])
    log = spark.createDataFrame(
        [(1, "a"), (1, "a"), (2, "b"), (3, "a"), (2, "zz")], "user_id long, recording_msid string"
    )
    encoded = ids.encode(log, ids.item_ids(tracks), ids.user_ids(users))
    assert sorted(encoded.columns) == ["track_id", "user_id"]
    assert encoded.count() == 5
    assert ids.unmatched(encoded).first().asDict() == {"no_item": 1, "no_user": 1}
    counted = ids.encoded_counts(log, ids.item_ids(tracks), ids.user_ids(users))
    assert counted.agg(F.sum("n")).first()[0] == 5


def test_repeated_map_key_is_rejected(spark):
    log = spark.createDataFrame([(1, "a")], "user_id long, recording_msid string")
    items = spark.createDataFrame([("a", 1), ("a", 2)], "recording_msid string, track_id long")
    users = spark.createDataFrame([(1, 1)], "user_id long, u_id long")
    with pytest.raises(Exception, match="repeated key"):
        ids.encode(log, items, users).collect()


def test_hot_recording_is_split_into_chunks(spark):
    rows = [(f"m{i}", "hot") for i in range(500)] + [(f"s{i}", None) for i in range(50)]
    tracks = tagged_tracks(spark, rows)
    groups = ids.item_groups(tracks, chunk=64)
    sizes = [r.n for r in groups.where("long_id = 'hot'").select(F.size("members").alias("n")).collect()]
    assert sorted(sizes) == [500 - 7 * 64] + [64] * 7
    back = {(r.recording_msid, r.long_id) for r in ids.ungroup_items(groups).collect()}
    assert back == {(m, k or m) for m, k in rows}
