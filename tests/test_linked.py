import pytest

from tallyrec.operators.linked import linked_items
from tallyrec.schemas import TRACKS


def linked(spark, rows):
    found = linked_items(spark.createDataFrame(rows, TRACKS).repartition(3)).collect()
    assert len({(r.linked_key, r.track_id) for r in found}) == len({r.linked_key for r in found})
    assert sorted({r.track_id for r in found}) == list(range(1, len({r.linked_key for r in found}) + 1))
    return {r.recording_msid: r.linked_key for r in found}


def test_either_key_links_and_links_chain(spark):
    rows = [
        ("m1", "b1", "Song", "Artist"),
        ("m2", "b1", "Other", "Artist"),
        ("m3", "", "OTHER!", "ar-tist"),
        ("m4", None, "Songartist", ""),
        ("m5", None, "Song", "Someone"),
        ("m6", "b6", "x", "y"),
        ("m6", "b7", "x", "y"),
        ("m7", "b7", "p", "q"),
        ("", "b1", "Song", "Artist"),
        (None, "b1", "Song", "Artist"),
    ]
    assert linked(spark, rows) == {
        "m1": "m1", "m2": "m1", "m3": "m1", "m4": "m4", "m5": "m5", "m6": "m6", "m7": "m6"}


def test_other_scripts_link_and_empty_parts_do_not(spark):
    rows = [
        ("a1", None, "Песня", "Хор"), ("a2", "", "ПЕСНЯ ", "хор"), ("a3", None, "Другая", "Хор"),
        ("b1", None, "漢字 かな", "歌手"), ("b2", None, "漢字かな", "歌手!"),
        ("c1", None, "!!!", "..."), ("c2", None, "???", "..."), ("c3", None, None, "X"), ("c4", None, "", "X"),
        ("d1", None, "ab", "c"), ("d2", None, "a", "bc"),
    ]
    found = linked(spark, rows)
    assert found == {"a1": "a1", "a2": "a1", "a3": "a3", "b1": "b1", "b2": "b1"} | {
        k: k for k in ("c1", "c2", "c3", "c4", "d1", "d2")}


def test_a_hot_key_and_long_chains(spark):
    rows = [(f"h{k:04}", "hot", f"t{k}", "a") for k in range(500)]
    rows += [(f"k{k:03}", f"c{(k + 1) // 2}", f"n{k // 2}", "z") for k in range(60)]
    found = linked(spark, rows)
    assert {found[f"h{k:04}"] for k in range(500)} == {"h0000"}
    assert {found[f"k{k:03}"] for k in range(60)} == {"k000"}


@pytest.mark.parametrize("rows", [[], [("m", None, None, None)]])
def test_nothing_to_link(spark, rows):
    assert linked(spark, rows) == {m: m for m, *_ in rows}
