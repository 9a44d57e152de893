import base64
import gzip
import hashlib
import io
import random
import zlib

import pytest

from tallyrec.llm import warc
from tallyrec.llm.queries import llm_oracles, op12_warc
from tallyrec.sources.stage import fresh_path

SCHEMA = "page_id bigint, url string, html string"


def brute(rows, least=0):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, p in payloads:
        if i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, p in payloads:
        source = first.get(p)
        repeat = len(p) >= least and source is not None and i != source
        sha = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), sha, "revisit" if repeat else "response", source if repeat else None))
    return sorted(out, key=repr)


def odd_rows():
    rng = random.Random(2)
    rows = [(i, f"http://x/{i}", "".join(chr(rng.randint(32, 0x2FF)) for _ in range(rng.randint(0, 900)))) for i in range(120)]
    rows += [(200 + i, "http://y/ ü\r\nWARC-Type: warcinfo\t%20", "<p>same</p>") for i in range(60)]
    rows += [(150, None, "<p>same</p>"), (150, None, "<p>same</p>"), (None, "", "<p>same</p>"), (None, "u", "no id"), (None, "u", "no id")]
    rows += [(300, "u", None), (299, "u", ""), (298, "u", None), (-5, "u" * 100_000, "x\r\n\r\nWARC/1.1\r\n\r\n" + "é" * 700_000)]
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4).selectExpr("*", "1 as key", "2 as payload", "3 as first", "4 as size")


@pytest.mark.parametrize("least, split", [(0, 37), (0, 1 << 20), (5, 4096), (10**9, 4096)])
def test_round_trip(spark, least, split):
    rows = odd_rows()
    files = warc.write_archives(table(spark, rows), "page_id", "url", "html", fresh_path(spark, "t"), least, archive_bytes=20_000)
    got = warc.read_archives(files, split if split > 1000 or least else 997, payloads=True).collect()
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == brute(rows, least)
    text = {(i, (h or "").encode()) for i, _, h in rows}
    assert all((r.page_id, bytes(r.payload)) in text for r in got if r.record_type == "response")
    assert all(r.payload is None for r in got if r.record_type == "revisit")
    assert len({(r.archive, r.offset) for r in got}) == len(got) == files.agg({"records": "sum"}).first()[0]
    uri = next(r.target_uri for r in got if r.page_id == 201)
    assert uri == "http://y/%20%C3%BC%0D%0AWARC-Type:%20warcinfo%09%20"


def test_archives_are_plain_gzip(spark):
    files = warc.write_archives(table(spark, odd_rows()), "page_id", "url", "html", fresh_path(spark, "t")).collect()
    data = b"".join(gzip.open(f.path).read() for f in files)
    assert data.count(b"WARC/1.1\r\nWARC-Type: response\r\n") + data.count(b"WARC/1.1\r\nWARC-Type: revisit\r\n") == sum(f.records for f in files)


def test_every_cut_finds_each_record_once():
    payloads = [b"", b"a", random.Random(0).randbytes(3000), b"<p>" * 500, warc.MAGIC * 5]
    members = [warc.page_member(i, None, p, None, "d") for i, p in enumerate(payloads)]
    # a stored block that holds magic bytes, and one that holds the start of a member but not all of it
    stored = zlib.compressobj(0, wbits=31)
    fake = stored.compress(b"WARC/1.1\r\nContent-Length: 40\r\n\r\n" + warc.MAGIC + b"\0" * 37 + b"\r\n\r\n") + stored.flush()
    data = b"".join(members) + fake + members[0][:-20]
    starts = [0]
    for m in members:
        starts.append(starts[-1] + len(m))
    handle = io.BytesIO(data)
    assert [at for at, _ in warc.records_in(handle, 0, len(data))] == starts
    for cut in range(0, len(data) + 1, 7):
        halves = [*warc.records_in(handle, 0, cut), *warc.records_in(handle, cut, len(data))]
        assert [at for at, _ in halves] == starts
        assert all(at < cut for at, _ in warc.records_in(handle, 0, cut))


def test_bad_records_are_refused():
    good = warc.page_member(1, "u", b"abc", None, "d")
    assert warc.decode_member(io.BytesIO(good), 0).end == len(good)
    for k in range(len(good)):
        assert warc.decode_member(io.BytesIO(good[:k]), 0) is None
    for block in (b"no header", b"WARC/1.1\r\nContent-Length: x\r\n\r\n", b"WARC/1.1\r\nContent-Length: 1\r\n\r\nab\r\n\r\n"):
        assert warc.decode_member(io.BytesIO(gzip.compress(block)), 0) is None
    altered = warc.member("response", {"WARC-Payload-Digest": "sha1:X"}, b"HTTP/1.1 200 OK\r\nContent-Length: 1\r\n\r\na")
    with pytest.raises(ValueError):
        warc._page_row(warc.decode_member(io.BytesIO(altered), 0))


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA), "page_id", "url", "html").count() == 0


def test_oracle(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("create view pages as select * from '/root/testdata/sf0.01/pages.parquet'")
    got = op12_warc(spark, "/root/testdata/sf0.01")
    want = con.execute(llm_oracles()["op12_warc"])
    assert got.columns == [d[0] for d in want.description]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))
