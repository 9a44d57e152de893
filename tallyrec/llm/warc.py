"""WARC archives: written one gzip member per record, read back by byte ranges.

Writing. Pages with equal payloads (told by SHA-256, since SHA-1 can be forged) become one response, that with
the smallest id, and revisits that refer to it. Few payloads can be hot (more than a ten-thousandth of
all pages): those are joined from a broadcast of at most ``HOT_SHARE`` rows, the others by a shuffle. A task
writes its records to files of its own below the shared folder and reports them; only files that a
finished task reported belong to the result, so a lost executor leaves no half file in it.

Reading. An archive is cut into byte ranges without looking at it. The task of a range searches it for the
magic bytes of gzip, checks each place by decoding a member's beginning (it must be a WARC header) and then
all of it (the lengths and the checksum must agree), and owns the records that start inside the range, to
their last byte even if that lies beyond it. After an accepted record the next one starts where it ends;
after a refused place the search goes on one byte further. The magic bytes are no valid UTF-8, so a stored
(uncompressed) page cannot imitate a member; compressed bytes that hold them by chance do not decode.

Defined results: a null page is empty; equal rows that share a payload's smallest id are responses each, so
a row never refers to itself; rows without id refer to the smallest id of their payload or, if no row has
one, are responses; a null url has no header, and blanks, control characters and letters outside ASCII
are percent-encoded in it; an empty table gives no records; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.batches import arrow_rows, map_arrow
from tallyrec.sources.stage import fresh_path, materialise

#: An archive is closed once it has this many bytes.
ARCHIVE_BYTES = 1 << 30
#: Bytes of a range that one task reads.
SPLIT_BYTES = 8 << 20
#: A payload is hot if it makes up more than one part in so many; so there are fewer hot ones than this.
HOT_SHARE = 10_000
#: Payloads handed to Python at once, and bytes handed back.
PAGES_AT_ONCE = 200
BATCH_BYTES = 4 << 20

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_VISIBLE = "".join(map(chr, range(0x21, 0x7F)))
#: Bytes read ahead of a range's place, and handed to the decoder at once.
_AHEAD = 1 << 20
_BLOCK = 1 << 18


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _fields(values: dict[str, str | None]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in values.items() if v is not None).encode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def member(kind: str, fields: dict[str, str | None], block: bytes) -> bytes:
    """A record as a gzip member of its own."""
    header = {"WARC-Type": kind, **fields, "Content-Length": str(len(block))}
    packer = zlib.compressobj(wbits=31)
    return packer.compress(VERSION + b"\r\n" + _fields(header) + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def page_member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response with its payload, or a revisit with the headers of its response only."""
    http = b"HTTP/1.1 200 OK\r\n" + _fields(
        {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload))}
    ) + b"\r\n"
    fields = {
        "WARC-Record-ID": _urn(page_id),
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else quote(url, safe=_VISIBLE),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "Content-Type": "application/http;msgtype=response",
    }
    if refers_to is None:
        return member("response", fields, http + payload)
    fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": _urn(refers_to)}
    return member("revisit", fields, http)


def with_first(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, url, payload and, for pages that repeat another's payload, its id as ``refers_to``."""
    keyed = pages.withColumn("key", F.unhex(F.sha2("payload", 256)))
    large = keyed.where(F.octet_length("payload") >= least_bytes)
    groups = materialise(
        large.groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n")), "warc-payloads"
    )
    total = groups.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") > total / HOT_SHARE
    hot = F.broadcast(groups.where(is_hot).select("key", "first"))  # fewer than HOT_SHARE rows
    rare = groups.where(~is_hot).select("key", "first")
    found = (
        keyed.where(F.octet_length("payload") < least_bytes)
        .withColumn("first", F.lit(None).cast("bigint"))
        .unionByName(large.join(hot, "key"))
        .unionByName(large.join(hot, "key", "left_anti").join(rare, "key"))
    )
    repeats = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return found.select("page_id", "url", "payload", F.when(repeats, F.col("first")).alias("refers_to"))


def write_archives(
    df: DataFrame,
    id_column: str,
    url_column: str,
    text_column: str,
    folder: str,
    least_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes every row to archives below ``folder``; returns path, size and records of each archive.

    Payloads of at least ``least_bytes`` are stored once.
    """
    pages = df.select(
        F.col(f"`{id_column}`").cast("bigint").alias("page_id"),
        F.col(f"`{url_column}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{text_column}`").cast("binary"), F.lit(b"")).alias("payload"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        system, root = FileSystem.from_uri(folder)
        out, done, size, records = None, [], 0, 0
        for batch in batches:
            for row in range(batch.num_rows):
                page_id, url, payload, refers_to = (c[row].as_py() for c in batch.columns)
                if out is None:
                    system.create_dir(root, recursive=True)
                    name = f"{TaskContext.get().partitionId():06}-{uuid.uuid4().hex}.warc.gz"
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                    start = member(
                        "warcinfo",
                        {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": date, "WARC-Filename": name,
                         "Content-Type": "application/warc-fields"},
                        _fields({"format": "WARC File Format 1.1"}),
                    )
                    out.write(start)
                    size, records = len(start), 0
                data = page_member(page_id, url, payload, refers_to, date)
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((name, size, records))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size, records))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([f"{folder}/{n}" for n, _, _ in done], pa.string()),
                pa.array([s for _, s, _ in done], pa.int64()),
                pa.array([r for _, _, r in done], pa.int64()),
            ],
            ["path", "size", "records"],
        )

    with arrow_rows(df.sparkSession, PAGES_AT_ONCE):
        decided = with_first(pages, least_bytes)
        return materialise(
            map_arrow(decided, decided.columns, run, "path string, size bigint, records bigint"), "warc-archives"
        )


@dataclass(frozen=True)
class Record:
    fields: dict[str, str]
    block: bytes
    end: int


def decode_member(handle, at: int) -> Record | None:
    """The record whose gzip member starts at ``at``; None if there is none."""
    handle.seek(at)
    unpack = zlib.decompressobj(wbits=31)
    data, read, want = bytearray(), at, None
    fields: dict[str, str] = {}
    body, step = 0, 2048
    while not unpack.eof:
        step = min(2 * step, _BLOCK)
        block = handle.read(step)
        if not block:
            return None
        read += len(block)
        while block and not unpack.eof:
            try:
                data += unpack.decompress(block, _BLOCK)
            except zlib.error:
                return None
            block = unpack.unconsumed_tail
            if not data.startswith(b"WARC/1."[: len(data)]):
                return None
            if want is None and (stop := data.find(b"\r\n\r\n")) >= 0:
                fields = parse_fields(bytes(data[:stop]))
                if not fields.get("content-length", "").isdecimal():
                    return None
                body = stop + 4
                want = body + int(fields["content-length"]) + 4
            if want is not None and len(data) > want:
                return None
    if want != len(data):
        return None
    return Record(fields, bytes(data[body:-4]), read - len(unpack.unused_data))


def parse_fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; the first line is left out."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    pairs = (line.partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def records_in(handle, start: int, stop: int) -> Iterator[tuple[int, Record]]:
    """The records that start in [start, stop), with their offsets."""
    at, base, window = start, start, b""
    while at < stop:
        if at < base or at + len(MAGIC) > base + len(window):
            handle.seek(at)
            base, window = at, handle.read(_BLOCK)
            if len(window) < len(MAGIC):
                return
        found = window.find(MAGIC, at - base)
        if found < 0:
            at = base + len(window) - len(MAGIC) + 1
            continue
        at = base + found
        if at >= stop:
            return
        record = decode_member(handle, at)
        if record is None:
            at += 1
            continue
        yield at, record
        at = record.end


RECORDS = (
    "archive string, offset bigint, page_id bigint, target_uri string, record_type string, refers_to bigint, "
    "payload_bytes bigint, payload_digest string"
)


def read_archives(files: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = False) -> DataFrame:
    """One row per response or revisit in the archives ``files`` (path, size), found range by range.

    Length and digest are those of the whole payload: of the bytes that a response holds, which must agree with its
    header, and of the headers that a revisit carries. ``payloads`` adds the bytes (null for a revisit).
    """
    ranges = files.select(
        "path", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(split_bytes).cast("bigint"))).alias("start")
    ).select("path", "start", F.least(F.col("start") + split_bytes, "size").alias("stop"))
    ranges = ranges.repartition(max(1, ranges.count()))  # about a range a task, however small the table of ranges
    names = [c.split()[0] for c in RECORDS.split(", ")] + ["payload"] * payloads

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        rows, held = [], 0
        for batch in batches:
            for path, start, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, name = FileSystem.from_uri(path)
                with system.open_input_file(name) as handle:
                    for at, record in records_in(io.BufferedReader(handle, _AHEAD), start, stop):
                        row = _page_row(record)
                        if row is None:
                            continue
                        rows.append((path, at, *row[: None if payloads else -1]))
                        held += len(record.block) if payloads else 1024
                        if held >= BATCH_BYTES:
                            yield _batch(rows, names)
                            rows, held = [], 0
        if rows:
            yield _batch(rows, names)

    schema = RECORDS + ", payload binary" * payloads
    return map_arrow(ranges, ["path", "start", "stop"], run, schema)


def _page_row(record: Record) -> tuple | None:
    """Values of a response or revisit after its place; None for records of other kinds."""
    fields = record.fields
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    head, _, payload = record.block.partition(b"\r\n\r\n")
    length = int(parse_fields(head).get("content-length", -1))
    told = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and (len(payload), digest(payload)) != (length, told):
        raise ValueError(f"{fields.get('warc-record-id')}: payload differs from its header")
    return (
        _page_of(fields.get("warc-record-id")),
        fields.get("warc-target-uri"),
        kind,
        _page_of(fields.get("warc-refers-to")),
        length,
        told,
        payload if kind == "response" else None,
    )


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)]
    return pa.RecordBatch.from_arrays(columns, names)


def round_trip(df: DataFrame, id_column: str, url_column: str, text_column: str, least_bytes: int = 0) -> DataFrame:
    """Writes all rows to archives and reads them back; every record written must be found."""
    folder = fresh_path(df.sparkSession, "warc")
    files = write_archives(df, id_column, url_column, text_column, folder, least_bytes)
    found = materialise(read_archives(files), "warc-records")
    written = files.agg(F.sum("records")).first()[0] or 0
    if found.count() != written:
        raise RuntimeError(f"{written} records were written to {folder}, not as many were found")
    return found
