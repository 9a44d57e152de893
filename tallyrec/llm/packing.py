"""Packing along a space-filling curve.

A document becomes a vector of hashed token counts, projected to a few dimensions;
its cell there has a place on a Hilbert curve. Documents are range-sorted by that
place, so that neighbours on the curve stand next to each other, and are laid end to
end; every ``length`` tokens a sequence is full and the document at hand is cut. Only
the last sequence is shorter, so no more than ``length - 1`` places are ever padded.

The sort moves small rows (place, id, length). Each range partition numbers its
tokens from 0; what comes before a partition is the sum of the totals before it, one
number per partition.

Defined results: a null or empty text is the end id alone; repeated rows are packed
once each; documents with equal vectors are ordered by id, so copies stand together
and a large group of them spreads over several partitions; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.batches import arrow_rows, map_arrow, text_groups
from tallyrec.llm.word_ids import word_ids
from tallyrec.sources.stage import materialise

SLOTS = 256
DIMENSIONS = 4
BITS = 10
#: Rows of documents handed to Python at once, and characters whose words are looked up together.
DOCS_AT_ONCE = 2000
LOOK_UP = 2 << 20

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell coordinates below ``2**bits``."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    level = 1 << (bits - 1)
    # undo the turns of the curve from the coarsest level down
    while level > 1:
        low = level - 1
        for i in range(n):
            high = (x[i] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn ^= np.where(x[n - 1] & level, level - 1, 0)
        level >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> bit & 1)
    return key


class CurvePlace:
    """Fixed hashing and projection from token ids to a place on the curve."""

    def __init__(self, vocabulary: int, seed: int = 17) -> None:
        rng = np.random.default_rng(seed)
        self.slot = rng.integers(0, SLOTS, vocabulary)
        self.axes = rng.standard_normal((SLOTS, DIMENSIONS))

    def __call__(self, documents: list[np.ndarray]) -> np.ndarray:
        counts = np.stack(
            [np.bincount(self.slot[ids], minlength=SLOTS) for ids in documents]
        ).astype(np.float64)
        size = np.sqrt((counts**2).sum(axis=1, keepdims=True))
        spread = counts / np.maximum(size, 1) @ self.axes  # about normal, of deviation 1
        cells = (1 / (1 + np.exp(-1.7 * spread)) * (1 << BITS)).astype(np.int64)
        return hilbert_key(np.minimum(cells, (1 << BITS) - 1), BITS)


def tokenised(df: DataFrame, id_column: str, text_column: str, path: str, end_id: int) -> DataFrame:
    """Per row: row (unique), doc_id, place, n and ids (bytes), the end id included."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(path)
        place = CurvePlace(encoder.size)
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        width = np.dtype(encoder.dtype).itemsize
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for start, texts in text_groups(batch, 1, LOOK_UP):
                ids = [x + end for x in encoder.encode(texts)]
                places = place([np.frombuffer(x, encoder.dtype) for x in ids])
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(row, row + n), pa.int64()),
                        batch.column(0).slice(start, n).cast(pa.int64()),
                        pa.array(places, pa.int64()),
                        pa.array([len(x) // width for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["row", "doc_id", "place", "n", "ids"],
                )
                row += n

    return map_arrow(
        df, [id_column, text_column], run, "row bigint, doc_id bigint, place bigint, n bigint, ids binary"
    )


def running_start(df: DataFrame, order: list[str], size: str, name: str) -> DataFrame:
    """``df`` with ``first``: the sum of ``size`` over all rows before, in the total order given.

    ``df`` must come from a stored table, since a range sort reads it twice.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    at = ordered.columns.index(size)
    schema = ", ".join(f"`{c}` {t}" for c, t in ordered.dtypes) + ", part bigint, within bigint"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column(at).to_numpy(zero_copy_only=False)
            ends = before + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(np.full(len(sizes), part), pa.int64()),
                    pa.array(ends - sizes, pa.int64()),
                ],
                [*batch.schema.names, "part", "within"],
            )
            if len(ends):
                before = int(ends[-1])

    numbered = materialise(ordered.mapInArrow(run, schema), name)
    # one row per partition: its size is the number of partitions, not of documents
    totals = numbered.groupBy("part").agg(F.max(F.col("within") + F.col(size)).alias("total"))
    found = sorted((r["part"], r["total"]) for r in totals.collect())
    starts, total = [], 0
    for part, add in found:
        starts.append((part, total))
        total += add
    base = spark.createDataFrame(starts, "part bigint, base bigint")
    return numbered.join(F.broadcast(base), "part").select(
        *df.columns, (F.col("base") + F.col("within")).alias("first")
    )


def pack(
    df: DataFrame, id_column: str, text_column: str, path: str, end_id: int, length: int = 4096
) -> DataFrame:
    """Pieces of documents with their sequence and place in it, and the piece's ids."""
    with arrow_rows(df.sparkSession, DOCS_AT_ONCE):
        documents = materialise(tokenised(df, id_column, text_column, path, end_id), "pack-ids")
    placed = running_start(
        documents.select("place", "doc_id", "row", "n"), ["place", "doc_id", "row"], "n", "pack-order"
    )
    rows = documents.select("row", "doc_id", "ids").join(placed.select("row", "first"), "row")
    return _cut(rows, path, length)


def _cut(rows: DataFrame, path: str, length: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = word_ids(path).dtype
        for batch in batches:
            columns: list[list] = [[] for _ in range(8)]
            for k in range(batch.num_rows):
                doc, first = batch.column(0)[k].as_py(), batch.column(2)[k].as_py()
                ids = np.frombuffer(batch.column(1)[k].as_py(), dtype)
                start = 0
                while start < len(ids):
                    sequence, offset = divmod(first + start, length)
                    piece = ids[start : start + length - offset].astype("<u4").tobytes()
                    n = len(piece) // 4
                    values = (doc, start, n, zlib.crc32(piece), len(ids), sequence, offset, piece)
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
                    start += n
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:7]), pa.array(columns[7], pa.binary())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return map_arrow(rows, ["doc_id", "ids", "first"], run, f"{PIECES}, ids binary")
