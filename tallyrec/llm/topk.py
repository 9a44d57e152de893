"""Exact top-k inner products by columnar branch and bound.

Candidates are stored in blocks, dimension after dimension (vertical layout), with the
norm of what each candidate has left after every group of dimensions. A query adds up
products group by group; after each group a candidate's score can grow by at most the
product of both remaining norms, and is at least its sum less that product. The k-th best
of the lower bounds, and of the scores found in earlier blocks, is a threshold; candidates
whose upper bound is below it are dropped and the survivors are compacted.

Queries meet candidates block by block: each candidate block is sent once to every query
block, and a task keeps k entries per query over all blocks it sees. Work is dealt out by query
block and slice of the candidate blocks, so few queries against many vectors are many tasks too.

Vectors are turned to integers first, floor(scale * x); scores are exact integers.

Defined results: vectors that are null, empty, or hold null or non-finite components take
no part; vectors of different lengths have no score; a candidate with the query's own id
is left out; equal scores go to the smaller id; repeated rows are candidates each; of
several rows with one query id the smallest vector asks; scores beyond 64 bits are cut to
the range; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrec.llm.batches import arrow_rows, map_arrow
from tallyrec.llm.cosine import usable
from tallyrec.sources.stage import materialise

BLOCK = 4096
QUERIES = 256
GROUP = 8
#: Blocks handed to Python at once, and the most candidate blocks of a cell.
BLOCKS_AT_ONCE = 4
CELL_BLOCKS = 256
_EXACT = 2.0**52
_LONG = 2.0**63


def integers(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x): 64-bit integers, or Python integers where those are too small."""
    y = np.floor(scale * x)
    if np.abs(y).max(initial=0) < 2.0**62:
        return y.astype(np.int64)
    return np.array([int(v) for v in y], dtype=object)


def _rest(columns: np.ndarray) -> np.ndarray:
    """(groups + 1) x candidates: norms of what is left after each group, rounded up."""
    squares = columns.astype(np.float64) ** 2
    starts = range(0, len(columns), GROUP)
    tail = np.array([squares[g:].sum(axis=0) for g in starts] + [np.zeros(columns.shape[1])])
    return np.sqrt(tail) * (1 + 1e-9)


def best_of_block(
    query: np.ndarray,
    query_rest: np.ndarray,
    columns: np.ndarray,
    rest: np.ndarray,
    skip: np.ndarray,
    k: int,
    floor: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Candidates that can be among the k best and score ``floor`` or more, with their scores.

    ``skip`` marks candidates that are the query itself.
    """
    alive = np.flatnonzero(~skip)
    exact = query_rest[0] * rest[0].max(initial=0) < _EXACT
    kind = np.float64 if exact else object
    score = np.zeros(len(alive), dtype=kind)
    query = query.astype(kind)
    for g, start in enumerate(range(0, len(query), GROUP)):
        stop = start + GROUP
        part = columns[start:stop]
        part = part if len(alive) == part.shape[1] else part[:, alive]
        score = score + query[start:stop] @ part.astype(kind)
        slack = (query_rest[g + 1] * rest[g + 1][alive]) * (1 + 1e-9)
        if len(alive) > k:
            sure = np.clip(np.asarray(score - slack, dtype=np.float64), -_LONG, _LONG)
            floor = max(floor, np.partition(sure, len(sure) - k)[len(sure) - k])
        able = np.clip(np.asarray(score + slack, dtype=np.float64), -_LONG, _LONG)
        keep = able >= floor - abs(floor) * 1e-9
        if not keep.all():
            alive, score = alive[keep], score[keep]
    return alive, score


def _vector_rows(df: DataFrame, id_column: str, vector_column: str, scale: float) -> DataFrame:
    """Blocks of vectors of one length: ids, columns (bytes or decimal texts), length."""

    def pack(width: int, ids: list[int], vectors: list[np.ndarray]) -> pa.RecordBatch:
        columns = np.stack(vectors).T
        small = columns.dtype != object and np.abs(columns).max(initial=0) < 2**31
        kind = "i4" if small else "i8" if columns.dtype != object else "text"
        data = (
            ",".join(map(str, columns.ravel())).encode()
            if kind == "text"
            else np.ascontiguousarray(columns).astype(f"<{kind}").tobytes()
        )
        return pa.RecordBatch.from_arrays(
            [
                pa.array([width], pa.int64()),
                pa.array([np.array(ids, dtype="<i8").tobytes()], pa.binary()),
                pa.array([kind], pa.string()),
                pa.array([data], pa.binary()),
            ],
            ["width", "ids", "kind", "data"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, tuple[list[int], list[np.ndarray]]] = {}
        for batch in batches:
            for doc, x in zip(batch.column(0).to_pylist(), usable(batch.column(1)), strict=True):
                if x is None or doc is None:
                    continue
                ids, vectors = open_.setdefault(len(x), ([], []))
                ids.append(doc)
                vectors.append(integers(x, scale))
                if len(ids) >= BLOCK:
                    yield pack(len(x), *open_.pop(len(x)))
        for width, (ids, vectors) in open_.items():
            yield pack(width, ids, vectors)

    schema = "width bigint, ids binary, kind string, data binary"
    return map_arrow(df, [id_column, vector_column], run, schema)


def _columns(kind: str, data: bytes, width: int) -> np.ndarray:
    if kind == "text":
        return np.array([int(x) for x in data.split(b",")], dtype=object).reshape(width, -1)
    return np.frombuffer(data, f"<{kind}").reshape(width, -1)


def _met(candidates: DataFrame, asks: DataFrame, blocks: int) -> DataFrame:
    """Every query block with every candidate block, dealt out by query block and slice of the candidates.

    A cell is one query block and some candidate blocks: two where there are few pairs of blocks, up to
    ``CELL_BLOCKS`` where there are many. A task has a cell or a few.
    """
    spark = candidates.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = 4 * max(width, spark.sparkContext.defaultParallelism)
    n = max(1, candidates.count())
    blocks_a_cell = min(CELL_BLOCKS, max(2, n * blocks // slots))
    slices = -(-n // blocks_a_cell)
    tasks = min(blocks * slices, slots)
    part = F.pmod(F.xxhash64("ids"), F.lit(slices))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slices - 1).cast("bigint")))
    left = candidates.withColumn("slice", part).withColumn("ask", every).repartition(tasks, "ask", "slice")
    right = asks.withColumn("slice", each).repartition(tasks, "ask", "slice")
    return left.join(right, ["ask", "slice"]).select("ask", "queries", "width", "ids", "kind", "data")


def top_products(
    df: DataFrame,
    id_column: str,
    vector_column: str,
    is_query: Column,
    k: int = 5,
    scale: float = 256.0,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the k best candidates of every query."""
    vectors = df.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).alias("v"))
    asking = vectors.where(is_query & F.col("v").isNotNull()).groupBy("id").agg(F.min("v").alias("v"))
    # one number to the driver: how many query blocks there are
    blocks = max(1, -(-asking.count() // QUERIES))
    asks = (
        asking.withColumn("ask", F.pmod(F.xxhash64("id"), F.lit(blocks)))
        .groupBy("ask")
        .agg(F.collect_list(F.struct("id", "v")).alias("queries"))
    )
    candidates = materialise(_vector_rows(vectors, "id", "v", scale), "topk-blocks")
    met = _met(candidates, asks, blocks)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int]]] = {}  # by query: heap of (score, -id)
        asked: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                ask = batch.column(0)[row].as_py()
                if ask not in asked:
                    queries = batch.column(1)[row].as_py()
                    asked[ask] = []
                    array = pa.array([q["v"] for q in queries], pa.list_(pa.float64()))
                    for q, x in zip(queries, usable(array), strict=True):
                        if x is not None:
                            value = integers(x, scale)
                            asked[ask].append((q["id"], value, _rest(value[:, None])[:, 0]))
                width = batch.column(2)[row].as_py()
                ids = np.frombuffer(batch.column(3)[row].as_py(), "<i8")
                columns = _columns(batch.column(4)[row].as_py(), batch.column(5)[row].as_py(), width)
                rest = _rest(columns)
                for query, value, query_rest in asked[ask]:
                    if len(value) != width:
                        continue
                    heap = best.setdefault(query, [])
                    floor = float(heap[0][0]) if len(heap) == k else -np.inf
                    at, scores = best_of_block(value, query_rest, columns, rest, ids == query, k, floor)
                    for one, score in zip(ids[at].tolist(), scores.tolist(), strict=True):
                        entry = (min(max(int(score), -(2**63)), 2**63 - 1), -one)
                        if len(heap) < k:
                            heapq.heappush(heap, entry)
                        elif entry > heap[0]:
                            heapq.heapreplace(heap, entry)
        rows = [
            (query, -one, score)
            for query, heap in best.items()
            for score, one in heap
        ]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["query_id", "vec_id", "score"]
            )

    schema = "query_id bigint, vec_id bigint, score bigint"
    with arrow_rows(df.sparkSession, BLOCKS_AT_ONCE):
        found = materialise(map_arrow(met, met.columns, run, schema), "topk-found")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
