"""Top-k inner-product search over factor vectors, exact and by hashing.

Spark pairs blocks of queries with blocks of items by an equi-join on the block
numbers; a task multiplies two blocks and returns only the best ``k`` items of
each query, so no plan ever holds the pairs themselves.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrec.config import SearchParams
from tallyrec.functions import blocks
from tallyrec.operators.ranking import top_per_group
from tallyrec.schemas import require_columns
from tallyrec.sources.stage import materialise

# Vectors per block, which is what one task holds of either side: 25 MB at 64
# dimensions. Each side is sent once per block of the other, and each query
# returns k rows per item block, so larger blocks shuffle less.
BLOCK_ROWS = 100_000
# Of short vectors a block holds more: lists that one task finds whole are not sent to be merged.
BLOCK_NUMBERS = 8_000_000
MOST_ROWS = 1_000_000
# Rows one task returns: 24 bytes each, held a few times while they are put together.
FOUND_ROWS = 10_000_000
SCORED = blocks.SCORED
_TASKS_PER_CORE = 4
_CELLS_PER_TASK = 4
_MIN_QUERIES = 500  # fewer queries per task than this are not worth a task

# Executors get the block arithmetic with the task; they need no copy of the package.
cloudpickle.register_pickle_by_value(blocks)


def exact_topk(
    queries: DataFrame, items: DataFrame, k: int, block_rows: int | None = None
) -> DataFrame:
    """(query_id, rank, item_id, score) of the ``k`` largest inner products per query.

    A column ``seen`` of the queries holds item ids to leave out before the cut at
    ``k``. A vector that is null or empty, holds a null or non-finite number, or has
    another length than the first item fails the query.

    Scores every pair, so the work grows with queries x items: this is the truth
    that :func:`lsh_topk` is judged against, not the way to search a large table.
    """
    if block_rows is None:
        first = items.select(F.size("features").alias("n")).where("n > 0").first()
        block_rows = max(BLOCK_ROWS, min(MOST_ROWS, BLOCK_NUMBERS // (first["n"] if first else 1)))
    return paired_lists(*checked_sides(queries, items), k, block_rows, blocks.scorer(k), cut_items=True)


def paired_lists(
    queries: DataFrame, items: DataFrame, k: int, block_rows: int, function: Callable, cut_items: bool = False
) -> DataFrame:
    """(query_id, rank, item_id, score): the best ``k`` of what ``function`` finds in all pairs of blocks.

    If the items are one block, a task finds whole lists and ranks them: rows of equal ids are in one block.
    """
    q, i, q_parts, i_parts = paired_blocks(queries, items, k, block_rows, cut_items)
    if i_parts > 1:
        return best_lists(search_blocks(q, i, ["_q", "_i"], function, q_parts * i_parts), k)
    ranked = search_blocks(q, i, ["_q", "_i"], blocks.ranker(function, k), q_parts, blocks.RANKED)
    return ranked.select("query_id", "rank", "item_id", "score")


def paired_blocks(
    queries: DataFrame, items: DataFrame, k: int, block_rows: int, cut_items: bool = False
) -> tuple[DataFrame, DataFrame, int, int]:
    """Every block of the queries and every block of the items once for each of the other side, and how many there are."""
    n_queries, n_items = queries.count(), items.count()
    q_parts, i_parts = block_counts(n_queries, n_items, k, block_rows, task_slots(queries), cut_items)
    q = queries.select(
        "query_id", "features", *(["seen"] if "seen" in queries.columns else []),
        number_part("query_id", F.lit(q_parts)).alias("_q"),
        _each(F.lit(i_parts)).alias("_i"),
    )
    i = items.select(
        "item_id", "features", number_part("item_id", F.lit(i_parts)).alias("_i"),
        _each(F.lit(q_parts)).alias("_q"),
    )
    return q, i, q_parts, i_parts


def block_counts(
    n_queries: int, n_items: int, k: int, block_rows: int, slots: int, cut_items: bool = False
) -> tuple[int, int]:
    """Blocks of the queries and of the items. Small searches still use every core: more blocks than memory asks for.

    Cutting the queries alone sends all items once per core; with ``cut_items`` both sides are cut so that least is
    sent, where the rows a query returns count as ``k`` / 4 vectors for every block of items: one block gives whole lists.
    """
    q_least, i_least = query_blocks(n_queries, k, block_rows), max(1, math.ceil(n_items / block_rows))
    wanted = min(slots, math.ceil(n_queries / _MIN_QUERIES) * i_least)
    choices = []
    for i_parts in range(i_least, max(i_least, wanted if cut_items else 0) + 1):
        q_parts = max(q_least, math.ceil(wanted / i_parts))
        returned = n_queries * i_parts * k / 4 if i_parts > 1 else 0
        choices.append((n_items * q_parts + n_queries * i_parts + returned, i_parts, q_parts))
    _, i_parts, q_parts = min(choices)
    return q_parts, i_parts


def query_blocks(n_queries: int, k: int, block_rows: int) -> int:
    """Blocks of the queries, so that neither a block nor what its task finds is large."""
    return max(1, math.ceil(n_queries / max(1, min(block_rows, FOUND_ROWS // max(1, k)))))


def lsh_topk(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    params: SearchParams = SearchParams(),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Like :func:`exact_topk`, comparing a query only to items that share a bucket."""
    return search_buckets(*hash_vectors(queries, items, params), k, block_rows)


def search_buckets(
    q: DataFrame, i: DataFrame, k: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(query_id, rank, item_id, score) from both sides of :func:`hash_vectors`.

    A bucket with more than ``block_rows`` vectors on a side is scored block by
    block in separate tasks. A query with fewer than ``k`` candidates gets a
    shorter list.
    """
    # fewer than two for every block_rows rows, so every task is told and no vector is shuffled to learn it
    hot = F.broadcast(_hot_buckets(q, i, block_rows))
    bucket = ["table", "bucket"]
    q_parts, i_parts = (F.coalesce(c, F.lit(1)) for c in ("_q_parts", "_i_parts"))
    q = q.join(hot, bucket, "left").select(
        *bucket, "query_id", "features", number_part("query_id", q_parts).alias("_q"),
        _each(i_parts).alias("_i"),
    )
    i = i.join(hot, bucket, "left").select(
        *bucket, "item_id", "features", number_part("item_id", i_parts).alias("_i"),
        _each(q_parts).alias("_q"),
    )
    scored = score_blocks(q, i, [*bucket, "_q", "_i"], k, task_slots(q))
    # the same pair can meet in several tables; one shuffle serves the grouping and the lists
    scored = scored.repartition("query_id")
    return best_lists(scored.groupBy("query_id", "item_id").agg(F.max("score").alias("score")), k)


def hash_vectors(
    queries: DataFrame, items: DataFrame, params: SearchParams
) -> tuple[DataFrame, DataFrame]:
    """Both sides with one row per hash table and the vector's ``bucket`` in it; stored with one row per vector.

    One extra coordinate lifts every item to the same norm and is 0 in queries,
    so that the nearest items of a query are those with the largest product.
    """
    queries, items = checked_sides(queries, items)
    norm2 = F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    longest = items.agg(F.max(F.sqrt(norm2))).first()[0]
    scale = F.lit(longest or 1.0)
    q_scale = F.when(norm2 > 0, F.sqrt(norm2)).otherwise(1.0)
    lifted_q = queries.withColumn("_v", _lifted(q_scale, F.lit(0.0)))
    lifted_i = items.withColumn(
        "_v", _lifted(scale, F.sqrt(F.greatest(F.lit(0.0), 1.0 - norm2 / (scale * scale))))
    )
    lsh = BucketedRandomProjectionLSH(
        inputCol="_v",
        outputCol="_hashes",
        bucketLength=params.width,
        numHashTables=params.tables * params.hashes,
        seed=params.seed,
    ).fit(lifted_i)
    q = materialise(_bucketed(lsh.transform(lifted_q), "query_id", params), "hashed-queries")
    i = materialise(_bucketed(lsh.transform(lifted_i), "item_id", params), "hashed-items")
    per_table = F.posexplode("buckets").alias("table", "bucket")
    return q.select("query_id", "features", per_table), i.select("item_id", "features", per_table)


def scored_share(q: DataFrame, i: DataFrame, n_queries: int, n_items: int) -> DataFrame:
    """Pairs scored by :func:`search_buckets` over all pairs, from the bucket sizes alone.

    A pair that meets in several tables is scored, and counted, each time. A row stands for as many vectors as
    its column ``n`` says, if there is one.
    """
    bucket = ["table", "bucket"]
    qs, is_ = (
        side.groupBy(*bucket).agg((F.sum("n") if "n" in side.columns else F.count(F.lit(1))).alias(name))
        for side, name in ((q, "_nq"), (i, "_ni"))
    )
    pairs = F.coalesce(F.sum(F.col("_nq") * F.col("_ni")), F.lit(0))
    return qs.join(is_, bucket).agg(
        (pairs / F.lit(float(n_queries) * n_items)).alias("scored_share")
    )


def recall_of(exact: DataFrame, found: DataFrame) -> DataFrame:
    """Share of the exact lists' items that the approximate lists hold."""
    hit = found.select("query_id", "item_id", F.lit(1).alias("_hit"))
    return exact.join(hit, ["query_id", "item_id"], "left").agg(
        (F.count("_hit") / F.count(F.lit(1))).alias("recall")
    )


def checked_sides(queries: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with vectors that are whole, finite and of one length, or an error."""
    require_columns(queries, ["query_id", "features"], "search: queries")
    require_columns(items, ["item_id", "features"], "search: items")
    first = items.select(F.size("features").alias("n")).where("n > 0").first()
    if first is None:
        return _sound(queries, None), _sound(items, None)
    return _sound(queries, first["n"]), _sound(items, first["n"])


def _sound(side: DataFrame, length: int | None) -> DataFrame:
    kind = side.schema["features"].dataType
    whole = F.forall(
        "features", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    sized = F.size("features") == length if length else F.size("features") > 0
    error = F.raise_error(F.lit("search: a vector is null, ragged or not finite")).cast(kind)
    return side.withColumn(
        "features", F.when(F.coalesce(whole & sized, F.lit(False)), F.col("features")).otherwise(error)
    )


def number_part(key: str, parts: Column) -> Column:
    return F.pmod(F.xxhash64(key), parts.cast("bigint"))


def _each(parts: Column) -> Column:
    """One row per block number of the other side."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), parts.cast("bigint") - 1))


def _lifted(scale: Column, extra: Column) -> Column:
    scaled = F.transform("features", lambda x: x.cast("double") / scale)
    return array_to_vector(F.concat(scaled, F.array(extra)))


def _bucketed(hashed: DataFrame, key: str, params: SearchParams) -> DataFrame:
    cells = [
        vector_to_array(F.col("_hashes")[j])[0].cast("bigint")
        for j in range(params.tables * params.hashes)
    ]
    buckets = F.array(
        *[
            F.xxhash64(*cells[t * params.hashes : (t + 1) * params.hashes])
            for t in range(params.tables)
        ]
    )
    return hashed.select(key, "features", buckets.alias("buckets"))


def _hot_buckets(q: DataFrame, i: DataFrame, block_rows: int) -> DataFrame:
    """Buckets too large for one block, with their block counts per side."""

    def large(side: DataFrame, name: str) -> DataFrame:
        parts = F.ceil(F.count(F.lit(1)) / F.lit(block_rows))
        return side.groupBy("table", "bucket").agg(parts.alias(name)).where(F.col(name) > 1)

    return large(q, "_q_parts").join(large(i, "_i_parts"), ["table", "bucket"], "full")


def task_slots(df: DataFrame) -> int:
    """Tasks worth having: by the cores seen now, or the session's shuffle width if larger.

    With dynamic allocation few cores may be up when the plan is built.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(_TASKS_PER_CORE * cores, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def score_blocks(q: DataFrame, i: DataFrame, cell: list[str], k: int, cells: int) -> DataFrame:
    """The best ``k`` items of every query within each cell.

    The number of tasks is fixed because their work is in the products, not in
    the bytes that adaptive execution would merge small partitions by.
    """
    return search_blocks(q, i, cell, blocks.scorer(k), cells)


def search_blocks(
    q: DataFrame, i: DataFrame, cell: list[str], function: Callable, cells: int, kind: str = blocks.SCORED
) -> DataFrame:
    """``function`` of both sides' rows of every cell: rows of ``kind``."""
    tasks = min(cells, max(task_slots(q), math.ceil(cells / _CELLS_PER_TASK)))
    sides = [side.repartition(tasks, *cell).groupBy(*cell) for side in (q, i)]
    return sides[0].cogroup(sides[1]).applyInArrow(function, kind)


def best_lists(scored: DataFrame, k: int) -> DataFrame:
    ranked = top_per_group(scored, ["query_id"], [F.desc("score"), F.asc("item_id")], k)
    return ranked.select("query_id", "rank", "item_id", "score")
