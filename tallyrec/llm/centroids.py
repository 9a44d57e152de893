"""Exact integer k-means, with distances to centroids avoided by a table of pivot distances (LAESA).

A vector x becomes the integers floor(scale * x). A few pivots are fixed once; the distance of
every vector to every pivot is stored once, with the vector, in a stage table. In each round the
driver knows the distances between the k centroids and the pivots, and by the triangle inequality
``|d(x, pivot) - d(centroid, pivot)|`` is a lower bound of ``d(x, centroid)``. A vector is compared
first with the centroid of the least bound; only centroids whose bound does not exceed what that
gave (less a margin for rounding) survive and are compared too, in exact integers. So every
assignment equals that of comparing all centroids.

A round scans the stage table once. Tasks send one row of sums per centroid; those rows are added
up centroid by centroid, and k rows reach the driver. Neither the vectors nor their assignments are
shuffled, and a large cluster is no more than a large sum.

Starts are the ``k`` usable vectors with the smallest sha256 of ``<seed>:<id>``. Pivots are chosen
among the ``PIVOT_SAMPLE`` smallest, one after the other, each as far as possible from those before;
which ones they are changes cost only.

Defined results: vectors that are null, have another number of components, or hold a null or
non-finite one take no part; repeated rows count each and equal ids are ordered by their vector;
rows without id take part and come last in the order of starts; fewer than ``k`` usable vectors give
fewer clusters; ties go to the smaller cluster number; an empty cluster keeps its centroid;
distances, and sums of them, beyond 64 bits are cut to the range; an empty table gives an empty table;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.batches import map_arrow
from tallyrec.sources.stage import materialise

PIVOTS = 8
#: Vectors the driver chooses pivots from.
PIVOT_SAMPLE = 256
_LONG = 2**63 - 1
_MARGIN = 1e-9


def whole(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x), integers held in double precision."""
    return np.floor(scale * np.asarray(x, dtype=np.float64))


def _integers(y: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in y.reshape(-1, y.shape[-1])], dtype=object)


def exact_squares(y: np.ndarray, centroid: list[int]) -> np.ndarray:
    """Squared distances to one centroid: doubles where they are exact, else Python integers."""
    size = max(np.abs(y).max(initial=0), max(map(abs, centroid)))
    if 4.0 * len(centroid) * size**2 < 2.0**53:
        gap = y - np.array(centroid, dtype=np.float64)
        return np.einsum("ij,ij->i", gap, gap)
    gap = _integers(y) - np.array(centroid, dtype=object)
    return (gap * gap).sum(axis=1)


def pivot_distances(y: np.ndarray, pivots: list[list[int]]) -> np.ndarray:
    """Rounded distances, a column per pivot."""
    columns = [np.sqrt(exact_squares(y, p).astype(np.float64)) for p in pivots]
    return np.stack(columns, axis=1) if len(y) else np.empty((0, len(pivots)))


@dataclass(frozen=True)
class Centroids:
    """Centroids of a round, with their distances to the pivots."""

    points: list[list[int]]
    pivots: list[list[int]]

    def nearest(self, y: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per vector: cluster, squared distance (Python integers), number of distances computed."""
        n = len(y)
        own = pivot_distances(np.array(self.points, dtype=object).astype(np.float64), self.pivots)
        bound = np.zeros((n, len(self.points)))
        for p in range(len(self.pivots)):
            far, near = to_pivots[:, p, None], own[None, :, p]
            np.maximum(bound, np.abs(far - near) - _MARGIN * (far + near), out=bound)
        first = bound.argmin(axis=1)
        best = np.zeros(n, dtype=object)
        for c, point in enumerate(self.points):
            rows = np.flatnonzero(first == c)
            if len(rows):
                best[rows] = _as_int(exact_squares(y[rows], point))
        limit = np.sqrt(best.astype(np.float64)) * (1 + _MARGIN)
        alive = bound <= limit[:, None]
        alive[np.arange(n), first] = False
        cluster = first.copy()
        for c, point in enumerate(self.points):
            rows = np.flatnonzero(alive[:, c])
            if not len(rows):
                continue
            found = _as_int(exact_squares(y[rows], point))
            better = (found < best[rows]) | ((found == best[rows]) & (c < cluster[rows]))
            cluster[rows[better]] = c
            best[rows[better]] = found[better]
        return cluster, best, 1 + alive.sum(axis=1)


def _as_int(values: np.ndarray) -> np.ndarray:
    return values if values.dtype == object else values.astype(np.int64).astype(object)


def _vectors(column: pa.Array, width: int, scale: float) -> np.ndarray:
    return whole(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width), scale)


def usable_vectors(df: DataFrame, id_column: str, vector_column: str, width: int) -> DataFrame:
    """vec_id, v of the rows whose vector has ``width`` finite components."""
    vector = F.col(f"`{vector_column}`")
    sound = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return df.where((F.size(vector) == width) & sound).select(
        F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), vector.alias("v")
    )


def choose_pivots(sample: np.ndarray, pivots: int) -> list[list[int]]:
    """Rows far from each other: each as far as possible from those chosen before."""
    if not len(sample):
        return []
    chosen = [int(np.argmax(np.abs(sample - sample.mean(axis=0)).sum(axis=1)))]
    gap = ((sample - sample[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < pivots and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return [row.tolist() for row in _integers(sample[chosen])]


def pivot_table(vectors: DataFrame, pivots: list[list[int]], width: int, scale: float) -> DataFrame:
    """The vectors with their distances to the pivots, stored once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to_pivots = pivot_distances(_vectors(batch.column(1), width, scale), pivots)
            ends = np.arange(0, to_pivots.size + 1, len(pivots), dtype=np.int32)
            table = pa.ListArray.from_arrays(pa.array(ends), pa.array(to_pivots.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, table], ["vec_id", "v", "to_pivots"])

    kind = dict(vectors.dtypes)["v"]
    schema = f"vec_id bigint, v {kind}, to_pivots array<double>"
    return materialise(map_arrow(vectors, ["vec_id", "v"], run, schema), "pivot-table")


def _to_pivots(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def next_centroids(table: DataFrame, now: Centroids, scale: float) -> list[list[int]]:
    """Floors of the means of what each centroid is nearest to; an empty one stays."""
    width = len(now.points[0])

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(width, dtype=object) for _ in now.points]
        count = [0] * len(now.points)
        for batch in batches:
            y = _vectors(batch.column(1), width, scale)
            cluster, _, _ = now.nearest(y, _to_pivots(batch))
            exact = np.abs(y).max(initial=0) * max(1, len(y)) < 2.0**53
            for c in range(len(now.points)):
                rows = y[cluster == c]
                if len(rows):
                    count[c] += len(rows)
                    total[c] = total[c] + (
                        _as_int(rows.sum(axis=0)) if exact else _integers(rows).sum(axis=0)
                    )
        yield _sum_rows((c, count[c], total[c]) for c in range(len(now.points)) if count[c])

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for c, n, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                before, total = merged.get(c, (0, 0))
                merged[c] = before + n, total + np.array([int(x) for x in text.split(",")], dtype=object)
        yield _sum_rows((c, n, total) for c, (n, total) in merged.items())

    schema = "cluster bigint, n bigint, total string"
    sums = map_arrow(table, ["vec_id", "v", "to_pivots"], assign, schema).repartition("cluster")
    points = list(now.points)
    for row in map_arrow(sums, ["cluster", "n", "total"], merge, schema).collect():  # k rows
        points[row["cluster"]] = [int(x) // row["n"] for x in row["total"].split(",")]
    return points


def _sum_rows(rows: Iterable[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([c for c, _, _ in rows], pa.int64()),
            pa.array([n for _, n, _ in rows], pa.int64()),
            pa.array([",".join(map(str, total)) for _, _, total in rows], pa.string()),
        ],
        ["cluster", "n", "total"],
    )


def assign_all(table: DataFrame, now: Centroids, scale: float) -> DataFrame:
    """vec_id, cluster, distance (squared), n_exact (distances computed) of every vector."""
    width = len(now.points[0])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _vectors(batch.column(1), width, scale)
            cluster, best, computed = now.nearest(y, _to_pivots(batch))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(cluster, pa.int32()),
                    pa.array([min(d, _LONG) for d in best.tolist()], pa.int64()),
                    pa.array(computed, pa.int32()),
                ],
                ["vec_id", "cluster", "distance", "n_exact"],
            )

    schema = "vec_id bigint, cluster int, distance bigint, n_exact int"
    return map_arrow(table, ["vec_id", "v", "to_pivots"], run, schema)


CLUSTERS = (
    "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
    "centroid_sha256 string, n_exact int"
)


def cluster_vectors(
    df: DataFrame,
    id_column: str,
    vector_column: str,
    k: int = 16,
    rounds: int = 3,
    width: int = 64,
    scale: float = 64.0,
    seed: str = "1",
    pivots: int = PIVOTS,
) -> DataFrame:
    """Cluster, squared distance and inertias of every usable vector after ``rounds`` rounds."""
    spark = df.sparkSession
    vectors = usable_vectors(df, id_column, vector_column, width)
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = (
        vectors.orderBy(place.asc_nulls_last(), F.col("v")).limit(max(k, PIVOT_SAMPLE)).collect()
    )  # bounded by its limit
    if not first:
        return spark.createDataFrame([], CLUSTERS)
    sample = whole(np.array([row["v"] for row in first]), scale)
    fixed = choose_pivots(sample[:PIVOT_SAMPLE], pivots)
    now = Centroids([row.tolist() for row in _integers(sample[:k])], fixed)
    table = pivot_table(vectors, fixed, width, scale)
    for _ in range(rounds):
        now = Centroids(next_centroids(table, now, scale), fixed)
    found = materialise(assign_all(table, now, scale), "clusters")
    sums = {  # k rows
        row["cluster"]: int(row["total"])
        for row in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    }
    inertia = min(sum(sums.values()), _LONG)
    facts = [
        (c, min(total, _LONG), inertia, hashlib.sha256(",".join(map(str, now.points[c])).encode()).hexdigest())
        for c, total in sums.items()
    ]
    names = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    return found.join(F.broadcast(spark.createDataFrame(facts, names)), "cluster").select(
        *(c.split()[0] for c in CLUSTERS.split(", "))
    )
