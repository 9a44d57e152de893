"""Near-duplicate vectors by cross-polytope hashing.

A unit vector is turned by pseudo-random rotations (three rounds of random signs and a
fast Walsh-Hadamard transform); its hash is the axis it lies nearest to, with sign. Two
such hashes name a bucket of a table; several tables and, in each, the runner-up axes
(multiprobe) give each vector a handful of buckets. Vectors of one bucket and label are
candidates and are verified by their cosine in double precision.

Equal vectors of a label are one class and are hashed once. A bucket is cut into blocks,
and every pair of blocks is one task's matrix product, so a crowded bucket spreads over
many tasks. Of a pair that meets in several buckets only the first counts. A block pair
sends on sums of links per class and, for components, one link per class and component
found in it, never the list of pairs.

Defined results: vectors that are null, zero, or hold null or non-finite components, and
vectors without a label, link with nothing and are their own component; vectors of
different lengths do not link; repeated rows are kept and are copies of each other
(one row per row; ids should be unique); an empty table gives an empty table; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.batches import arrow_rows, map_arrow
from tallyrec.operators.components import components
from tallyrec.sources.stage import materialise

TABLES = 5
#: Buckets per table and vector: the nearest axes and the next best combinations.
PROBES = 2
#: Members of a block, and block pairs handed to Python at once.
BLOCK = 256
CELLS_AT_ONCE = 64


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, half = x.shape[1], 1
    x = x.copy()
    while half < n:
        y = x.reshape(len(x), n // (2 * half), 2, half)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return x / np.sqrt(n)


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], x.shape[1]))
    return x


def bucket_codes(unit: np.ndarray, tables: int, probes: int) -> np.ndarray:
    """(vectors x tables x probes) bucket numbers, the base bucket first."""
    n, d = unit.shape
    wide = np.zeros((n, max(2, 1 << (d - 1).bit_length())))
    wide[:, :d] = unit
    width = wide.shape[1]
    out = np.empty((n, tables, probes), dtype=np.int64)
    line = np.arange(n)[:, None]
    take = min(3, width)
    for t in range(tables):
        axes, loss = [], []
        for h in range(2):
            turned = rotate(wide, 1000 * t + h)
            best = np.argpartition(-np.abs(turned), take - 1, axis=1)[:, :take]
            size = np.abs(turned)[line, best]
            order = np.argsort(-size, axis=1)
            best, size = best[line, order], size[line, order]
            axes.append(2 * best + (turned[line, best] < 0))
            loss.append(size[:, :1] - size)
        # combinations of both hashes by what they lose against the nearest axes
        total = (loss[0][:, :, None] + loss[1][:, None, :]).reshape(n, -1)
        code = (axes[0][:, :, None] * (2 * width) + axes[1][:, None, :]).reshape(n, -1)
        count = min(probes, code.shape[1])
        pick = np.argsort(total, axis=1, kind="stable")[:, :count]
        out[:, t, :count] = code[line, pick]
        out[:, t, count:] = -1 - np.arange(probes - count)  # too few axes: no more buckets
    return out


def usable(vectors: pa.Array) -> list[np.ndarray | None]:
    """Vectors in double precision; None for those that take no part."""
    out: list[np.ndarray | None] = []
    for v in vectors:
        values = v.as_py()
        if not values or any(x is None for x in values):
            out.append(None)
            continue
        x = np.array(values, dtype=np.float64)
        out.append(x if np.isfinite(x).all() else None)
    return out


def pack_vector(x: np.ndarray) -> bytes:
    """Single precision if that keeps the values, else double."""
    with np.errstate(over="ignore"):
        small = x.astype("<f4")
    return b"f" + small.tobytes() if (small == x).all() else b"d" + x.astype("<f8").tobytes()


def unpack_unit(data: bytes) -> np.ndarray:
    """The vector scaled to length 1, in double precision."""
    x = np.frombuffer(data, "<f4" if data[:1] == b"f" else "<f8", offset=1).astype(np.float64)
    return _unit(x)


def _unit(x: np.ndarray) -> np.ndarray | None:
    """Scaled to length 1 without overflow; None for zero."""
    top = np.abs(x).max()
    if top == 0:
        return None
    x = x / top
    return x / np.sqrt((x * x).sum())


def classes_of(df: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """Per row: vec_id, label, unit (packed vector; null: takes no part), print (of label and vector)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(2).cast(pa.string())
            units, prints = [], []
            for x, label in zip(usable(batch.column(1)), labels.to_pylist(), strict=True):
                u = None if x is None or label is None or not x.any() else pack_vector(x + 0.0)
                units.append(u)
                prints.append(
                    None if u is None else hashlib.blake2b(f"{label} ".encode() + u, digest_size=16).digest()
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    labels,
                    pa.array(units, pa.binary()),
                    pa.array(prints, pa.binary()),
                ],
                ["vec_id", "label", "unit", "print"],
            )

    return map_arrow(
        df,
        [id_column, vector_column, label_column],
        run,
        "vec_id bigint, label string, unit binary, print binary",
    )


def _bucket_rows(classes: DataFrame, tables: int, probes: int) -> DataFrame:
    """One row per class, table and bucket, with all bucket numbers of the class."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [unpack_unit(u.as_py()) for u in batch.column(2)]
            widths = np.array([len(u) for u in units], dtype=np.int64)
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                for part in np.array_split(at, max(1, len(at) // 1000)):
                    codes = bucket_codes(np.stack([units[k] for k in part]), tables, probes)
                    n = len(part)
                    each = tables * probes
                    flat = codes.reshape(n, each)
                    rows = pa.array(np.repeat(part, each))
                    own = pa.array([c.astype("<i4").tobytes() for c in flat], pa.binary())
                    keep = pa.array(flat.ravel() >= 0)
                    table = pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(rows),
                            batch.column(1).take(rows),
                            batch.column(2).take(rows),
                            batch.column(3).take(rows),
                            pa.array(np.full(n * each, width)),
                            pa.array(np.tile(np.repeat(np.arange(tables), probes), n)),
                            pa.array(flat.ravel()),
                            own.take(pa.array(np.repeat(np.arange(n), each))),
                        ],
                        ["doc", "label", "unit", "m", "width", "slot", "bucket", "codes"],
                    )
                    yield table.filter(keep)

    return map_arrow(
        classes,
        ["doc", "label", "unit", "m"],
        run,
        "doc bigint, label string, unit binary, m bigint, width bigint, slot bigint, bucket bigint, codes binary",
    )


def _first_meeting(a: np.ndarray, b: np.ndarray, slot: int, bucket: int, probes: int) -> np.ndarray:
    """Whether each pair of rows of bucket numbers meets in no earlier bucket than this one."""
    first = np.ones(len(a), dtype=bool)
    for t in range(slot + 1):
        x, y = a[:, t * probes : (t + 1) * probes], b[:, t * probes : (t + 1) * probes]
        for k in range(probes):
            met = (x[:, k : k + 1] == y).any(axis=1) & (x[:, k] >= 0)
            if t == slot:
                met &= x[:, k] < bucket
            first &= ~met
    return first


def _block_links(cells: DataFrame, least: float, probes: int) -> DataFrame:
    """Sums of links and spanning links of each pair of blocks."""

    def side(members: pa.Scalar) -> tuple[np.ndarray, ...]:
        m = members.values
        return (
            np.stack([unpack_unit(u) for u in m.field("unit").to_pylist()]),
            m.field("doc").to_numpy(zero_copy_only=False),
            m.field("m").to_numpy(zero_copy_only=False),
            np.stack([np.frombuffer(c, "<i4") for c in m.field("codes").to_pylist()]),
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                slot, bucket, same = (batch.column(c)[k].as_py() for c in range(3))
                left = side(batch.column(3)[k])
                right = left if same else side(batch.column(4)[k])
                i, j = np.nonzero(left[0] @ right[0].T >= least)
                ids, sizes, codes = zip(left[1:], right[1:], strict=True)
                if same:
                    keep = ids[0][i] < ids[1][j]
                    i, j = i[keep], j[keep]
                keep = [
                    _first_meeting(codes[0][i[at : at + 65536]], codes[1][j[at : at + 65536]], slot, bucket, probes)
                    for at in range(0, len(i), 65536)
                ]
                keep = np.concatenate(keep) if keep else np.empty(0, dtype=bool)
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                a, b = ids[0][i], ids[1][j]
                nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
                weight = np.concatenate([sizes[1][j], sizes[0][i]])
                sums = np.bincount(at, weights=weight, minlength=len(nodes)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(nodes),
                        pa.array(sums),
                        pa.array(_local_roots(at[: len(a)], at[len(a) :], nodes)),
                    ],
                    ["doc", "links", "root"],
                )

    return map_arrow(
        cells, ["slot", "bucket", "same", "left", "right"], run, "doc bigint, links bigint, root bigint"
    )


def _local_roots(a: np.ndarray, b: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component within one block pair (nodes are sorted)."""
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return nodes[root]
        root = new


def _block_pairs(cells: DataFrame, key: list[str]) -> DataFrame:
    """(key.., i, j, left, right): every pair i < j of a bucket's blocks, each dealt out by itself."""
    after = F.sequence(F.col("part") + 1, F.col("blocks") - 1)
    before = F.sequence(F.lit(0).cast("bigint"), F.col("part") - 1)
    one = cells.where("part < blocks - 1").select(
        *key, F.col("part").alias("i"), F.explode(after).alias("j"), F.col("members").alias("left")
    )
    two = cells.where("part > 0").select(
        *key, F.explode(before).alias("i"), F.col("part").alias("j"), F.col("members").alias("right")
    )
    return one.join(two, [*key, "i", "j"])


def near_vectors(
    df: DataFrame,
    id_column: str,
    vector_column: str,
    label_column: str,
    least: float = 0.98,
    tables: int = TABLES,
    probes: int = PROBES,
    block: int = BLOCK,
) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    rows = materialise(classes_of(df, id_column, vector_column, label_column), "cosine-vectors")
    classes = materialise(
        rows.where("unit is not null")
        .groupBy("print")
        .agg(
            F.min("vec_id").alias("doc"),
            F.count("*").alias("m"),
            F.first("label").alias("label"),
            F.first("unit").alias("unit"),
        )
        .where("doc is not null"),
        "cosine-classes",
    )
    entries = materialise(_bucket_rows(classes, tables, probes), "cosine-buckets")
    key = ["label", "width", "slot", "bucket"]
    crowds = entries.groupBy(*key).agg(F.count("*").alias("crowd")).where("crowd > 1")
    # members fall in blocks by hash, about `block` of them each
    placed = (
        entries.join(crowds, key)
        .withColumn("blocks", F.ceil(F.col("crowd") / block).cast("bigint"))
        .withColumn("part", F.pmod(F.xxhash64("doc", "slot"), F.col("blocks")))
    )
    cells = materialise(
        placed.groupBy(*key, "part", "blocks").agg(
            F.collect_list(F.struct("doc", "m", "unit", "codes")).alias("members")
        ),
        "cosine-cells",
    )
    # within a block, and between the blocks of a crowded bucket
    within = cells.select(
        "slot", "bucket", F.lit(True).alias("same"), F.col("members").alias("left"), F.lit(None).alias("right")
    )
    some = cells.where("blocks > 1")
    between = _block_pairs(some, key).select("slot", "bucket", F.lit(False).alias("same"), "left", "right")
    within = within.withColumn("right", F.col("right").cast(between.schema["right"].dataType))
    with arrow_rows(df.sparkSession, CELLS_AT_ONCE):
        found = materialise(
            _block_links(within, least, probes).union(_block_links(between, least, probes)), "cosine-links"
        )

    links = found.groupBy("doc").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("doc").alias("a"), F.col("root").alias("b")))
    known = (
        classes.join(links, "doc", "left")
        .join(roots.withColumnRenamed("v", "doc"), "doc", "left")
        .select(
            "print",
            (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"),
            F.coalesce("root", "doc").alias("component"),
        )
    )
    return (
        rows.select("vec_id", "print")
        .join(known, "print", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
