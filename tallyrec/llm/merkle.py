"""Merkle manifest of a dataset: a tree of SHA-256 hashes per group, folded from retained hash states.

A row is a leaf: the hash of its fields. The leaves of a group (a source) stand in order of their id;
every ``FAN`` consecutive nodes become one, until one is left, the group's subroot; the subroots, in
order of their group, become the root likewise.

A parent hashes its children one after the other and retains a copy of its hash state before each
child slot. To see what another value of one child leads to, a fold copies the state of that slot and
adds the new child and what is to its right; nothing to its left is hashed again.

The work is dealt out by chunks of ``CHUNK`` = 16**3 consecutive nodes of a group: a chunk is one row of a
stage table, and its three levels of parents are built inside one task. Chunk roots are the nodes of
the next tier, so a group of any size needs few tiers and a hot group is many chunks. A fold then
needs a chunk and its path: for every level above it, what stands left and right there. Paths are handed
down from the root, one per chunk. Hash states cannot leave a process, so a task rebuilds the states of
a path once per chunk, from the left siblings; all folds of the chunk resume them. Equal replacements
at one place are folded once.

Order is a range sort of small rows (id and hashes) by group, id and leaf; what partitions hold is counted
by one row per partition.

Defined results: a null field is ``-``, so a null differs from an empty text; rows without a group form one of
their own, the first; rows without id come first in their group; rows with equal ids are ordered by
leaf; repeated rows are leaves each; a lone leaf is its group's subroot; the proof of a row without any
siblings is the hash of nothing; an empty table gives an empty table and no root; texts are hashed as they
are, whatever their length; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.batches import arrow_rows, map_arrow
from tallyrec.sources.stage import materialise

FAN = 16
LEVELS = 3
CHUNK = FAN**LEVELS
#: Chunks handed to Python at once.
CHUNKS_AT_ONCE = 16
#: The one tree of subroots.
TOP = "top"


def field(value: Column) -> Column:
    """``-`` for null, else number of UTF-8 bytes, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*(field(f) for f in fields)), 256)


class Parents:
    """The parents above the nodes of one chunk, level by level, with their retained states."""

    def __init__(self, digests: list[bytes], levels: int) -> None:
        self.levels: list[list[tuple[list, bytes]]] = []
        nodes = digests
        for _ in range(levels):
            runs = [b"".join(nodes[k : k + FAN]) for k in range(0, len(nodes), FAN)]
            level, above = [], []
            for run in runs:
                state, before = hashlib.sha256(), []
                for at in range(0, len(run), 64):
                    before.append(state.copy())
                    state.update(run[at : at + 64])
                level.append((before, run))
                above.append(state.hexdigest().encode())
            self.levels.append(level)
            nodes = above
        self.root = nodes[0]

    def siblings(self, slot: int) -> list[tuple[bytes, bytes]]:
        """What stands left and right of a node at each level, lowest first."""
        out = []
        for level in self.levels:
            slot, at = divmod(slot, FAN)
            run = level[slot][1]
            out.append((run[: 64 * at], run[64 * (at + 1) :]))
        return out


class Folds:
    """Folds of the nodes of one chunk up to the root, over the chunk's parents and the path above."""

    def __init__(self, parents: Parents, path: list[tuple[bytes, bytes]]) -> None:
        self.parents = parents
        self.above = [(hashlib.sha256(left), right) for left, right in path]
        self.rest = b"".join(left + right for left, right in path)
        self.known: dict[tuple[int, int, bytes], bytes] = {}

    def fold(self, slot: int, digest: bytes) -> bytes:
        asked = []
        for height, level in enumerate(self.parents.levels):
            key = (height, slot, digest)
            if key in self.known:
                digest = self.known[key]
                break
            asked.append(key)
            slot, at = divmod(slot, FAN)
            before, run = level[slot]
            digest = _resume(before[at], digest, run[64 * (at + 1) :])
        else:
            key = (len(self.parents.levels), 0, digest)
            if key in self.known:
                digest = self.known[key]
            else:
                asked.append(key)
                for state, right in self.above:
                    digest = _resume(state, digest, right)
        self.known.update(dict.fromkeys(asked, digest))
        return digest

    def proof(self, slot: int) -> str:
        seen = hashlib.sha256()
        for left, right in self.parents.siblings(slot):
            seen.update(left)
            seen.update(right)
        seen.update(self.rest)
        return seen.hexdigest()


def _resume(state, digest: bytes, right: bytes) -> bytes:
    state = state.copy()
    state.update(digest)
    state.update(right)
    return state.hexdigest().encode()


def levels_of(chunk: int, size: int) -> int:
    """Levels of parents inside a chunk: all, unless it is the only one of its tree."""
    if chunk > 0 or size == CHUNK:
        return LEVELS
    levels = 0
    while FAN**levels < size:
        levels += 1
    return levels


def _pack_path(path: list[tuple[bytes, bytes]]) -> bytes:
    """Per level: number of nodes left and right, then their hashes."""
    return b"".join(
        bytes([len(left) // 64, len(right) // 64]) + bytes.fromhex((left + right).decode()) for left, right in path
    )


def _read_path(data: bytes) -> list[tuple[bytes, bytes]]:
    path, at = [], 0
    while at < len(data):
        left, right = data[at], data[at + 1]
        text = data[at + 2 : at + 2 + 32 * (left + right)].hex().encode()
        path.append((text[: 64 * left], text[64 * left :]))
        at += 2 + 32 * (left + right)
    return path


def _hex(values: Iterable[bytes]) -> list[bytes]:
    return [v.hex().encode() for v in values]


def positions(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``pos``: place within its ``tree`` (the first column of ``order``), from 0.

    ``df`` must come from a stored table, since a range sort reads it twice.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    at = ordered.columns.index(order[0])
    schema = ", ".join(f"`{c}` {t}" for c, t in ordered.dtypes) + ", part bigint, opening boolean, within bigint"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree, within, opening = TaskContext.get().partitionId(), None, -1, True
        for batch in batches:
            trees = batch.column(at).to_pylist()
            places, opens = [], []
            for now in trees:
                if now != tree:
                    opening = tree is None
                    tree, within = now, -1
                within += 1
                places.append(within)
                opens.append(opening)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([part] * len(trees), pa.int64()),
                    pa.array(opens, pa.bool_()),
                    pa.array(places, pa.int64()),
                ],
                [*batch.schema.names, "part", "opening", "within"],
            )

    numbered = materialise(ordered.mapInArrow(run, schema), name)
    tree = F.col(order[0])
    ends = (  # one row per partition
        numbered.groupBy("part")
        .agg(
            F.min(tree).alias("first"),
            F.max(F.struct(tree.alias("tree"), "within")).alias("last"),
        )
        .collect()
    )
    bases, before, carried = [], None, 0
    for row in sorted(ends, key=lambda r: r["part"]):
        base = carried if row["first"] == before else 0
        bases.append((row["part"], base))
        before = row["last"]["tree"]
        carried = row["last"]["within"] + 1 + (base if row["first"] == before else 0)
    table = spark.createDataFrame(bases, "part bigint, base bigint")
    return numbered.join(F.broadcast(table), "part").select(
        *df.columns, (F.col("within") + F.when(F.col("opening"), F.col("base")).otherwise(0)).alias("pos")
    )


def _chunks(nodes: DataFrame, extra: list[str], name: str) -> DataFrame:
    """tree, chunk, slots (at most ``CHUNK`` nodes in order) and root, one row per chunk."""
    spark = nodes.sparkSession
    grouped = nodes.groupBy("tree", F.shiftright("pos", 12).alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", *extra))).alias("slots")
    )
    schema = ", ".join(f"`{c}` {t}" for c, t in grouped.dtypes) + ", root binary"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = []
            for chunk, slots in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                digests = _hex(slots.values.field("digest").to_pylist())
                root = Parents(digests, levels_of(chunk, len(digests))).root
                roots.append(bytes.fromhex(root.decode()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.binary())], [*batch.schema.names, "root"])

    with arrow_rows(spark, CHUNKS_AT_ONCE):
        return materialise(map_arrow(grouped, grouped.columns, run, schema), name)


def _tiers(nodes: DataFrame, extra: list[str], name: str) -> list[DataFrame]:
    """Chunk tables from the nodes up to the tier that has one chunk per tree."""
    tiers = [_chunks(nodes, extra, f"{name}-0")]
    while not tiers[-1].where("chunk > 0").isEmpty():
        above = tiers[-1].select("tree", F.col("chunk").alias("pos"), F.col("root").alias("digest"))
        tiers.append(_chunks(above, [], f"{name}-{len(tiers)}"))
    return tiers


def _hand_down(chunks: DataFrame, paths: DataFrame, extra: list[str]) -> DataFrame:
    """tree, chunk, path, subroot of every node of ``chunks`` (its pos as chunk), with its digest and ``extra``."""
    joined = chunks.join(paths, ["tree", "chunk"]).select("tree", "chunk", "slots", "path", "subroot")
    names = ["tree", "chunk", "path", "subroot", "digest", *extra]
    kinds = dict(chunks.selectExpr(*(f"slots[0].{c} as {c}" for c in ["digest", *extra])).dtypes)
    schema = "tree string, chunk bigint, path binary, subroot binary, " + ", ".join(f"{c} {t}" for c, t in kinds.items())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                slots = batch.column(2)[row].values
                digests = slots.field("digest")
                hexed = _hex(digests.to_pylist())
                n = len(hexed)
                parents = Parents(hexed, levels_of(batch.column(1)[row].as_py(), n))
                above = batch.column(3)[row].as_py()
                columns = [
                    pa.array([batch.column(0)[row].as_py()] * n, pa.string()),
                    slots.field("pos"),
                    pa.array([_pack_path(parents.siblings(k)) + above for k in range(n)], pa.binary()),
                    pa.array([batch.column(4)[row].as_py()] * n, pa.binary()),
                    digests,
                    *(slots.field(c) for c in extra),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(joined, joined.columns, run, schema)


def _paths(tiers: list[DataFrame], top: DataFrame) -> DataFrame:
    """Paths of the chunks of the lowest tier, from those of the highest."""
    for tier in tiers[:0:-1]:
        top = _hand_down(tier, top, []).select("tree", "chunk", "path", "subroot")
    return top


@dataclass(frozen=True)
class Manifest:
    """The stored tree: chunk tables of the groups, tier by tier, paths of their lowest chunks, the root."""

    leaves: DataFrame  # lowest chunks
    paths: DataFrame  # tree, chunk, path, subroot
    subroots: DataFrame  # tree, root
    root: str | None

    def folds(self) -> DataFrame:
        """Per leaf: id, leaf, subroot, root, proof, and the root that its replacement folds to."""
        joined = self.leaves.join(self.paths, ["tree", "chunk"]).select("chunk", "slots", "path", "subroot")
        root = self.root

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    slots = batch.column(1)[row].values
                    digests = _hex(slots.field("digest").to_pylist())
                    parents = Parents(digests, levels_of(batch.column(0)[row].as_py(), len(digests)))
                    folds = Folds(parents, _read_path(batch.column(2)[row].as_py()))
                    replaced = [
                        own if new is None else new.hex().encode()
                        for own, new in zip(digests, slots.field("replaced").to_pylist(), strict=True)
                    ]
                    folded = [folds.fold(k, d).decode() for k, d in enumerate(replaced)]
                    n = len(digests)
                    yield pa.RecordBatch.from_arrays(
                        [
                            slots.field("doc_id"),
                            pa.array([d.decode() for d in digests], pa.string()),
                            pa.array([batch.column(3)[row].as_py().hex()] * n, pa.string()),
                            pa.array([root] * n, pa.string()),
                            pa.array([folds.proof(k) for k in range(n)], pa.string()),
                            pa.array(folded, pa.string()),
                            pa.array([f == root for f in folded], pa.bool_()),
                        ],
                        [c.split()[0] for c in FOLDS.split(", ")],
                    )

        with arrow_rows(self.leaves.sparkSession, CHUNKS_AT_ONCE):
            return materialise(map_arrow(joined, joined.columns, run, FOLDS), "merkle-folds")


FOLDS = (
    "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


def build_manifest(
    df: DataFrame,
    id_column: str,
    group_column: str,
    fields: list[str],
    changed: dict[str, Column] | None = None,
    where: Column | None = None,
) -> Manifest:
    """The tree over ``df``. Rows ``where`` holds are also hashed with the ``changed`` fields, for ``folds``."""
    spark = df.sparkSession
    own = [F.col(f"`{c}`") for c in fields]
    other = [(changed or {}).get(c, F.col(f"`{c}`")) for c in fields]
    group = F.col(f"`{group_column}`").cast("string")
    leaves = materialise(
        df.select(
            F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("tree"),
            F.col(f"`{id_column}`").cast("bigint").alias("doc_id"),
            F.unhex(leaf_hash(own)).alias("digest"),
            F.unhex(F.when(F.lit(False) if where is None else where, leaf_hash(other))).alias("replaced"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "merkle-leaves",
    )
    placed = positions(leaves, ["tree", "doc_id", "digest", "row"], "merkle-order")
    tiers = _tiers(placed.drop("row"), ["doc_id", "replaced"], "merkle-chunks")
    subroots = tiers[-1].select("tree", "root")
    tops = positions(
        materialise(subroots.select(F.lit(TOP).alias("all"), "tree", F.col("root").alias("digest")), "merkle-subroots"),
        ["all", "tree"],
        "merkle-groups",
    ).select(F.col("all").alias("tree"), F.col("tree").alias("group"), "digest", "pos")
    above = _tiers(tops, ["group"], "merkle-top")
    last = above[-1].select("root").take(1)  # one row: the root
    if not last:
        empty = spark.createDataFrame([], "tree string, chunk bigint, path binary, subroot binary")
        return Manifest(tiers[0], empty, subroots, None)
    none = F.lit(b"")
    top = above[-1].select("tree", "chunk", none.alias("path"), none.alias("subroot"))
    with arrow_rows(spark, CHUNKS_AT_ONCE):
        groups = _hand_down(above[0], _paths(above, top), ["group"]).select(
            F.col("group").alias("tree"), F.lit(0).cast("bigint").alias("chunk"), "path", F.col("digest").alias("subroot")
        )
        paths = materialise(_paths(tiers, groups), "merkle-paths")
    return Manifest(tiers[0], paths, subroots, last[0]["root"].hex())
