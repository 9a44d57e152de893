"""Jaccard join of word-shingle sets, size-aware: heavy and light sets go different ways.

Two sets link when ``100 * |x & y| >= percent * |x | y|``. All shingles have one global
order, rare ones first (by the document counts of the most frequent ones, then by hash). With
``o = ceil(percent * n / 100)``, sets that link share a shingle among their first
``n - o + 1``, and two among their first ``n - o + 2``.

* Light sets (at most ``boundary`` shingles) enumerate all subsets of size 2 of that
  prefix; two light sets meet where a subset is equal.
* Heavy sets scan inverted lists of single prefix shingles; the light sets that are
  large enough to link with a heavy one are entered in the lists as well.
* The boundary is where the estimated cost of both ways is lowest: rows written for
  subsets against rows and list entries scanned, summed by set size over all documents.

Sets that are equal are one class (64 bits of a fingerprint of the set) and meet as one. Within a list every member is first
compared with one pivot; only members that this leaves in other components than the
pivot are compared with the rest of their list (both filtered by size, by position
in the order and by the differing bits of two parity bitmaps), so a large group of near copies costs its size, not its square, and no
link between components is lost. ``all_links=True`` compares every pair instead and
returns each link between classes.

Defined results: words are runs of anything but ASCII blanks after lower-casing A-Z; a
text of fewer than five words is one shingle; null, empty and blank texts have none,
link with nothing and are their own component; repeated rows are kept, one result row
each, and rows that share an id but not their text are compared each by its own text; the
component of rows without id is the smallest id linked with them, null if there is none;
an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrec.llm.batches import arrow_rows, keep_rows, map_arrow, text_groups
from tallyrec.llm.bitmaps import bitmap, in_bitmap
from tallyrec.operators.components import components
from tallyrec.llm.shingles import mix, shingle_set
from tallyrec.sources.stage import materialise

WORDS = 5
PERCENT = 80
#: Shingles whose frequency every task knows (the most frequent ones; 12 MB at most).
FREQUENT = 1 << 20
#: Bits of the two filters: 8 and 1 MB.
LIST_BITS = 1 << 26
DOC_BITS = 1 << 23
#: Bits of a shingle's hash in the count of shared shingles, and hashes sorted at once.
HASH_KEY = 40
FLUSH = 1 << 20
#: Rows of documents handed to Python at once.
DOCS_AT_ONCE = 2000
#: Words of 64 bits in a set's parity bitmap, and their columns.
PARITY = [f"b{k}" for k in range(8)]
#: Bits of a signature by which shared lists are looked for; later steps use all 64.
LIST_KEY = 38
#: Classes a task remembers to have met.
CLASSES_KNOWN = 100_000
#: Pairs of whole sets handed to Python at once.
SETS_AT_ONCE = 256
#: Cost of a comparison against that of a signature row. An entry of a list that others
#: share is compared once, with the pivot of its list.
PAIR_COST = 2.0
_LIST = np.uint64(0xA24BAED4963EE407)


def _range_bits(spark: SparkSession) -> int:
    """A few ranges per partition, so that one at a time is small."""
    return (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length() + 2


def _level(counts: np.ndarray) -> np.ndarray:
    """Counts on a scale of a few hundred steps."""
    return (16 * np.log2(counts)).astype(np.int64)


def shared_shingles(df: DataFrame, id_column: str, text_column: str, words: int) -> DataFrame:
    """Shingles (hashes cut to ``HASH_KEY`` bits) of more than one document, with counts.

    Tasks sort their hashes and send each range of them as one row of differences, which
    takes about three bytes a shingle; one row per range comes out.
    """
    bits = _range_bits(df.sparkSession)
    size = np.uint64(HASH_KEY - bits)
    cut = np.uint64(64 - HASH_KEY)

    def packed(hashes: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(hashes), return_counts=True)
        starts = np.searchsorted(values, np.arange(1 << bits, dtype=np.uint64) << size)
        rows = []
        for r, (low, high) in enumerate(zip(starts, [*starts[1:], len(values)], strict=True)):
            if low < high:
                steps = np.diff(values[low:high], prepend=np.uint64(r) << size)
                kind = "<u4" if steps.max() < 1 << 32 else "<u8"
                again = np.flatnonzero(counts[low:high] > 1)
                more = np.stack([again, counts[low:high][again]]).astype("<u4").tobytes()
                rows.append((r, steps.astype(kind).tobytes(), kind == "<u8", more))
        kinds = (pa.int32(), pa.binary(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            ["range", "steps", "wide", "more"],
        )

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, n = [], 0
        for batch in batches:
            for _, texts in text_groups(batch, 1):
                for text in texts:
                    hashes.append(shingle_set(text, words) >> cut)
                    n += len(hashes[-1])
                if n >= FLUSH:
                    yield packed(hashes)
                    hashes, n = [], 0
        if n:
            yield packed(hashes)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for r, steps, wide, more in zip(*batch.columns, strict=True):
                r = r.as_py()
                steps = np.frombuffer(steps.as_py(), "<u8" if wide.as_py() else "<u4").astype(np.uint64)
                counts = np.ones(len(steps), dtype=np.uint32)
                at, n = np.frombuffer(more.as_py(), "<u4").reshape(2, -1)
                counts[at] = n
                found.setdefault(r, []).append(((np.uint64(r) << size) + np.cumsum(steps), counts))
        for r in list(found):
            parts = found.pop(r)
            values = np.concatenate([v for v, _ in parts])
            counts = np.concatenate([c for _, c in parts])
            order = np.argsort(values)
            values, counts = values[order], counts[order]
            first = np.flatnonzero(np.diff(values, prepend=~values[:1]))
            total = np.add.reduceat(counts.astype(np.int64), first)
            keep = total > 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([values[first][keep].astype("<u8").tobytes()], pa.binary()),
                    pa.array([np.minimum(total[keep], (1 << 30) - 1).astype("<u4").tobytes()], pa.binary()),
                ],
                ["hashes", "counts"],
            )

    rows = map_arrow(
        df, [id_column, text_column], emit, "range int, steps binary, wide boolean, more binary"
    )
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, "range").mapInArrow(add, "hashes binary, counts binary")


def most_frequent(shared: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the most frequent shingles, at most ``most`` of them.

    A histogram of counts (a few hundred rows) says from which count on they are so few.
    """

    def levels(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for counts in batch.column(1):
                level, n = np.unique(_level(np.frombuffer(counts.as_py(), "<u4")), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(level), pa.array(n)], ["level", "n"])

    rows = shared.mapInArrow(levels, "level bigint, n bigint").groupBy("level").agg(F.sum("n").alias("n"))
    least, total = 1 << 62, 0
    for level, n in sorted(((r["level"], r["n"]) for r in rows.collect()), reverse=True):
        total += n
        if total > most:
            break
        least = level

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, counts in zip(*batch.columns, strict=True):
                hashes = np.frombuffer(hashes.as_py(), "<u8")
                counts = np.frombuffer(counts.as_py(), "<u4")
                keep = _level(counts) >= least
                if keep.any():
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([hashes[keep].tobytes()], pa.binary()),
                            pa.array([counts[keep].tobytes()], pa.binary()),
                        ],
                        ["hashes", "counts"],
                    )

    found = shared.mapInArrow(choose, "hashes binary, counts binary").collect()
    hashes = np.frombuffer(b"".join(bytes(r["hashes"]) for r in found), "<u8")
    counts = np.frombuffer(b"".join(bytes(r["counts"]) for r in found), "<u4")
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def _least(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def parity(hashes: np.ndarray) -> bytes:
    """Whether an even or odd number of hashes falls on each bit: 64 bytes.

    The bitmaps of two sets differ in no more bits than the sets differ in elements.
    """
    bits = np.bincount((hashes & np.uint64(64 * len(PARITY) - 1)).astype(np.int64), minlength=64 * len(PARITY))
    return np.packbits((bits & 1).astype(np.uint8)).tobytes()


def class_key(hashes: np.ndarray) -> int:
    """64 bits that tell sets apart."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def set_rows(
    df: DataFrame,
    id_column: str,
    text_column: str,
    frequent: tuple[np.ndarray, np.ndarray],
    percent: int,
    words: int,
) -> DataFrame:
    """Per document: size, class, ordered prefix, and estimated costs of both ways."""
    shared = df.sparkSession.sparkContext.broadcast(frequent)
    cut = np.uint64(64 - HASH_KEY)

    def frequency(hashes: np.ndarray) -> np.ndarray:
        known, counts = shared.value
        if not len(known) or not len(hashes):
            return np.ones(len(hashes), dtype=np.uint64)
        short = hashes >> cut
        at = np.minimum(np.searchsorted(known, short), len(known) - 1)
        return np.where(known[at] == short, counts[at], 1).astype(np.uint64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_groups(batch, 1):
                sizes, prints, heads, scans, subsets, maps = [], [], [], [], [], []
                for text in texts:
                    hashes = shingle_set(text, words)
                    n = len(hashes)
                    of = frequency(hashes)
                    first = n - _least(n, percent) + 2
                    key = np.minimum(of, np.uint64((1 << 24) - 1)) << np.uint64(40) | hashes >> np.uint64(24)
                    order = np.argsort(key, kind="stable")[: min(first, n)]
                    sizes.append(n)
                    maps.append(parity(hashes))
                    prints.append(class_key(hashes))
                    heads.append(hashes[order].view(np.int64))
                    scans.append(float((of[order[: first - 1]] > 1).sum()))
                    subsets.append(first * (first - 1) // 2)
                ends = np.cumsum([0, *(len(h) for h in heads)])
                flat = np.concatenate(heads) if heads else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)).cast(pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(np.array(prints, dtype=np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                        pa.array(scans, pa.float64()),
                        pa.array(subsets, pa.int64()),
                        pa.array(maps, pa.binary()),
                    ],
                    ["doc_id", "n", "class", "head", "scan", "subsets", "parity"],
                )

    return map_arrow(
        df,
        [id_column, text_column],
        run,
        "doc_id bigint, n bigint, class bigint, head array<bigint>, scan double, subsets bigint, "
        "parity binary",
    )


def light_boundary(sets: DataFrame, percent: int) -> int:
    """The set size up to which enumerating subsets is estimated to be cheaper.

    One row per distinct set size reaches the driver, fewer than the longest text has words.
    """
    found = sorted(
        (r["n"], r["subsets"], r["scan"], r["m"])
        for r in sets.where("n > 1")
        .groupBy("n")
        .agg(F.sum("subsets").alias("subsets"), F.sum("scan").alias("scan"), F.count("*").alias("m"))
        .collect()
    )
    if not found:
        return 1
    n, subsets, scan, m = (np.array(x, dtype=np.float64) for x in zip(*found, strict=True))
    light = np.cumsum(subsets)
    rows = m * (n - np.ceil(percent * n / 100) + 1)
    heavy = np.cumsum((rows + PAIR_COST * scan)[::-1])[::-1]
    best, least = 1, heavy[0]
    for k, size in enumerate(n):
        from_ = np.searchsorted(n, np.ceil(percent * (size + 1) / 100))
        cost = light[k] + (heavy[from_] if k + 1 < len(n) else 0)
        if cost < least:
            best, least = int(size), cost
    return best


def _signatures(
    n: np.ndarray, ends: np.ndarray, head: np.ndarray, boundary: int, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, signature, position of its first shingle, and whether it is of a light set."""
    head = head.view(np.uint64)
    length = np.diff(ends)
    docs, values, places, kinds = [], [], [], []
    # inverted lists: the heavy sets and the light ones that can link with a heavy one
    listed = n >= -(-percent * (boundary + 1) // 100)
    take = np.where(listed, np.minimum(length, n - -(-percent * n // 100) + 1), 0)
    doc = np.repeat(np.arange(len(n)), take)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(take) - take, take)
    docs.append(doc)
    values.append(mix(head[ends[:-1][doc] + place] ^ _LIST))
    places.append(place)
    kinds.append(np.zeros(len(doc), dtype=bool))
    light = (n > 1) & (n <= boundary)
    for size in np.unique(length[light]):
        some = np.flatnonzero(light & (length == size))
        a, b = np.triu_indices(size, 1)
        rows = head[ends[some][:, None] + np.arange(size)]
        docs.append(np.repeat(some, len(a)))
        values.append(mix(mix(rows[:, a]) + rows[:, b]).ravel())
        places.append(np.tile(a, len(some)))
        kinds.append(np.ones(len(some) * len(a), dtype=bool))
    return tuple(np.concatenate(x) for x in (docs, values, places, kinds))  # type: ignore[return-value]


def _numbered_signatures(part: pa.RecordBatch, boundary: int, percent: int) -> tuple[np.ndarray, ...]:
    n = part.column(1).to_numpy(zero_copy_only=False)
    head = part.column(3)
    ends = head.offsets.to_numpy().astype(np.int64)
    return _signatures(n, ends, head.values.to_numpy(zero_copy_only=False), boundary, percent)


class NewClasses:
    """Picks the rows of a task whose class it has not seen among its last ``CLASSES_KNOWN`` ones."""

    def __init__(self) -> None:
        self.seen: set[int] = set()

    def __call__(self, part: pa.RecordBatch) -> pa.RecordBatch:
        keys = part.column(2).to_pylist()
        new = {c: k for k, c in reversed(list(enumerate(keys))) if c not in self.seen}
        if len(self.seen) + len(new) > CLASSES_KNOWN:
            self.seen.clear()
        self.seen.update(new)
        return part.take(pa.array(sorted(new.values()), pa.int64()))


def shared_lists(sets: DataFrame, boundary: int, percent: int) -> DataFrame:
    """(list): signatures, cut to ``LIST_KEY`` bits, that more than one class has.

    Of equal signatures a group of documents sends two classes at most, so no list is ever
    hot here.
    """
    low = np.uint64(64 - LIST_KEY)

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new = NewClasses()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = new(batch.slice(at, 1000))
                doc, value, _, _ = _numbered_signatures(part, boundary, percent)
                lists = (value >> low).astype(np.int64)
                of_class = part.column(2).to_numpy(zero_copy_only=False)[doc]
                ends = _two_of_each(lists, of_class)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists[ends]), pa.array(of_class[ends])], ["list", "class"]
                )

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches]
        if parts:
            lists, of_class = (np.concatenate(c) for c in zip(*parts, strict=True))
            parts.clear()
            ends = _two_of_each(lists, of_class)
            lists = lists[ends]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(lists[1:][lists[1:] == lists[:-1]]))], ["list"])

    rows = map_arrow(sets, ["doc_id", "n", "class", "head"], emit, "list bigint, class bigint")
    partitions = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, "list").mapInArrow(pick, "list bigint")


def _two_of_each(lists: np.ndarray, of_class: np.ndarray) -> np.ndarray:
    """Places, in order of their list, of two rows of unlike classes per list; of one if there is but one class."""
    order = np.argsort(lists, kind="stable")
    lists, of_class = lists[order], of_class[order]
    start = np.flatnonzero(np.diff(lists, prepend=~lists[:1]))
    if not len(start):
        return order
    first = np.repeat(of_class[start], np.diff(start, append=len(lists)))
    other = np.flatnonzero(of_class != first)
    group = np.searchsorted(start, other, side="right")
    other = other[np.flatnonzero(np.diff(group, prepend=-1))]
    return order[np.sort(np.concatenate([start, other]))]


def _entries(sets: DataFrame, boundary: int, percent: int, only: np.ndarray) -> DataFrame:
    """Signature rows whose list the bitmap ``only`` lets through; of a class about once per task."""
    shared = sets.sparkSession.sparkContext.broadcast(only)
    low = np.uint64(64 - LIST_KEY)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, new = shared.value, NewClasses()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = new(batch.slice(at, 1000))
                doc, value, place, light = _numbered_signatures(part, boundary, percent)
                lists = (value >> low).astype(np.int64)
                keep = in_bitmap(found, lists)
                maps = np.frombuffer(b"".join(part.column(4).to_pylist()), "<i8").reshape(-1, len(PARITY))
                maps = maps[doc[keep]]
                doc = pa.array(doc[keep])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(lists[keep]),
                        pa.array(value[keep].view(np.int64)),
                        part.column(2).take(doc),
                        part.column(1).take(doc),
                        pa.array(place[keep].astype(np.int64)),
                        pa.array(light[keep]),
                        *(pa.array(np.ascontiguousarray(c)) for c in maps.T),
                    ],
                    ["list", "sig", "class", "n", "place", "light", *PARITY],
                )

    schema = "list bigint, sig bigint, class bigint, n bigint, place bigint, light boolean"
    schema += "".join(f", {c} bigint" for c in PARITY)
    return map_arrow(sets, ["doc_id", "n", "class", "head", "parity"], run, schema)


def _full_sets(df: DataFrame, id_column: str, text_column: str, wanted: np.ndarray, words: int) -> DataFrame:
    """All shingles, recomputed from the text, of the documents whose id ``wanted`` lets through or is null."""
    shared = df.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, new = shared.value, NewClasses()
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            known = in_bitmap(found, ids.fill_null(0).to_numpy(zero_copy_only=False))
            batch = batch.filter(pa.array(known | ~ids.is_valid().to_numpy(zero_copy_only=False)))
            for start, texts in text_groups(batch, 1):
                sets = [shingle_set(t, words) for t in texts]
                rows = pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)).cast(pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                        pa.array([class_key(s) for s in sets], pa.int64()),
                    ],
                    ["doc_id", "hashes", "class"],
                )
                yield new(rows).select(["class", "hashes"])

    return map_arrow(df, [id_column, text_column], run, "class bigint, hashes binary")


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs whose full sets link, with the size of the intersection."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept: list[tuple[int, int, int]] = []
            for a, b, x, y in zip(*batch.columns, strict=True):
                x = np.frombuffer(x.as_py(), dtype=np.uint64)
                y = np.frombuffer(y.as_py(), dtype=np.uint64)
                both = overlap(x, y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    kept.append((a.as_py(), b.as_py(), both))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*kept, strict=True) if kept else ([], [], []))],
                ["a", "b", "overlap"],
            )

    one = sets.withColumnsRenamed({"class": "a", "hashes": "x"})
    two = sets.withColumnsRenamed({"class": "b", "hashes": "y"})
    joined = pairs.join(one, "a").join(two, "b")
    schema = "a bigint, b bigint, overlap bigint"
    with arrow_rows(pairs.sparkSession, SETS_AT_ONCE):
        return materialise(map_arrow(joined, ["a", "b", "x", "y"], run, schema), "jaccard-links")


@dataclass(frozen=True)
class JaccardJoin:
    """Result of a join: per document its class; links of classes; component of classes."""

    #: doc_id, n_shingles, class
    members: DataFrame
    #: class, representative (smallest doc_id of the class), root (a class of the component),
    #: component_id (smallest doc_id of the component); sets without shingles are absent
    classes: DataFrame
    #: a, b (classes, a < b), overlap: all links, or enough to span the components
    class_links: DataFrame
    #: set size up to which subsets were enumerated
    boundary: int

    @property
    def links(self) -> DataFrame:
        """a, b (representatives), overlap."""
        a = self.classes.select(F.col("class").alias("a"), F.col("representative").alias("x"))
        b = self.classes.select(F.col("class").alias("b"), F.col("representative").alias("y"))
        return self.class_links.join(a, "a").join(b, "b").select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "overlap"
        )

    def documents(self) -> DataFrame:
        """One row per document: doc_id, n_shingles, component_id; and root, the same for all of a component."""
        found = self.members.join(self.classes.select("class", "root", "component_id"), "class", "left")
        own = F.col("n_shingles") == 0
        return found.select(
            "doc_id",
            "n_shingles",
            F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
            F.coalesce("root", "class").alias("root"),
        )


def _pairs(s: DataFrame, o: DataFrame, boundary: int, percent: int, more: str) -> DataFrame:
    """Candidate pairs of two sides of the same lists, by size, position and parity filters."""
    left = s.select("sig", *(F.col(c).alias(f"s_{c}") for c in s.columns if c != "sig"))
    right = o.select("sig", *(F.col(c).alias(f"o_{c}") for c in o.columns if c != "sig"))
    size = f"100 * least(s_n, o_n) >= {percent} * greatest(s_n, o_n)"
    # the first common shingle stands at these places, so no more than the rest is shared
    place = (
        f"({100 + percent}) * (1 + least(s_n - s_place, o_n - o_place) - 1)"
        f" >= {percent} * (s_n + o_n)"
    )
    kind = f"(s_light or greatest(s_n, o_n) > {boundary})"
    apart = " + ".join(f"bit_count(s_{c} ^ o_{c})" for c in PARITY)
    differ = f"{100 + percent} * ({apart}) <= {100 - percent} * (s_n + o_n)"
    found = left.join(right, "sig").where(
        f"s_class <> o_class and {size} and {place} and {kind} and {more} and {differ}"
    )
    return found.select(
        F.least("s_class", "o_class").alias("a"), F.greatest("s_class", "o_class").alias("b")
    ).distinct()


def jaccard_join(
    df: DataFrame,
    id_column: str,
    text_column: str,
    percent: int = PERCENT,
    words: int = WORDS,
    all_links: bool = False,
) -> JaccardJoin:
    with arrow_rows(df.sparkSession, DOCS_AT_ONCE):
        return _jaccard_join(df, id_column, text_column, percent, words, all_links)


def _jaccard_join(
    df: DataFrame, id_column: str, text_column: str, percent: int, words: int, all_links: bool
) -> JaccardJoin:
    shared = materialise(shared_shingles(df, id_column, text_column, words), "jaccard-shared")
    frequent = most_frequent(shared, FREQUENT)
    sets = materialise(set_rows(df, id_column, text_column, frequent, percent, words), "jaccard-sets")
    boundary = light_boundary(sets, percent)

    alive = materialise(shared_lists(sets, boundary, percent), "jaccard-lists")
    classes = materialise(
        sets.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("representative")), "jaccard-classes"
    )
    rows = (
        _entries(sets, boundary, percent, bitmap(alive, "list", LIST_BITS))
        .join(alive, "list", "left_semi")
        .drop("list")
        .distinct()
    )
    rows = materialise(rows, "jaccard-entries")

    def linked(pairs: DataFrame) -> DataFrame:
        """The given pairs that link, by the whole sets of the documents in them."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        docs = classes.join(wanted, "class", "left_semi").where("representative is not null")
        found = _full_sets(df, id_column, text_column, bitmap(docs, "representative", DOC_BITS), words)
        found = materialise(found.dropDuplicates(["class"]), "jaccard-full")
        return _linked(pairs, found, percent)

    if all_links:
        pairs = materialise(_pairs(rows, rows, boundary, percent, "s_class < o_class"), "jaccard-pairs")
        links = linked(pairs)
        roots = components(links)
    else:
        links, roots = _spanning_links(rows, linked, boundary, percent)
    rooted = classes.join(roots.withColumnRenamed("v", "class"), "class", "left").withColumn(
        "root", F.coalesce("root", "class")
    )
    smallest = rooted.groupBy("root").agg(F.min("representative").alias("component_id"))
    named = materialise(rooted.join(smallest, "root"), "jaccard-components")
    return JaccardJoin(sets.select("doc_id", F.col("n").alias("n_shingles"), "class"), named, links, boundary)


def _spanning_links(
    rows: DataFrame, linked: Callable[[DataFrame], DataFrame], boundary: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Links that connect all that linked pairs connect, and the components they make."""
    # another pivot in every list, so that the lists of a class lead to different ones
    pick = F.xxhash64("class", "sig").alias("pick")
    pivots = rows.groupBy("sig").agg(
        F.min(F.struct(pick, "class", "n", "place", "light", *PARITY)).alias("p")
    )
    pivots = materialise(
        pivots.select("sig", *(f"p.{c}" for c in ("class", "n", "place", "light", *PARITY))), "jaccard-pivots"
    )
    star = materialise(_pairs(pivots, rows, boundary, percent, "true"), "jaccard-star")
    links = linked(star)
    roots = components(links)

    # members of a list that are not where its pivot is
    rooted = (
        rows.join(roots.withColumnRenamed("v", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
        .select("sig", "class", "n", "place", "light", "root", *PARITY)
    )
    rooted = materialise(rooted, "jaccard-rooted")
    split = rooted.groupBy("sig").agg(
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.min(F.struct(pick, "class", "root")).alias("p"),
    )
    split = materialise(
        split.where("low < high").select(
            "sig", F.col("p.class").alias("pivot"), F.col("p.root").alias("pivot_root")
        ),
        "jaccard-split",
    )
    open_ = rooted.join(split, "sig").where("class <> pivot")
    open_ = materialise(open_.withColumn("away", F.expr("root <> pivot_root")), "jaccard-open")
    away = open_.where("away").drop("pivot", "pivot_root")
    rest = open_.drop("pivot", "pivot_root")
    pairs = _pairs(
        away, rest, boundary, percent, "s_root <> o_root and (not o_away or s_class < o_class)"
    )
    pairs = materialise(pairs.join(star, ["a", "b"], "left_anti"), "jaccard-rest")
    more = linked(pairs)

    # the new links join components
    a = roots.select(F.col("v").alias("a"), F.col("root").alias("ra"))
    b = roots.select(F.col("v").alias("b"), F.col("root").alias("rb"))
    bridges = (
        more.join(a, "a", "left")
        .join(b, "b", "left")
        .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    )
    above = components(bridges)
    every = roots.select("v", "root").union(
        more.select(F.explode(F.array("a", "b")).alias("v"))
        .distinct()
        .join(roots, "v", "left_anti")
        .select("v", F.col("v").alias("root"))
    )
    final = every.join(
        above.select(F.col("v").alias("root"), F.col("root").alias("top")), "root", "left"
    ).select("v", F.coalesce("top", "root").alias("root"))
    return links.union(more), materialise(final, "jaccard-roots")


def one_of_each(df: DataFrame, id_column: str, text_column: str, words: int = WORDS) -> DataFrame:
    """Rows, as they are, without those that link with a smaller id.

    Rows that share an id are told apart by their texts: each stays that its own text does
    not link with a smaller id, but of equal or linked ones only one. Rows without id stay.
    Only rows that a bitmap of the ids in question lets through are shuffled; the others
    are clear at once.
    """
    joined = jaccard_join(df, id_column, text_column, words=words)
    found = materialise(joined.documents(), "jaccard-documents").where("doc_id is not null")
    many = F.count("*") > 1
    decided = found.groupBy("doc_id").agg(
        many.alias("repeated"), F.max(F.col("doc_id") != F.col("component_id")).alias("gone")
    )
    decided = materialise(decided.where("repeated or gone"), "jaccard-gone")
    shared = df.sparkSession.sparkContext.broadcast(bitmap(decided, "doc_id", DOC_BITS))

    def in_question(ids: list[int | None]) -> np.ndarray:
        known = np.array([i is not None for i in ids], dtype=bool)
        values = np.array([0 if i is None else i for i in ids], dtype=np.int64)
        return in_bitmap(shared.value, values) & known

    clear = keep_rows(df, id_column, lambda ids: (~in_question(ids)).tolist())
    doubtful = keep_rows(df, id_column, lambda ids: in_question(ids).tolist())
    ids = decided.withColumnRenamed("doc_id", id_column)
    rest = doubtful.join(ids.select(id_column), id_column, "left_anti")
    repeated = doubtful.join(ids.where("repeated").select(id_column), id_column, "left_semi")
    return clear.unionByName(rest.select(*df.columns)).unionByName(
        _by_text(repeated, joined, id_column, text_column, words)
    )


def _by_text(df: DataFrame, joined: JaccardJoin, id_column: str, text_column: str, words: int) -> DataFrame:
    """Of rows with repeated ids those that stay, decided by the class of each row's text."""
    at = df.columns.index(text_column)
    own = [f"_row_{k}" for k in range(len(df.columns))]  # names that clash with nothing
    schema = ", ".join(f"{c} {t}" for c, (_, t) in zip(own, df.dtypes, strict=True)) + ", class bigint, n bigint"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_groups(batch, at):
                sets = [shingle_set(t, words) for t in texts]
                part = batch.slice(start, len(texts))
                extra = [pa.array([class_key(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *extra], [*own, "class", "n"])

    rows = df.mapInArrow(run, schema)
    place = F.col(own[df.columns.index(id_column)]).cast("bigint")
    stays = (F.col("n") == 0) | (F.col("component_id") == place)
    kept = (
        rows.join(joined.classes.select("class", "root", "component_id"), "class", "left")
        .where(stays)
        .withColumn("root", F.coalesce("root", "class"))
        .dropDuplicates([own[df.columns.index(id_column)], "root"])
    )
    return kept.select(*(F.col(c).alias(name) for c, name in zip(own, df.columns, strict=True)))
