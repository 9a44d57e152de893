"""What one search task does: multiply a block of queries with a block of items."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

SCORED = "query_id bigint, item_id bigint, score double"
RANKED = f"{SCORED}, rank int"
SLAB_CELLS = 2_000_000  # scores computed at a time, 16 MB and as much to sort them
# Significant bits of a score. Products of 32-bit factors carry no information
# beyond this; rounding makes equal vectors tie exactly, whatever order the sums
# are taken in, and being relative it works for scores of any size.
SCORE_BITS = 40
# Blocks with fewer items than this, or than as many times the list, are scored in double precision only.
COARSE_ITEMS = 2048
COARSE_LISTS = 8


def scorer(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        return top_products(left, right, k)

    return score


def matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return stored_matrix(column, rows).astype(np.float64)


def stored_matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    """The vectors in the precision they came in."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def top_products(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The ``k`` best items of every query of one block pair; ties to the smaller id.

    Where the queries have a column ``least``, scores below it are left out. Where they have ``reach``, only
    as many items of smallest ``place`` need be met.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if left.num_rows and right.num_rows:
        if "reach" in left.column_names:  # neighbours reach about as far
            left = left.sort_by([("reach", "descending")])
            right = right.sort_by("place")
        query_ids = left["query_id"].to_numpy()
        item_ids = right["item_id"].to_numpy()
        reach = left["reach"].to_numpy() if "reach" in left.column_names else None
        items = matrix(right["features"], right.num_rows)
        vectors = stored_matrix(left["features"], left.num_rows)
        seen = _Seen(left["seen"], item_ids) if "seen" in left.column_names else None
        least = left["least"].to_numpy() if "least" in left.column_names else None
        coarse = Coarse.of(items)
        step = max(1, SLAB_CELLS // right.num_rows)
        for start in range(0, left.num_rows, step):
            width = right.num_rows if reach is None else int(reach[start])
            x = vectors[start : start + step].astype(np.float64)
            tops = coarse.tops(x, items, width, item_ids, k, seen, start) if coarse else None
            if tops is None:
                scores = x @ items[:width].T
                if seen:
                    seen.mask(scores, start)
                tops = row_tops(scores, x, items, item_ids, k)
            row, col, score = tops
            if least is not None:
                able = ~(score < least[start + row])  # no threshold is not a number
                row, col, score = row[able], col[able], score[able]
            found.append((query_ids[start + row], item_ids[col], score))
    return scored_table(found)


def scored_table(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    merged = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
    types = {"query_id": pa.int64(), "item_id": pa.int64(), "score": pa.float64()}
    return pa.table({n: pa.array(c, t) for (n, t), c in zip(types.items(), merged)})


def ranker(function: Callable[[pa.Table, pa.Table], pa.Table], k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """``function`` with a ``rank``, for blocks that hold all items: what is found of an id is one list of ``k``."""

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        found = function(left, right)
        ids = left["query_id"].to_numpy()
        if len(np.unique(ids)) < len(ids):  # the lists of rows with one id are merged
            found = found.sort_by([("query_id", "ascending"), ("score", "descending"), ("item_id", "ascending")])
        query = found["query_id"].to_numpy()
        begins = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.empty(0, int)
        place = np.arange(len(query)) - np.repeat(begins, np.diff(begins, append=len(query)))
        return found.append_column("rank", pa.array(place + 1, pa.int32())).filter(pa.array(place < k))

    return rank


class _Seen:
    """Items the queries of a block have seen, as places among the block's items."""

    def __init__(self, seen: pa.ChunkedArray, item_ids: np.ndarray):
        lists = seen.combine_chunks()
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        order = np.argsort(item_ids)
        known = item_ids[order]
        at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
        held = known[at] == ids
        self.query = np.repeat(np.arange(len(counts)), counts)[held]
        self.place = order[at[held]]

    def mask(self, scores: np.ndarray, start: int) -> None:
        """Gives them no score that could be chosen; ``scores`` belong to the queries from ``start``."""
        first, last = np.searchsorted(self.query, [start, start + len(scores)])
        row, col = self.query[first:last] - start, self.place[first:last]
        inside = col < scores.shape[1]
        scores[row[inside], col[inside]] = -np.inf


def row_tops(
    scores: np.ndarray, x: np.ndarray, items: np.ndarray, item_ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and scores of the ``k`` best products of ``x`` and the first of ``items``, in order."""
    width = scores.shape[1]
    if width > k:
        kth = np.partition(scores, width - k, axis=1)[:, width - k]
        # a little lower, to keep what may tie with the k-th once rounded
        slack = np.where(np.isfinite(kth), np.abs(kth), 0) * 2.0 ** (2 - SCORE_BITS)
        row, col = np.nonzero(scores >= (kth - slack)[:, None])
    else:
        row, col = np.indices(scores.shape).reshape(2, -1)
    able = scores[row, col] > -np.inf
    row, col = row[able], col[able]
    return ranked_tops(row, col, pair_products(x, items, row, col), item_ids, k, len(scores))


#: Numbers multiplied at a time.
PAIR_NUMBERS = 1_000_000


def pair_products(x: np.ndarray, items: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Products of single pairs, summed number by number: the same to the last bit in whatever block a pair meets."""
    found = np.empty(len(row))
    step = max(1, PAIR_NUMBERS // x.shape[1])
    for start in range(0, len(row), step):
        part = slice(start, start + step)
        terms = x.take(row[part], axis=0) * items.take(col[part], axis=0)
        found[part] = np.add.accumulate(terms, axis=1)[:, -1]
    return found


def ranked_tops(
    row: np.ndarray, col: np.ndarray, score: np.ndarray, item_ids: np.ndarray, k: int, rows: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best of every row of rounded scores, in order; ties to the smaller id."""
    fraction, exponent = np.frexp(score)
    score = np.ldexp(np.rint(np.ldexp(fraction, SCORE_BITS)), exponent - SCORE_BITS)
    order = np.lexsort((item_ids[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    first = np.searchsorted(row, np.arange(rows))
    kept = np.arange(row.size) - first[row] < k
    return row[kept], col[kept], score[kept]


def _places(scores: np.ndarray, least: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the few scores that are not below their row's ``least``, eight at a time."""
    width = scores.shape[1]
    np.greater_equal(scores, least[:, None], out=near[:, :width])
    near[:, width:] = False
    eight = np.flatnonzero(near.reshape(-1).view(np.uint64))
    word, bit = np.nonzero(near.reshape(-1, 8)[eight])
    return np.divmod(8 * eight[word] + bit, near.shape[1])


class Coarse:
    """Products in single precision, which tell the few pairs whose product is needed in double precision.

    Every pair is scored. Sides are scaled to norms of at most 1, so that no product is off by more than ``error``,
    in whatever order it is summed up; what is within twice of it below the k-th best is scored again.
    """

    def __init__(self, items: np.ndarray, scale: float):
        scaled = items / scale
        scaled /= max(1.0, np.sqrt((scaled * scaled).sum(axis=1).max()))
        self.items = scaled.astype(np.float32)
        self.error = (items.shape[1] + 8) * 2.0**-24
        self.scores, self.near = np.empty(0, dtype=np.float32), np.empty(0, dtype=bool)

    @staticmethod
    def of(items: np.ndarray) -> Coarse | None:
        scale = np.abs(items).max(initial=0.0)
        return Coarse(items, scale) if len(items) >= COARSE_ITEMS and 0 < scale < np.inf else None

    def tops(
        self, x: np.ndarray, items: np.ndarray, width: int, item_ids: np.ndarray, k: int, seen: _Seen | None, start: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """:func:`row_tops` of the products with the first ``width`` items; None where double precision is as cheap."""
        unit = self._unit(x)
        if unit is None or width < max(COARSE_ITEMS, COARSE_LISTS * k):
            return None
        scores, near = self._room(len(x), width)
        np.matmul(unit, self.items[:width].T, out=scores)
        if seen:
            seen.mask(scores, start)
        # the k-th best of the best of every group of items is no better than the k-th best item
        deep = min(32, width // (4 * k))
        groups = width // deep
        best = scores[:, : deep * groups].reshape(len(x), deep, groups).max(axis=1)
        kth = np.partition(best, groups - k, axis=1)[:, groups - k]
        row, col = _places(scores, self._least(kth), near)
        if len(row) > 4 * k * len(x) + 64 or not np.isfinite(kth).all():
            return None
        return ranked_tops(row, col, pair_products(x, items, row, col), item_ids, k, len(x))

    def tops_among(
        self, x: np.ndarray, items: np.ndarray, met: np.ndarray, item_ids: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray] | None:
        """Places in ``met`` and scores of the ``k`` best of one query's products with the items ``met``, in order; None as above."""
        unit = self._unit(x[None, :])
        if unit is None or len(met) < max(COARSE_ITEMS, COARSE_LISTS * k):
            return None
        scores = self.items.take(met, axis=0) @ unit[0]
        kth = np.partition(scores, len(met) - k)[len(met) - k :][:1]
        col = np.flatnonzero(scores >= self._least(kth))
        if len(col) > 4 * k + 64:
            return None
        row = np.zeros(len(col), dtype=np.int64)
        return ranked_tops(row, col, pair_products(x[None, :], items, row, met.take(col)), item_ids, k, 1)[1:]

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray | None:
        """Queries at a norm of 1; None if one has none."""
        size = np.abs(x).max(axis=1, keepdims=True)
        if not (size > 0).all():
            return None
        unit = x / size
        return (unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))).astype(np.float32)

    def _least(self, kth: np.ndarray) -> np.ndarray:
        """What the products of single precision may be at least that belong to a k-th best one or to one above it."""
        least = kth.astype(np.float64) - 2 * self.error - 2.0 ** (2 - SCORE_BITS)
        # rounded down, as single precision compares
        return np.nextafter(least.astype(np.float32), np.float32(-np.inf))

    def _room(self, rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Room for scores and for marks (by eights), the same for every slab: new memory costs more than the products."""
        eights = -(-width // 8) * 8
        if self.near.size < rows * eights:
            self.scores, self.near = np.empty(rows * eights, dtype=np.float32), np.empty(rows * eights, dtype=bool)
        return self.scores[: rows * width].reshape(rows, width), self.near[: rows * eights].reshape(rows, eights)
