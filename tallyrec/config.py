"""Typed run parameters.

Default values below are fixed values: they must equal the published
configuration for results to be comparable.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product


@dataclass(frozen=True)
class SplitParams:
    """How interactions become train / validation / test rows."""

    percentile_cut: float = 0.05  # users below this activity percentile are dropped
    folds: int = 5  # the last fold is the validation fold
    seed: int = 10
    list_size: int = 100  # longest ground-truth or recommendation list


@dataclass(frozen=True)
class VoteParams:
    """Damped vote: search space for the damping constant, and the item cut."""

    betas: tuple[int, ...] = (0, 10, 50, 100, 500, 1000)
    item_percentile: float = 0.05


@dataclass(frozen=True)
class AlsParams:
    """One implicit, non-negative ALS fit."""

    rank: int = 1
    reg: float = 2.0
    alpha: float = 5.0
    max_iter: int = 1
    nonnegative: bool = True
    seed: int = 10


@dataclass(frozen=True)
class AlsGrid:
    """Hyper-parameter grid; every combination is one :class:`AlsParams`."""

    ranks: tuple[int, ...] = (1,)
    regs: tuple[float, ...] = (2.0,)
    alphas: tuple[float, ...] = (5.0,)
    max_iter: int = 1

    def points(self) -> list[AlsParams]:
        return [
            AlsParams(rank=r, reg=g, alpha=a, max_iter=self.max_iter)
            for r, g, a in product(self.ranks, self.regs, self.alphas)
        ]


# The latent-factor run cuts inactive users harder than the popularity run.
LATENT_SPLIT = SplitParams(percentile_cut=0.2)


@dataclass(frozen=True)
class SearchParams:
    """Approximate inner-product search: ``tables`` independent hash tables,
    each keyed by ``hashes`` projections cut into cells of ``width``."""

    tables: int = 10
    hashes: int = 2
    width: float = 0.5
    seed: int = 10


@dataclass(frozen=True)
class ForestParams:
    """Approximate inner-product search: ``trees`` hyperplane trees whose leaves hold about
    ``leaf_items`` items, of which a query looks at about ``search_items`` over all trees."""

    trees: int = 10
    search_items: int = 1000
    leaf_items: int = 16
    seed: int = 10
