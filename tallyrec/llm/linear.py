"""Small helpers of linear models that are fitted on a bounded sample."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def sampled(key: Column, share: Column | float, seed: int) -> Column:
    """Whether a row falls in a sample of about ``share`` of all keys, the same one always."""
    slot = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) / float(1 << 30)
    return slot < (F.lit(share) if isinstance(share, float) else share)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(
    x: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 0.5, decay: float = 1e-4
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x outputs) and offsets for targets from 0 to 1, by RMS-scaled descent."""
    w = np.zeros((x.shape[1], y.shape[1]), dtype=np.float32)
    b = np.zeros(y.shape[1], dtype=np.float32)
    mean_w, mean_b = np.full_like(w, 1e-8), np.full_like(b, 1e-8)
    for k in range(rounds):
        error = (sigmoid(x @ w + b) - y).astype(np.float32)
        gw, gb = x.T @ error / len(x) + decay * w, error.mean(axis=0)
        mean_w += gw**2
        mean_b += gb**2
        w -= rate * gw / np.sqrt(mean_w)
        b -= rate * gb / np.sqrt(mean_b)
    return w, b


def pack_sparse(row: np.ndarray) -> bytes:
    at = np.flatnonzero(row).astype("<u4")
    return at.tobytes() + row[at].astype("<f4").tobytes()


def unpack_sparse(data: bytes, size: int) -> np.ndarray:
    both = np.frombuffer(data, dtype="<u4")
    at, values = np.split(both, 2)
    out = np.zeros(size, dtype=np.float32)
    out[at] = values.view("<f4")
    return out
