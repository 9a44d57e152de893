"""Hashed word shingles of whole texts, vectorised over the bytes of a text."""

from __future__ import annotations

import numpy as np

#: Odd multipliers of the hashes.
_BASE = 0x9E3779B97F4A7C15
_WORD = np.uint64(0xC2B2AE3D27D4EB4F)
_STEP = np.uint64(0x165667B19E3779F9)
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_BASE = np.uint64(_BASE)
_CHUNK = 1 << 16

#: Words are `[^\x20\x09-\x0D]+` after lower-casing A-Z.
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, _CHUNK + 1)
_DOWN = _powers(_INVERSE, _CHUNK + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the entropy of 64-bit hashes over all bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _hashes_of(data: np.ndarray, blank: np.ndarray) -> np.ndarray:
    """Hashes of the words of at most ``_CHUNK`` bytes."""
    n = len(data)
    edge = np.flatnonzero(np.diff(blank.view(np.int8), prepend=1, append=1))
    starts, stops = edge[0::2], edge[1::2]
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[:n], out=sums[1:])
    value = (sums[stops] - sums[starts]) * _DOWN[starts]
    return mix(value + (stops - starts).astype(np.uint64) * _WORD)


def _hash_of_long(word: np.ndarray) -> np.ndarray:
    """The hash of one word, summed up chunk by chunk."""
    total = np.zeros(1, dtype=np.uint64)
    shift = np.ones(1, dtype=np.uint64)
    for at in range(0, len(word), _CHUNK):
        part = word[at : at + _CHUNK].astype(np.uint64) + np.uint64(1)
        total += (part * _UP[: len(part)]).sum(dtype=np.uint64) * shift
        shift *= _UP[_CHUNK]
    return mix(total + np.array([len(word)], dtype=np.uint64) * _WORD)


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word, in order. A long text is cut between words."""
    data = _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    blank = _BLANK[data]
    if len(data) <= _CHUNK:
        return _hashes_of(data, blank) if len(data) else np.empty(0, dtype=np.uint64)
    found, at = [], 0
    while at < len(data):
        stop = at + _CHUNK
        if stop < len(data):
            cuts = np.flatnonzero(blank[at:stop])
            if not len(cuts):  # one word from here to beyond the chunk
                after = blank[stop:]
                stop += int(after.argmax()) if after.any() else len(after)
                found.append(_hash_of_long(data[at:stop]))
                at = stop
                continue
            stop = at + int(cuts[-1]) + 1
        found.append(_hashes_of(data[at:stop], blank[at:stop]))
        at = stop
    return np.concatenate(found)


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles; the whole sequence if it is shorter."""
    hashes = word_hashes(text) if text else np.empty(0, dtype=np.uint64)
    size = min(words, len(hashes))
    if size == 0:
        return hashes
    last = len(hashes) - size + 1
    value = np.full(last, size, dtype=np.uint64)
    for k in range(size):
        value = value * _STEP ^ (value >> np.uint64(29))
        value = value + hashes[k : k + last] * _WORD
    return np.unique(mix(value))
