"""Ids of whole texts by a word-level BPE of the tokenizers library, word by word.

The vocabulary drops white space and splits at it, so the ids of a text are those of
its words in turn. A group of texts is split and its distinct words are numbered in Arrow;
each distinct word is looked up once, and the ids of the texts are gathered by numpy.
A worker remembers words, and the parts (letters, one digit, a run of signs) of those that
are not letters only, in a table bounded by bytes. Only new parts reach the library, many
at a time. Texts or words for which that reasoning might not hold
(control strings, separators other engines read as blanks, characters outside
Latin-1) go to the library as they are.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of the words that a worker remembers, and the longest word among them.
TABLE_BYTES = 32 << 20
LONGEST = 64
# The split pattern of the vocabulary file, for Latin-1: fixed values.
_L = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_N = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_PART = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+")
_SEPARATOR = re.compile("[\x1c-\x1f]")


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@dataclass(frozen=True)
class Runs:
    """Runs of ids: where each starts in ``ids``, and its length (-1: unknown)."""

    start: np.ndarray
    size: np.ndarray
    ids: np.ndarray

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the given runs one after the other, and where each ends (with a 0 in front)."""
        n = self.size[at]
        ends = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        return self.ids[np.repeat(self.start[at] - ends[:-1], n) + np.arange(ends[-1])], ends


def _runs(parts: list[np.ndarray], dtype: str) -> Runs:
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    return Runs(np.cumsum(size) - size, size, np.concatenate(parts) if parts else np.empty(0, dtype))


class WordTable:
    """Ids of words met before by a hash of 128 bits, in ``limit`` bytes; when full it starts afresh.

    New words are sorted into a small level, which is merged into the large one now and then.
    """

    def __init__(self, limit: int, dtype: str) -> None:
        self.limit = limit
        self.dtype = dtype
        self.levels = [self._empty(), self._empty()]

    def _empty(self) -> tuple[np.ndarray, np.ndarray, Runs]:
        none = np.empty(0, np.int64)
        return none, none, Runs(none, none.astype(np.int32), np.empty(0, self.dtype))

    @staticmethod
    def keys(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        one = np.fromiter(map(hash, words), np.int64, len(words))
        return one, np.fromiter([hash(w + "\0") for w in words], np.int64, len(words))

    def bytes(self) -> int:
        return sum(x.nbytes for a, b, r in self.levels for x in (a, b, r.start, r.size, r.ids))

    def find(self, one: np.ndarray, two: np.ndarray) -> Runs:
        start, size = np.zeros(len(one), np.int64), np.full(len(one), -1, np.int64)
        before = 0
        for first, second, runs in self.levels:
            if len(first):
                at = np.minimum(np.searchsorted(first, one), len(first) - 1)
                hit = (first[at] == one) & (second[at] == two)
                start[hit] = runs.start[at[hit]] + before
                size[hit] = runs.size[at[hit]]
            before += len(runs.ids)
        return Runs(start, size, np.concatenate([r.ids for _, _, r in self.levels]))

    def add(self, one: np.ndarray, two: np.ndarray, runs: Runs) -> None:
        order = np.argsort(one)
        ids, ends = runs.take(order)
        size = np.diff(ends)
        new = one[order], two[order], Runs(ends[:-1], size.astype(np.int32), ids)
        self.levels[1] = self._merged(self.levels[1], new)
        if 4 * len(self.levels[1][0]) > len(self.levels[0][0]):
            self.levels = [self._merged(*self.levels), self._empty()]
        if self.bytes() > self.limit:
            self.levels = [self._empty(), self._empty()]

    @staticmethod
    def _merged(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray, Runs]:
        one = np.concatenate([a[0], b[0]])
        order = np.argsort(one, kind="stable")  # two sorted runs
        start = np.concatenate([a[2].start, b[2].start + len(a[2].ids)])
        size = np.concatenate([a[2].size, b[2].size])
        ids = np.concatenate([a[2].ids, b[2].ids])
        return one[order], np.concatenate([a[1], b[1]])[order], Runs(start[order], size[order], ids)


class WordIds:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        #: Narrowest type that holds every id.
        self.dtype = "<u2" if self.size <= 1 << 16 else "<u4"
        self.ends = np.zeros(self.size, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.table = WordTable(TABLE_BYTES, self.dtype)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.dtype)

    def _by_library(self, parts: list[str]) -> Runs:
        """Ids of parts by the library, many to a line."""
        found: list[Runs] = []
        for k in range(0, len(parts), 256 * 64):
            lines = [" ".join(parts[j : j + 256]) for j in range(k, min(k + 256 * 64, len(parts)), 256)]
            for j, encoding in enumerate(self.library.encode_batch_fast(lines, add_special_tokens=False)):
                group = parts[k + 256 * j : k + 256 * (j + 1)]
                flat = np.array(encoding.ids, dtype=self.dtype)
                stops = np.flatnonzero(self.ends[flat]) + 1
                if len(stops) != len(group) or stops[-1] != len(flat):
                    found.append(_runs([self._whole(p) for p in group], self.dtype))
                else:
                    starts = np.concatenate([[0], stops[:-1]])
                    found.append(Runs(starts, stops - starts, flat))
        size = np.concatenate([np.empty(0, np.int64), *(r.size for r in found)])
        ids = np.concatenate([np.empty(0, self.dtype), *(r.ids for r in found)])
        return Runs(np.cumsum(size) - size, size, ids)

    def _look_up(self, words: list[str], learn) -> Runs:
        """Runs of the words; those that the table lacks by ``learn``, which the table keeps."""
        one, two = self.table.keys(words)
        known = self.table.find(one, two)
        missing = np.flatnonzero(known.size < 0)
        if not len(missing):
            return known
        new = learn([words[k] for k in missing.tolist()])
        known.start[missing] = new.start + len(known.ids)
        known.size[missing] = new.size
        short = np.array([len(words[k]) <= LONGEST for k in missing.tolist()])
        keep = missing[short]
        self.table.add(one[keep], two[keep], Runs(new.start[short], new.size[short], new.ids))
        return Runs(known.start, known.size, np.concatenate([known.ids, new.ids]))

    def _of_new_words(self, words: list[str]) -> Runs:
        """Words of letters only by the library, others by their parts."""
        if not _is_latin("".join(words)):
            odd = [not _is_latin(w) for w in words]
            rest = self._of_new_words([w for w, x in zip(words, odd, strict=True) if not x])
            whole = _runs([self._whole(w) for w, x in zip(words, odd, strict=True) if x], self.dtype)
            start, size = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
            odd = np.array(odd)
            start[~odd], size[~odd] = rest.start, rest.size
            start[odd], size[odd] = whole.start + len(rest.ids), whole.size
            return Runs(start, size, np.concatenate([rest.ids, whole.ids]))
        mixed = [k for k, w in enumerate(words) if not w.isalpha()]
        simple = np.ones(len(words), dtype=bool)
        simple[mixed] = False
        found = [_PART.findall(words[k]) for k in mixed]
        number: dict[str, int] = {}
        at = np.array([number.setdefault(p, len(number)) for parts in found for p in parts], dtype=np.int64)
        parts = self._look_up(list(number), self._by_library) if number else _runs([], self.dtype)
        alone = self._by_library([w for w in words if w.isalpha()])
        ids, ends = parts.take(at)
        ends = ends[np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)])]
        start, size = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        start[simple], size[simple] = alone.start, alone.size
        start[~simple], size[~simple] = ends[:-1] + len(alone.ids), np.diff(ends)
        return Runs(start, size, np.concatenate([alone.ids, ids]))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, as bytes of ``dtype``; a null text has none."""
        data = pa.array(texts, pa.large_string()).buffers()[2]
        bytes_ = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
        separators = bool((bytes_ - np.uint8(0x1C) < 4).any())
        apart = [
            bool(text) and ("<|" in text or (separators and _SEPARATOR.search(text) is not None))
            for text in texts
        ]
        plain = [
            "" if not text or odd else text.lower() if _is_latin(text) else text
            for text, odd in zip(texts, apart, strict=True)
        ]
        lists = pc.utf8_split_whitespace(pa.array(plain, pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        runs = self._look_up(coded.dictionary.to_pylist(), self._of_new_words)
        flat, ends = runs.take(coded.indices.to_numpy(zero_copy_only=False))
        bounds = ends[lists.offsets.to_numpy()].tolist()
        return [
            self._whole(text).tobytes() if odd else flat[start:stop].tobytes()
            for text, odd, start, stop in zip(texts, apart, bounds[:-1], bounds[1:], strict=True)
        ]


@functools.cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)
