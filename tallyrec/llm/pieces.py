"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding follows the merge rule of the vocabulary: among all adjacent pairs of
symbols whose joined string is a piece, the best-scored pair (the leftmost of
equals) is merged first. `encode_one` keeps these pairs in an agenda (a heap);
`encode_many` keeps one agenda row per string for thousands of strings at once.
No piece holds a word-start mark after another character, and no piece joins a
line break to anything, so a text is the concatenation of independent words;
each distinct word is encoded once per batch and remembered in a bounded table.
Every newly encoded word is compared with the sentencepiece library, batch by
batch; where they ever differ, the library's ids are used and counted.

Defined results: a null text is treated as empty (begin and end ids only); extra
columns of the input are ignored by `encode_texts`; repeated rows are encoded
alike and kept; an empty table gives an empty table.
"""

from __future__ import annotations

import array
import codecs
import functools
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyrec.llm.batches import map_arrow, text_groups

MARK = "▁"
#: Bytes of the words that a worker remembers (beyond them the table starts afresh), the longest word
#: among them, and about what an entry takes besides its text and its ids.
TABLE_BYTES = 96 << 20
LONGEST = 64
_ENTRY_BYTES = 200
#: Strings longer than this use the heap.
_WIDE = 32
_NEVER = np.int32(2**31 - 1)

ENCODED = "id bigint, ids binary, n_disagree bigint"


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("tallyrec_each_byte", _each_byte)


class PieceModel:
    """A merge-type vocabulary with byte fallback and identity normalisation."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.library = sp = SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(size)]
        normal = {p: i for i, p in enumerate(pieces) if not special[i]}
        if any(sp.is_unused(i) for i in range(size)):
            raise ValueError("unused pieces are not supported")
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(sp.is_byte(i) for i in self.byte_ids):
            raise ValueError("the vocabulary has no byte fallback")
        if any(p.strip(MARK) and MARK in p[1:].lstrip(MARK) for p in normal):
            raise ValueError("a piece crosses a word start")
        probe = "A ﬁ  b "
        if sp.decode(sp.encode(probe)) != probe:
            raise ValueError("only vocabularies that keep the text as it is are supported")
        inner = {c for p in normal if len(p) > 1 for c in p}
        if "\n" in inner:
            raise ValueError("a piece joins a line break to other characters")
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        # symbols: pieces by id, then characters that only occur inside longer pieces
        self.symbol = {p: i for p, i in normal.items()}
        for c in sorted(inner - normal.keys()):
            self.symbol[c] = size + len(self.symbol)
        order = sorted((i for p, i in normal.items() if len(p) > 1), key=lambda i: (-sp.get_score(i), i))
        # equal scores share a rank: the leftmost of them goes first
        place = {x: k for k, x in enumerate(dict.fromkeys(sp.get_score(i) for i in order))}
        pairs = {}
        for p, i in normal.items():
            for cut in range(1, len(p)):
                a, b = self.symbol.get(p[:cut]), self.symbol.get(p[cut:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = (place[sp.get_score(i)], i)
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        values = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int32)
        self.pair_ranks, self.pair_pieces = values.T.copy()
        self.vocabulary = set(normal.values())
        self.of_code = np.full(0x110000, -1, dtype=np.int32)
        for p, i in self.symbol.items():
            if len(p) == 1:
                self.of_code[ord(p)] = i
        self.shown = [
            bytes([self.byte_ids.index(i)])
            if sp.is_byte(i)
            else b""
            if sp.is_control(i)
            else " ⁇ ".encode()
            if sp.is_unknown(i)
            else pieces[i].replace(MARK, " ").encode()
            for i in range(size)
        ]
        self.is_control = np.array([sp.is_control(i) for i in range(size)])
        self.starts_word = np.zeros(size, dtype=bool)
        self.starts_word[[i for p, i in normal.items() if p[0] == MARK]] = True
        self.cache: dict[str, bytes] = {}
        self.held = 0

    # -- encoding ---------------------------------------------------------

    def _ids(self, symbols: Iterable[tuple[int, str]]) -> list[int]:
        out: list[int] = []
        for symbol, text in symbols:
            if symbol in self.vocabulary:
                out.append(symbol)
            else:
                out.extend(self.byte_ids[b] for b in text.encode())
        return out

    def encode_one(self, word: str) -> list[int]:
        """Ids of one string without begin and end, by a heap of adjacent pairs."""
        n = len(word)
        symbol = [self.symbol.get(c, -1) for c in word]
        text, after, before = list(word), list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            found = self.pairs.get(symbol[i] << 20 | symbol[j]) if min(symbol[i], symbol[j]) >= 0 else None
            if found is not None:
                heapq.heappush(agenda, (found[0], i, symbol[i], symbol[j], found[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, left, right, piece = heapq.heappop(agenda)
            j = after[i]
            if j >= n or symbol[i] != left or symbol[j] != right:
                continue  # one of the two was merged meanwhile
            symbol[i], text[i] = piece, text[i] + text[j]
            symbol[j] = -2
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        i, found = 0, []
        while i < n:
            found.append((symbol[i], text[i]))
            i = after[i]
        return self._ids(found)

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; _NEVER where the two do not join."""
        keys = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        found = (self.pair_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.pair_ranks[at], _NEVER)

    def _merge_rows(self, symbols: np.ndarray) -> np.ndarray:
        """Merges every row of a padded matrix to its end; -1 marks an unknown, -9 a pad."""
        done = np.full(symbols.shape, -9, dtype=np.int32)
        rows = np.arange(len(symbols))
        ranks = self._lookup(symbols[:, :-1], symbols[:, 1:])
        while True:
            if ranks.shape[1]:
                best = ranks.argmin(axis=1)
                open_ = ranks[np.arange(len(rows)), best] < _NEVER
            else:
                open_ = np.zeros(len(rows), dtype=bool)
            done[rows[~open_], : symbols.shape[1]] = symbols[~open_]
            if not open_.any():
                return done
            rows, symbols, ranks, best = rows[open_], symbols[open_], ranks[open_], best[open_]
            line = np.arange(len(rows))
            left, right = symbols[line, best], symbols[line, best + 1]
            keys = left.astype(np.int64) << 20 | right
            symbols[line, best] = self.pair_pieces[np.searchsorted(self.pair_keys, keys)]
            width = symbols.shape[1] - 1
            at = np.arange(width)
            symbols = np.take_along_axis(symbols, at + (at > best[:, None]), axis=1)
            at = np.arange(width - 1)
            ranks = np.take_along_axis(ranks, at + (at >= best[:, None]), axis=1)
            if width > 1:
                k = np.flatnonzero(best > 0)
                ranks[k, best[k] - 1] = self._lookup(symbols[k, best[k] - 1], symbols[k, best[k]])
                k = np.flatnonzero(best < width - 1)
                ranks[k, best[k]] = self._lookup(symbols[k, best[k]], symbols[k, best[k] + 1])

    def encode_many(self, words: list[str]) -> list[bytes]:
        """Ids of each string as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        start = 0
        while start < len(order):
            longest = len(words[order[start]])
            if longest > _WIDE:
                for i in order[start:]:
                    out[i] = np.array(self.encode_one(words[i]), dtype="<u4").tobytes()
                break
            wide = max(4, (longest + 3) // 4 * 4)
            stop = start
            while stop < len(order) and len(words[order[stop]]) <= wide:
                stop += 1
            group = order[start:stop]
            codes = np.frombuffer("".join(words[i] for i in group).encode("utf-32-le"), dtype="<u4")
            lengths = np.array([len(words[i]) for i in group])
            symbols = np.full((len(group), wide), -9, dtype=np.int32)
            symbols[np.arange(wide) < lengths[:, None]] = self.of_code[codes]
            merged = self._merge_rows(symbols)
            used = merged != -9
            # a symbol that is no piece is one character: its bytes stand for it
            odd = (used & ((merged < 0) | (merged >= len(self.shown)))).any(axis=1).tolist()
            data = merged[used].astype("<u4").tobytes()
            ends = (4 * np.cumsum(used.sum(axis=1))).tolist()
            at = 0
            for i, end, bad in zip(group, ends, odd, strict=True):
                out[i] = data[at:end]
                if bad:
                    out[i] = np.array(self.encode_one(words[i]), dtype="<u4").tobytes()
                at = end
            start = stop
        return out

    def _checked(self, words: list[str]) -> tuple[list[bytes], int]:
        """`encode_many`, compared with the library."""
        own = self.encode_many(words)
        lead = [0 if w[:1] == MARK else 2 for w in words]
        texts = [w[1:].replace(MARK, " ") if w[:1] == MARK else "\n" + w.replace(MARK, " ") for w in words]
        wrong = 0
        pack = array.array
        for k, ids in enumerate(self.library.encode(texts, num_threads=1) if texts else []):
            if words[k] == MARK:
                ids = [self.symbol[MARK]]
            theirs = pack("I", ids[lead[k] :] if lead[k] else ids).tobytes()
            if theirs != own[k] and words[k]:
                own[k], wrong = theirs, wrong + 1
        return own, wrong

    def _words(self, text: str) -> list[str]:
        """Keys of the word table: a word without its mark, or a line break and what follows.

        Keys with the mark inside them stand for themselves (runs of spaces).
        """
        text = text.replace(MARK, " ")
        if not ("  " in text or " \n" in text or text[:1] == " " or text[-1:] == " "):
            return text.replace("\n", " \n").split(" ")
        marked = MARK + text.replace(" ", MARK)
        return [
            k[1:] if k[:1] == MARK and k[1:2] not in (MARK, "") else k
            for k in re.findall(f"\n[^{MARK}\n]*|{MARK}*[^{MARK}\n]+|{MARK}+", marked)
        ]

    def _learn(self, keys: list[str]) -> int:
        """Adds words to the table; returns how often the library disagreed."""
        words = [
            k[1:] if k[:1] == "\n" else k if k[:1] == MARK else MARK + k for k in keys
        ]
        found, wrong = self._checked(words)
        newline = np.array([self.byte_ids[10]], dtype="<u4").tobytes()
        for key, ids in zip(keys, found, strict=True):
            self.cache[key] = newline + ids if key[:1] == "\n" else ids
            self.held += _ENTRY_BYTES + 2 * len(key) + len(ids)
        return wrong

    def _trim(self, new: Iterable[str]) -> None:
        """Forgets long words, and all of them if the table is full."""
        for key in new:
            if len(key) > LONGEST:
                self.held -= _ENTRY_BYTES + 2 * len(key)
                del self.cache[key]
        if self.held > TABLE_BYTES:
            self.cache.clear()
            self.held = 0

    def encode_texts(self, texts: list[str | None]) -> tuple[list[bytes], int]:
        """Ids of whole texts with begin and end; and the number of corrected words."""
        split = [self._words(t) if t else [] for t in texts]
        missing = set().union(*split) - self.cache.keys()
        wrong = self._learn(list(missing)) if missing else 0
        begin, end = (np.array([i], dtype="<u4").tobytes() for i in (self.begin, self.end))
        get = self.cache.__getitem__
        found = [begin + b"".join(map(get, words)) + end for words in split]
        self._trim(missing)
        return found, wrong

    # -- decoding ---------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """The text of any sequence of ids, as the library's decode gives it."""
        control = np.flatnonzero(self.is_control[ids])
        if len(control) and (len(control) > 2 or control[0] or control[-1] not in (0, len(ids) - 1)):
            runs = np.split(ids, control)  # bytes either side of a control id don't join
        else:
            runs = [ids]
        data = [b"".join(map(self.shown.__getitem__, run.tolist())) for run in runs]
        shown = ids[~self.is_control[ids]]
        if len(shown) and self.starts_word[shown[0]]:
            first = next(k for k, x in enumerate(data) if x)
            data[first] = data[first][1:]
        return "".join(x.decode("utf-8", "tallyrec_each_byte") for x in data)


@functools.cache
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_texts(df: DataFrame, id_column: str, text_column: str, model: str) -> DataFrame:
    """Per row: id, ids (little-endian unsigned 32-bit) and corrected words of its group."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model)
        for batch in batches:
            for start, texts in text_groups(batch, 1):
                ids, wrong = pieces.encode_texts(texts)
                counts = [wrong, *[0] * (len(ids) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)).cast(pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(counts, pa.int64()),
                    ],
                    ["id", "ids", "n_disagree"],
                )

    return map_arrow(df, [id_column, text_column], run, ENCODED)


def decode_ids(df: DataFrame, id_column: str, ids_column: str, model: str) -> DataFrame:
    """Per row: id and the text of its ids; null ids give a null text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model)
        for batch in batches:
            texts = [
                None if x.as_py() is None else pieces.decode(np.frombuffer(x.as_py(), "<u4"))
                for x in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(texts, pa.string())], ["id", "text"]
            )

    return map_arrow(df, [id_column, ids_column], run, "id bigint, text string")


def piece_digest(df: DataFrame, id_column: str, text_column: str, model: str) -> DataFrame:
    """Encodes and decodes every text in one pass; see the query's contract."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model)
        for batch in batches:
            for start, texts in text_groups(batch, 1):
                encoded, wrong = pieces.encode_texts(texts)
                n = len(texts)
                back = [pieces.decode(np.frombuffer(x, "<u4")) for x in encoded]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, n).cast(pa.int64()),
                        pa.array([len(x) // 4 for x in encoded], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in encoded], pa.string()),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back], pa.string()),
                        pa.array([wrong, *[0] * (n - 1)], pa.int64()),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_disagree"],
                )

    return map_arrow(
        df,
        [id_column, text_column],
        run,
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_disagree bigint",
    )
