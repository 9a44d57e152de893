"""Quality classification from weak labels.

Ten heuristic labellers look at a text, each voting good, bad or nothing. How often
each is right is estimated from their overlaps alone: expectation-maximisation over the
vote patterns of all documents (at most ``3 ** 10`` distinct ones reach the driver, with
their counts). The posterior of a pattern is the soft label of its documents, and those
labels train a linear scorer over hashed features of the raw text. The scorer decides;
it also judges texts on which most labellers stay silent.

The scorer is fitted on about ``SAMPLE`` documents (a documented bound; rows are chosen
by a hash of their id); votes, patterns and scores cover all documents and whole texts.
Given labels are never used.

Defined results: a null, empty or blank text scores 0 and is rejected; if there is
nothing to learn from, scores are the posteriors' prior 0.5 and texts are kept; repeated
rows get equal scores; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.batches import keep_rows, map_arrow, text_groups
from tallyrec.llm.linear import fit_logistic, pack_sparse, sampled, sigmoid, unpack_sparse
from tallyrec.llm.shingles import word_hashes

SAMPLE = 3000
SLOTS = 1 << 12
KEEP = 0.5
ROUNDS = 100

#: Votes: 0 bad, 1 none, 2 good.
LABELLERS = (
    "signs",
    "signed_words",
    "bare_words",
    "letters",
    "capitals",
    "shouts",
    "stutter",
    "loops",
    "prose",
    "word_length",
)
_BAD, _NONE, _GOOD = 0, 1, 2

_SIGNS = b"#$%&*=<>{}[]\\^~_@|"
#: Kinds of bytes: letters and digits 0, blanks 1, signs 2, punctuation 3.
_AT_BLANK, _AT_SIGN = 1, 2
_KIND = np.full(256, 3, dtype=np.uint8)
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 0
_KIND[list(b" \n\t\r\v\f")] = _AT_BLANK
_KIND[list(_SIGNS)] = _AT_SIGN
_SHOUT = np.zeros(256, dtype=bool)
_SHOUT[list(b"!?")] = True


@dataclass(frozen=True)
class Shape:
    """Measurements of one text, from its bytes and word hashes."""

    counts: np.ndarray
    words: np.ndarray
    data: np.ndarray

    @staticmethod
    def of(text: str) -> Shape:
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        return Shape(np.bincount(data, minlength=256), word_hashes(text), data)

    def share(self, characters: bytes) -> float:
        return self.counts[list(characters)].sum() / max(1, len(self.data))

    @property
    def lower(self) -> int:
        return int(self.counts[97:123].sum())

    @property
    def upper(self) -> int:
        return int(self.counts[65:91].sum())

    @property
    def blanks(self) -> int:
        return int(self.counts[list(b" \n\t\r\v\f")].sum())

    def stutter(self) -> float:
        """Share of words equal to the one before."""
        return float((self.words[1:] == self.words[:-1]).mean()) if len(self.words) > 1 else 0.0

    def fresh(self) -> float:
        """Share of distinct three-word runs."""
        w = self.words
        if len(w) < 6:
            return 1.0
        runs = (w[:-2] * np.uint64(3) + w[1:-1]) * np.uint64(0x9E3779B97F4A7C15) + w[2:]
        return len(np.unique(runs)) / len(runs)


def votes(shape: Shape) -> list[int]:
    """One vote per labeller; most of them only ever object."""
    words, data = len(shape.words), shape.data
    many = words >= 8
    ascii_letters = shape.lower + shape.upper
    letters = (ascii_letters + int(shape.counts[48:58].sum() + shape.counts[128:].sum())) / max(1, len(data) - shape.blanks)
    capitals = shape.upper / ascii_letters if ascii_letters >= 20 else 0.0
    kind = _KIND[data]
    last = kind[:-1][kind[1:] == _AT_BLANK]  # what stands before a blank
    signed = float((last == _AT_SIGN).mean()) if len(last) else 0.0
    # a sign between blanks is a word of its own
    inner = (kind[1:-1] >= _AT_SIGN) & (kind[:-2] == _AT_BLANK) & (kind[2:] == _AT_BLANK)
    bare = float(inner.sum()) / max(1, words)
    doubled = (data[1:] == data[:-1]) & _SHOUT[data[1:]]
    shouts = float(doubled.sum()) / max(1, words)
    stutter, fresh = shape.stutter(), shape.fresh()
    length = (len(data) - shape.blanks) / max(1, words)
    prose = letters > 0.9 and capitals < 0.25 and stutter < 0.03 and fresh > 0.9 and bare < 0.02
    bad = [
        shape.share(_SIGNS) > 0.03,
        many and signed > 0.25,
        many and bare > 0.1,
        many and letters < 0.85,
        capitals > 0.5,
        many and shouts > 0.2,
        many and stutter > 0.15,
        many and fresh < 0.6,
        False,
        length > 14,
    ]
    good = {8: prose and many, 9: many and prose and 3 <= length <= 9}
    return [_BAD if b else _GOOD if good.get(k) else _NONE for k, b in enumerate(bad)]


def estimate_accuracies(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns: accuracy of each labeller, posterior and prior of good.

    ``patterns`` is (patterns x labellers) of 0, 1, 2. A labeller is right with one
    probability wherever it votes; silence says nothing. Accuracies start at 0.8 and stay
    above one half, which fixes which class is the good one.
    """
    voted = patterns != _NONE
    sign = patterns - 1.0
    accuracy, prior = np.full(patterns.shape[1], 0.8), 0.7
    good = np.full(len(patterns), prior)
    for _ in range(rounds):
        weight = np.log(accuracy / (1 - accuracy))
        new = sigmoid(np.log(prior / (1 - prior)) + sign @ weight)
        right = np.where(patterns == _GOOD, new[:, None], 1 - new[:, None]) * voted
        # two right and half a wrong vote stand for what is known before any text is seen
        accuracy = (counts @ right + 2) / (counts @ voted + 2.5)
        accuracy = np.clip(accuracy, 0.55, 0.99)
        prior = float(np.clip((counts @ new + 1) / (counts.sum() + 2), 0.05, 0.95))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return accuracy, good, prior


#: Byte classes of the hashed features: lower, upper, digit, blank, line end, high byte; signs as they are.
_CLASS = np.arange(256, dtype=np.uint64)
for _low, _high, _as in ((97, 123, 1), (65, 91, 2), (48, 58, 3), (128, 256, 1), (9, 10, 4), (32, 33, 4)):
    _CLASS[_low:_high] = _as


def hashed_features(shape: Shape) -> np.ndarray:
    """Shares of hashed class n-grams (1 to 4 bytes), and word repetition in slots of its own."""
    c = _CLASS[shape.data]
    grams, code = [], c
    for n in range(1, 5):
        grams.append(code * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n))
        if len(c) <= n:
            break
        code = code[:-1] * np.uint64(257) + c[n:]
    parts = [(g * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(53)).astype(np.int64) for g in grams]
    out = np.zeros(SLOTS, dtype=np.float32)
    for part in parts:
        out[: SLOTS // 2] += np.sqrt(np.bincount(part, minlength=SLOTS // 2) / max(1, len(part)) / 4)
    at = SLOTS // 2
    for value in (shape.stutter(), 1 - shape.fresh()):
        out[at + min(15, int(16 * value))] = 0.5  # a bucket of the value, as a hashed name would be
        out[at + 16] = value
        at += 32
    # a short text says little: its features count less
    return out * np.float32(min(1.0, (len(shape.data) / 60) ** 0.5))


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    offset: float
    #: of each labeller, where it votes
    accuracy: dict[str, float]
    prior: float


def _pattern_code(vote: list[int]) -> int:
    code = 0
    for v in vote:
        code = 3 * code + v
    return code


def _unpack_code(code: int) -> list[int]:
    out = []
    for _ in LABELLERS:
        code, v = divmod(code, 3)
        out.append(v)
    return out[::-1]


def vote_patterns(df: DataFrame, text_column: str) -> DataFrame:
    """(pattern, n) over all documents with words; at most 3 ** labellers rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [_pattern_code(votes(Shape.of(t))) for t in batch.column(0).to_pylist() if t and t.split()]
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64())], ["pattern"])

    found = map_arrow(df, [text_column], run, "pattern bigint")
    return found.groupBy("pattern").agg(F.count("*").alias("n"))


def fit_quality(
    df: DataFrame, id_column: str, text_column: str, sample: int = SAMPLE
) -> QualityModel | None:
    rows = vote_patterns(df, text_column).collect()
    if not rows:
        return None
    codes = [r["pattern"] for r in rows]
    counts = np.array([r["n"] for r in rows], dtype=np.float64)
    accuracy, good, prior = estimate_accuracies(np.array([_unpack_code(c) for c in codes]), counts)
    named = dict(zip(LABELLERS, accuracy.tolist(), strict=True))
    label = dict(zip(codes, good.tolist(), strict=True))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Shape.of(t) for t in batch.column(0).to_pylist() if t and t.split()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_pattern_code(votes(s)) for s in found], pa.int64()),
                    pa.array([pack_sparse(hashed_features(s)) for s in found], pa.binary()),
                ],
                ["pattern", "features"],
            )

    share = float(min(1.0, sample / counts.sum()))
    chosen = df.where(sampled(F.col(f"`{id_column}`").cast("bigint"), share, 11))
    rows = (
        map_arrow(chosen, [text_column], run, "pattern bigint, features binary")
        .orderBy("pattern", "features")
        .limit(4 * sample)
        .collect()
    )
    if not rows:
        return QualityModel(np.zeros((SLOTS, 1), np.float32), 0.0, named, prior)
    x = np.stack([unpack_sparse(bytes(r["features"]), SLOTS) for r in rows])
    y = np.array([[label[r["pattern"]]] for r in rows], dtype=np.float32)
    weights, offset = fit_logistic(x, y)
    return QualityModel(weights, float(offset[0]), named, prior)


def _scores(texts: list[str | None], model: QualityModel | None) -> np.ndarray:
    scores = np.zeros(len(texts))
    at = [k for k, t in enumerate(texts) if t and t.split()]
    if at and model is None:
        scores[at] = KEEP
    elif at and model:
        x = np.stack([hashed_features(Shape.of(texts[k])) for k in at])
        scores[at] = sigmoid(x @ model.weights[:, 0] + model.offset)
    return scores


def keep_good(df: DataFrame, text_column: str, model: QualityModel | None) -> DataFrame:
    """Rows, as they are, whose text scores high enough."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    return keep_rows(df, text_column, lambda texts: (_scores(texts, shared.value) >= KEEP).tolist())


def score_quality(df: DataFrame, id_column: str, text_column: str, model: QualityModel | None) -> DataFrame:
    """Per row: id, score from 0 to 1, kept."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_groups(batch, 1):
                scores = _scores(texts, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)).cast(pa.int64()),
                        pa.array(scores),
                        pa.array(scores >= KEEP),
                    ],
                    ["doc_id", "score", "kept"],
                )

    return map_arrow(df, [id_column, text_column], run, "doc_id bigint, score double, kept boolean")
