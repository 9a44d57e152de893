"""Language identification with error-correcting output codes.

Every learned language has a codeword of bits; one linear classifier over hashed
character n-grams (1 to 3 letters, words bounded by blanks) predicts each bit. A text
gets the language whose codeword is nearest: losses of the bits, weighted by how well
each bit could be learned, are summed per codeword. The score is the share of the
chosen codeword in the soft-min over all; below ``CLEAR`` the text is flagged ambiguous.

The model is fitted on about ``SAMPLE`` labelled texts, spread evenly over the languages
(a documented bound; the rows are chosen by a hash of their id). Prediction reads whole
texts of all rows and nothing but the text.

Defined results: a null text, or one without a letter, is `und` with score 0 and
ambiguous; so is every text if nothing could be learned; repeated rows get equal
results; equal distances go to the language first in order; an empty table gives an
empty table; a null id counts as empty text for the fold; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.batches import keep_rows, map_arrow, text_groups
from tallyrec.llm.linear import fit_logistic, pack_sparse, sampled, sigmoid, unpack_sparse

UNKNOWN = "und"
SLOTS = 1 << 13
SAMPLE = 2000
CLEAR = 0.6
#: Sharpness of the soft-min over codeword distances.
SHARP = 2.0


def held_out(id_column: str) -> Column:
    """The fold no model learns from: crc32 of the id as text, modulo 4, is 2."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2


@functools.cache
def _letters() -> np.ndarray:
    out = np.zeros(0x110000, dtype=bool)
    out[[c for c in range(0x110000) if chr(c).isalpha()]] = True
    return out


def ngram_features(text: str | None) -> np.ndarray | None:
    """Square roots of the shares of hashed n-grams; None without a letter."""
    if not text:
        return None
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[code]
    if not letter.any():
        return None
    # one blank between words, and at both ends
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    symbols = np.concatenate([[0], np.where(letter, code, 0)[keep], [0]]).astype(np.uint64)
    one = symbols[symbols > 0]
    two = symbols[:-1] * np.uint64(0x9E3779B1) + symbols[1:] + np.uint64(1 << 40)
    three = two[:-1] * np.uint64(0x85EBCA77) + symbols[2:] + np.uint64(1 << 41)
    both = np.concatenate([one, two, three]) * np.uint64(0xC2B2AE3D27D4EB4F)
    counts = np.bincount((both >> np.uint64(51)).astype(np.int64), minlength=SLOTS)
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def codewords(classes: int, seed: int = 5) -> np.ndarray:
    """Bits (0 or 1) by class: all useful splits for few classes, else the best of random ones."""
    if classes <= 7:
        columns = [
            [column >> k & 1 for k in range(classes)] for column in range(1, 1 << max(classes - 1, 1))
        ]
        return np.array(columns, dtype=np.float32).T[:classes]
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(classes)))
    best, apart = None, -1
    for _ in range(50):
        code = rng.integers(0, 2, (classes, bits))
        distance = (code[:, None] != code[None]).sum(axis=2) + bits * np.eye(classes, dtype=int)
        if distance.min() > apart:
            best, apart = code, distance.min()
    return best.astype(np.float32)


@dataclass(frozen=True)
class LanguageModel:
    names: list[str]
    code: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray
    trust: np.ndarray

    def decode(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest codeword and its share, by row."""
        margin = features @ self.weights + self.offsets
        # log loss of each bit being 1 and being 0
        if_one, if_zero = np.logaddexp(0, -margin), np.logaddexp(0, margin)
        distance = (if_one * self.trust) @ self.code.T + (if_zero * self.trust) @ (1 - self.code).T
        near = np.exp(-SHARP * (distance - distance.min(axis=1, keepdims=True)))
        best = distance.argmin(axis=1)
        return best, near[np.arange(len(best)), best] / near.sum(axis=1)


def fit_languages(
    df: DataFrame, id_column: str, text_column: str, lang_column: str, sample: int = SAMPLE
) -> LanguageModel | None:
    """Learns from rows outside the held-out fold that have a language; None without any."""
    labelled = df.where(F.col(lang_column).isNotNull() & ~held_out(id_column)).select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(text_column).alias("text"),
        F.col(lang_column).alias("lang"),
    )
    # one row per language
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    each = max(1, sample // len(counts))
    shares = F.lit(0.0)
    for lang, n in counts.items():
        shares = F.when(F.col("lang") == lang, float(min(1.0, each / n))).otherwise(shares)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_groups(batch, 0):
                rows = [ngram_features(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(start, len(texts)),
                        pa.array([None if r is None else pack_sparse(r) for r in rows], pa.binary()),
                    ],
                    ["lang", "features"],
                )

    chosen = labelled.where(sampled(F.col("id"), shares, 7))
    found = map_arrow(chosen, ["text", "lang"], run, "lang string, features binary")
    rows = found.where("features is not null").orderBy("lang", "features").limit(4 * sample).collect()
    names = sorted({r["lang"] for r in rows})
    if not names:
        return None
    x = np.stack([unpack_sparse(bytes(r["features"]), SLOTS) for r in rows])
    label = np.array([names.index(r["lang"]) for r in rows])
    code = codewords(len(names))
    weights, offsets = fit_logistic(x, code[label])
    right = ((sigmoid(x @ weights + offsets) > 0.5) == (code[label] > 0.5)).mean(axis=0)
    trust = np.maximum(2 * right - 1, 0.01)
    return LanguageModel(names, code, weights, offsets, (trust / trust.mean()).astype(np.float32))


def _decoded(texts: list[str | None], model: LanguageModel | None) -> tuple[list[str], np.ndarray]:
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    rows = [ngram_features(t) if model else None for t in texts]
    at = [k for k, r in enumerate(rows) if r is not None]
    if at and model:
        best, scores[at] = model.decode(np.stack([rows[k] for k in at]))
        for k, c in zip(at, best.tolist(), strict=True):
            names[k] = model.names[c]
    return names, scores


def keep_known(df: DataFrame, text_column: str, model: LanguageModel | None) -> DataFrame:
    """Rows, as they are, whose text is clearly in a learned language."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    return keep_rows(df, text_column, lambda texts: (_decoded(texts, shared.value)[1] >= CLEAR).tolist())


def predict_languages(
    df: DataFrame, id_column: str, text_column: str, model: LanguageModel | None
) -> DataFrame:
    """Per row: id, lang_pred, score from 0 to 1, ambiguous."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_groups(batch, 1):
                names, scores = _decoded(texts, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)).cast(pa.int64()),
                        pa.array(names, pa.string()),
                        pa.array(scores.astype(np.float64)),
                        pa.array(scores < CLEAR),
                    ],
                    ["doc_id", "lang_pred", "score", "ambiguous"],
                )

    return map_arrow(
        df,
        [id_column, text_column],
        run,
        "doc_id bigint, lang_pred string, score double, ambiguous boolean",
    )
