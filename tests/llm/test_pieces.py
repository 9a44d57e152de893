import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest

from tallyrec.llm.pieces import PieceModel, decode_ids, encode_texts, piece_digest

MODEL = P.path("piece_bpe_32k.model")
ALPHABET = " \n\t▁abthe  ing,.é漢　\x00😀ﬁÅ\r1"
FIXED = ["", " ", "\n", "  ", "a", " a", "a ", "\na", "a\n", "a\n\n b", " \n", "\n ", "▁", "<s> </s>", "x" * 90]


@pytest.fixture(scope="module")
def model():
    return PieceModel(MODEL)


def texts(n, seed=1):
    rng = random.Random(seed)
    return FIXED + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_encoding_equals_library(model):
    found, wrong = model.encode_texts(texts(2000))
    sp = model.library
    assert wrong == 0
    for text, ids in zip(texts(2000), found, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == [sp.bos_id(), *sp.encode(text), sp.eos_id()], repr(text)


def test_heap_and_rows_agree(model):
    words = [t.replace(" ", "▁") for t in texts(500, 2) if t]
    rows = [np.frombuffer(x, "<u4").tolist() for x in model.encode_many(words)]
    assert rows == [model.encode_one(w) for w in words]


def test_decoding_equals_library(model):
    rng = random.Random(3)
    for _ in range(2000):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(259, 31999)]) for _ in range(rng.randint(0, 9))]
        assert model.decode(np.array(ids, dtype=np.int64)) == model.library.decode(ids)


def test_table_is_bounded(model, monkeypatch):
    monkeypatch.setattr("tallyrec.llm.pieces.TABLE_BYTES", 1500)
    for text in ("a b c d e f g", "h i j", "a b", "漢" * 3000, "漢字" * 2000 + " a"):
        ids, _ = model.encode_texts([text])
        assert np.frombuffer(ids[0], "<u4").tolist()[1:-1] == model.library.encode(text)
        assert len(model.cache) < 20 and max(map(len, model.cache), default=0) <= 64


def test_query_rows(spark, documents, model):
    long = " ".join(f"word{i}\n" for i in range(40_000))
    rows = [(1, "The cat"), (1, "The cat"), (2, None), (3, ""), (4, long), (None, "x")]
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in
                 piece_digest(documents(rows), "doc_id", "text", MODEL).collect())
    want = []
    for i, text in rows:
        ids = [1, *model.library.encode(text or ""), 2]
        back = model.library.decode(ids)
        want.append((i or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(want)
    empty = documents([], "doc_id bigint, text string")
    assert piece_digest(empty, "doc_id", "text", MODEL).count() == 0


def test_round_trip_of_tables(spark, documents):
    rows = [(1, "a b"), (2, "é漢\n\nx"), (3, None)]
    ids = encode_texts(documents(rows), "doc_id", "text", MODEL)
    back = {r["id"]: r["text"] for r in decode_ids(ids, "id", "ids", MODEL).collect()}
    assert back == {1: "a b", 2: "é漢\n\nx", 3: ""}
