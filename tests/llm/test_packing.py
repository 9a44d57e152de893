import itertools
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tallyrec.llm import word_ids
from tallyrec.llm.packing import hilbert_key, pack
from tallyrec.llm.word_ids import WordIds

PATH = P.path("word_bpe_49k.json")


def test_hilbert_neighbours_touch():
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
        keys = hilbert_key(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_words_equal_library():
    import random

    own, rng = WordIds(PATH), random.Random(1)
    bits = [" ", "\n", "a", "B", "th", "'s", "'", "!", ".", ",", "é", "É", "漢", "\x00", "😀", "ﬁ", "1", "22", "_",
            "\x1c", "\x85", "\xa0", "Σ", "ς", "İ", "J̌", "µ", "ß", "<|endoftext|>", "²", "½"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 20))) for _ in range(2000)]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, own.dtype).tolist() == own.library.encode(text, add_special_tokens=False).ids


def test_word_table_is_bounded(monkeypatch):
    import random

    rng = random.Random(3)
    monkeypatch.setattr(word_ids, "TABLE_BYTES", 300_000)
    own = WordIds(PATH)
    unspaced = ["".join(chr(rng.randint(0x4E00, 0x4FFF)) for _ in range(3000)) for _ in range(2000)]
    own.encode(unspaced[:1000])
    own.encode(unspaced[1000:] + ["x" * 65])
    assert own.table.bytes() == 0  # words that long are never stored
    for k in range(40):
        words = ["".join(rng.choices("abcdefgh!.'1é", k=rng.randint(1, 9))) for _ in range(1500)]
        text = " ".join(words)
        want = own.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode([text])[0], own.dtype).tolist() == want
        assert own.table.bytes() <= 300_000


@pytest.mark.parametrize("length", [64, 4096])
def test_every_id_in_one_piece(spark, documents, length):
    long = " ".join(f"word{i}" for i in range(5000))
    rows = [(1, "the cat sat"), (2, None), (3, ""), (4, long), (5, "the cat sat"), *[(10 + i, "same text here") for i in range(50)]]
    library = Tokenizer.from_file(PATH)
    want = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows}
    got = pack(documents(rows), "doc_id", "text", PATH, 2, length).toPandas()
    for doc, pieces in got.groupby("doc_id"):
        at = 0
        for p in pieces.sort_values("start").itertuples():
            ids = np.array(want[doc][at : at + p.length], "<u4").tobytes()
            assert (p.start, p.doc_tokens, p.ids_crc32, bytes(p.ids)) == (at, len(want[doc]), zlib.crc32(ids), ids)
            at += p.length
        assert at == len(want[doc])
    sizes = []
    for _, pieces in got.groupby("sequence_id"):
        pieces = pieces.sort_values("offset")
        assert pieces.offset.tolist() == [0, *np.cumsum(pieces.length)[:-1]]
        sizes.append(int(pieces.length.sum()))
    assert max(sizes) <= length and sorted(sizes)[1:] == [length] * (len(sizes) - 1)


def test_repeated_rows_and_empty_table(spark, documents):
    got = pack(documents([(1, "a b"), (1, "a b"), (None, "c")]), "doc_id", "text", PATH, 2).toPandas()
    assert got.length.tolist().count(3) == 2 and len(got) == 3
    assert pack(documents([], "doc_id bigint, text string"), "doc_id", "text", PATH, 2).count() == 0
