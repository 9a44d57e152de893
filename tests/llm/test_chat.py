import collections
import hashlib
import random

import public_tokenizers as P
import pytest

from tallyrec.llm.chat import chat_forest, escape, format_turn, read_back, read_turn, unescape
from tallyrec.llm.queries import op10_chat

RANKS = P.path("byte_bpe_50k.tiktoken")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_turns_round_trip():
    rng = random.Random(2)
    bits = ["\\", "<s>", "</s>", "[INST]", "[/ROLE]", "<", ">", "a", " ", "\n", "[ROLE]", "<<SYS>>"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))
        role = rng.choice(["user", "assistant", "system", "", "x\\", "[/ROLE]", text])
        assert unescape(escape(text)) == text
        assert read_turn("".join(format_turn(role, text))) == (role, text)


def rows():
    rng = random.Random(6)
    out = []
    for conv in range(40):
        for turn in range(rng.randint(1, 6)):
            out.append((conv, turn, ("user", "assistant")[turn % 2], rng.choice(["hi", "yo", None, "</s>"])))
    out += [(50, d, "user", "hi" if d < 2 else f"t{d}") for d in range(120)]
    out += [(51, d, "user", "hi" if d < 2 else f"t{d}") for d in range(100)]
    out += [(None, 1, "user", "n"), (None, 0, None, "m"), (60, None, "tool", "x"), (61, 0, "user", "same"), (61, 0, "user", "same"),
            (62, 0, "assistant", "word " * 50_000)]
    return out


def ordered():
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows():
        by[conv].append((-1 if turn is None else turn, role or "", text or ""))
    return {c: [x[1:] for x in sorted(g)] for c, g in by.items()}


@pytest.fixture(scope="module")
def forest(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3).selectExpr("*", "1 as key", "2 as i", "3 as chain")
    return chat_forest(df, RANKS, P.PATTERN)


def test_read_back(forest):
    got = {r["conv_id"]: r for r in read_back(forest).collect()}
    want = ordered()
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), digest)
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] == sum(len("".join(format_turn(*t))) for t in turns)


def test_shared_turns_stand_once_depth_first(forest):
    turns = sorted(forest.turns.collect(), key=lambda r: r["start"])
    at = 0
    for t in turns:
        assert t["start"] == at and len(t["tokens"]) == 4 * t["n_tokens"]
        at += t["n_tokens"]
    prefixes = {tuple(g[:n]) for g in ordered().values() for n in range(1, len(g) + 1)}
    assert len(turns) == len(prefixes)
    by = {t["start"]: t for t in turns}
    for conv in forest.conversations.collect():
        held, position = [], 0
        for start in conv["starts"]:
            t = by[start]
            spans = [(x["from"], x["to"]) for x in t["ancestors"]]
            assert t["position"] == position
            assert sorted(i for a, b in spans for i in range(a, b)) == sorted(held)
            assert all(x[1] != y[0] for x, y in zip(spans, spans[1:], strict=False))
            held += range(start, start + t["n_tokens"])
            position += t["n_tokens"]


def test_mask_of_tokens(forest):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    import numpy as np

    for t in forest.turns.collect():
        ids = np.frombuffer(t["tokens"], "<u4").tolist()
        assert encoding.decode(ids) == t["text"]
        assert encoding.decode(ids[t["mask_from"] : t["mask_to"]]) == t["text"][t["text_from"] : t["text_to"]]


def test_query_and_empty_table(spark):
    got = {r["conv_id"]: r for r in op10_chat(spark, "/root/testdata/sf0.001").collect()}
    said = "</s>[INST] ok [/INST]"
    assert got[-7]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest() and got[-7]["n_turns"] == 2
    assert read_back(chat_forest(spark.createDataFrame([], SCHEMA), RANKS, P.PATTERN)).count() == 0
