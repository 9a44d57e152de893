import collections
import random
import re

import pytest

from tallyrec.llm import jaccard
from tallyrec.operators.components import components
from tallyrec.llm.jaccard import _signatures, jaccard_join, one_of_each


def shingles(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute(rows, percent=80):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    links = set()
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
                if a != b:
                    links.add((a, b) if i < j else (b, a))
    return {i: (len(sets[i]), top(i)) for i in sets}, links


def corpus(seed=3):
    rng = random.Random(seed)
    rows, k = [], 0
    for length in (12, 25, 60, 200):
        base = [f"b{length}w{j}" for j in range(length)]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randint(0, max(1, length // 30))):
                words[rng.randrange(length)] = f"new{rng.randint(0, 9)}"
            k += 1
            rows.append((k, " ".join(words)))
    for n in range(1, 12):
        for _ in range(5):
            words = [f"w{j}" for j in range(n)]
            if rng.random() < 0.6:
                words[rng.choice([0, -1])] = f"q{rng.randint(0, 3)}"
            k += 1
            rows.append((k, " ".join(words)))
    # a passage that texts of their own share
    shared = " ".join(f"s{j}" for j in range(60))
    for d in range(20):
        k += 1
        rows.append((k, shared + " " + " ".join(f"d{d}x{j}" for j in range(12))))
    rows += [(k + 1, None), (k + 2, ""), (k + 3, " \n"), (k + 4, "É é A a B"), (k + 5, "É é a a b")]
    return rows


@pytest.mark.parametrize("boundary", [None, 1, 30])
def test_components_equal_brute_force(spark, documents, boundary, monkeypatch):
    if boundary:
        monkeypatch.setattr(jaccard, "light_boundary", lambda *a: boundary)
    rows = corpus()
    want, _ = brute(rows)
    found = jaccard_join(documents(rows), "doc_id", "text").documents().collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want


def test_all_links(spark, documents):
    rows = corpus(5)
    want, links = brute(rows)
    joined = jaccard_join(documents(rows), "doc_id", "text", all_links=True)
    text = dict(rows)
    found = {frozenset((shingles(text[r["a"]]), shingles(text[r["b"]]))) for r in joined.links.collect()}
    assert found == {frozenset(x) for x in links}
    assert {r["doc_id"]: r["component_id"] for r in joined.documents().collect()} == {i: c for i, (_, c) in want.items()}


def test_repeated_rows_and_empty_table(spark, documents):
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (3, "a b c d e f"), (9, None), (9, None)]
    found = jaccard_join(documents(rows), "doc_id", "text").documents().collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == [
        (3, 2, 3), (7, 2, 3), (7, 2, 3), (9, 0, 9), (9, 0, 9)]
    kept = one_of_each(documents(rows), "doc_id", "text")
    assert kept.columns == documents(rows).columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(3, "a b c d e f"), (9, None)]
    empty = documents([], "doc_id bigint, text string")
    assert jaccard_join(empty, "doc_id", "text").documents().count() == 0
    assert one_of_each(empty, "doc_id", "text").count() == 0


def test_repeated_ids_with_unlike_texts(spark, documents):
    a, b = "a b c d e f g", "p q r s t u v"
    rows = [(1, a), (1, b), (2, b), (3, a), (None, a), (None, a), (4, "x"), (4, None), (4, ""), (5, "lone"), (5, "alone")]
    found = jaccard_join(documents(rows), "doc_id", "text").documents().collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in found) == [
        (0, 1), (0, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (4, 4), (5, 5), (5, 5)]
    kept = sorted(((r["doc_id"] or 0, r["text"] or "") for r in one_of_each(documents(rows), "doc_id", "text").collect()))
    assert kept == [(0, a), (0, a), (1, a), (1, b), (4, ""), (4, "x"), (5, "alone"), (5, "lone")]


def test_rows_without_id_link_others(spark, documents):
    words = [f"w{k}" for k in range(40)]
    texts = [" ".join(words), " ".join(["x", *words[1:]]), " ".join(["x", *words[1:-1], "y"])]
    assert 100 * len(shingles(texts[0]) & shingles(texts[2])) >= 80 * len(shingles(texts[0]) | shingles(texts[2]))
    texts[2] = " ".join(["x", *words[1:-4], "y", "z", "z", "z"])
    assert 100 * len(shingles(texts[0]) & shingles(texts[2])) < 80 * len(shingles(texts[0]) | shingles(texts[2]))
    rows = [(3, texts[0]), (None, texts[1]), (8, texts[2])]
    found = jaccard_join(documents(rows), "doc_id", "text").documents().collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {3: 3, None: 3, 8: 3}


def test_two_of_each_list():
    import numpy as np

    rng = np.random.default_rng(2)
    for _ in range(50):
        lists = rng.integers(0, 12, 60)
        # classes that agree in all but their lowest or highest bits
        of_class = rng.choice(np.array([7, 6, 7 | 1 << 62, -(1 << 63)]), 60)
        at = jaccard._two_of_each(lists, of_class)
        assert (np.diff(lists[at]) >= 0).all()
        for x in np.unique(lists):
            kept = of_class[at[lists[at] == x]].tolist()
            assert len(kept) == len(set(kept)) == min(2, len(set(of_class[lists == x].tolist())))


def test_long_texts_are_hashed_in_chunks(monkeypatch):
    import numpy as np

    from tallyrec.llm import shingles as module

    rng = random.Random(6)
    whole = module.word_hashes
    texts = [" ".join("".join(rng.choices("abÉ漢", k=rng.choice([1, 3, 30, 90]))) for _ in range(40)) for _ in range(30)]
    texts += ["x" * 1000, " " * 500, "a" * 64, "a" * 65 + " ", " " + "b" * 63 + " c" * 70]
    want = [whole(t) for t in texts]
    monkeypatch.setattr(module, "_CHUNK", 32)
    monkeypatch.setattr(module, "_UP", module._UP[:33])
    for text, hashes in zip(texts, want, strict=True):
        assert whole(text).tolist() == hashes.tolist()
    assert len(np.unique(np.concatenate(want))) == len({w for t in texts for w in t.split()})


def test_light_sets_write_subsets_heavy_ones_lists():
    import numpy as np

    n = np.array([4, 10])
    head = np.arange(6, dtype=np.int64)
    doc, _, _, light = _signatures(n, np.array([0, 2, 6]), head, 4, 80)
    assert collections.Counter(zip(doc.tolist(), light.tolist(), strict=True)) == {
        (0, True): 1, (0, False): 1, (1, False): 3}


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(201, 202), (202, 203), (203, 201), (5, 5), (300, 299)]
    random.Random(1).shuffle(edges)
    found = {r["v"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {i: 201 for i in (201, 202, 203)} | {299: 299, 300: 299}
    assert found == want
