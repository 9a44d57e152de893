import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tallyrec.llm import merkle
from tallyrec.llm.merkle import build_manifest
from tallyrec.llm.queries import llm_oracles, op11_merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc, text, lang, source, n):
    return H(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc, source, lang, n, text)))


def climb(nodes):
    """Levels of nodes from ``nodes`` to the one that is left."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k : k + 16]) for k in range(0, len(levels[-1]), 16)])
    return levels


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        own = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        trees[source] = (own, climb([leaf_of(*r) for r in own]))
    top = climb([trees[s][1][-1][0] for s in order])
    root, out = top[-1][0], []
    for place, source in enumerate(order):
        own, levels = trees[source]
        for at, row in enumerate(own):
            doc, text = row[:2]
            folded = leaf = levels[0][at]
            if doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0 and text is not None:
                lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                folded = leaf_of(doc, lowered, *row[2:])
            proof, spots = "", [(levels, at), (top, place)]
            for tree, k in spots:
                for level in tree[:-1]:
                    start = k // 16 * 16
                    run = level[start : start + 16]
                    left, right = run[: k - start], run[k - start + 1 :]
                    proof += "".join(left + right)
                    folded = H(*left, folded, *right)
                    k //= 16
            out.append((doc, leaf, levels[-1][0], root, H(proof), folded, folded == root))
    return sorted(out, key=repr)


def folds(df):
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    got = build_manifest(df, "doc_id", "source", FIELDS, {"text": lowered}, hit).folds()
    return sorted(map(tuple, got.collect()), key=repr)


def odd_rows(n):
    rows = [(i, f"Text {i} É " * (i % 3), "en" if i % 4 else None, "hot", i) for i in range(n)]
    rows += [(i, "T", "de", f"s{i % 23}", None) for i in range(70)]
    rows += [(1, None, None, None, None), (None, "A", "x", None, 1), (None, None, None, "hot", None), (2, "", "", "", 0)]
    rows += [(7, "Same", "en", "twin", 4)] * 40 + [(7, "other", "en", "twin", 4), (5, "Ä" * 300_000, "en", "one", 9)]
    return rows


@pytest.mark.parametrize("n", [300, 5000])
def test_equals_brute_force(spark, documents, n):
    rows = odd_rows(n)
    df = documents(rows, SCHEMA).selectExpr("*", "1 as tree", "2 as pos", "3 as digest", "4 as root")
    assert folds(df) == brute(rows)


def test_many_tiers(spark, documents, monkeypatch):
    """A group of two chunks and 200 small ones."""
    rows = [(i, f"T {i}", "en", "a", i) for i in range(5000)]
    rows += [(i, f"T {i}", "en", f"g{i % 200}", i) for i in range(500)]
    tiers = []
    plain = merkle._tiers
    monkeypatch.setattr(merkle, "_tiers", lambda *a: tiers.append(plain(*a)) or tiers[-1])
    assert folds(documents(rows, SCHEMA)) == brute(rows)
    assert [len(t) for t in tiers] == [2, 1]


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 4096, 4097])
def test_levels(n):
    digests = [H(str(i)).encode() for i in range(n)]
    want = climb([d.decode() for d in digests])[-1][0]
    roots = [
        merkle.Parents(digests[k : k + 4096], merkle.levels_of(k // 4096, len(digests[k : k + 4096]))).root
        for k in range(0, n, 4096)
    ]
    assert merkle.Parents(roots, merkle.levels_of(0, len(roots))).root.decode() == want


def test_fold_resumes_at_the_slot():
    digests = [H(str(i)).encode() for i in range(40)]
    folds_ = merkle.Folds(merkle.Parents(digests, 2), [(b"a" * 64, b"b" * 128)])
    changed = [*digests[:21], H("x").encode(), *digests[22:]]
    inner = merkle.Parents(changed, 2).root
    assert folds_.fold(21, changed[21]) == hashlib.sha256(b"a" * 64 + inner + b"b" * 128).hexdigest().encode()
    assert merkle._read_path(merkle._pack_path([(b"a" * 64, b"b" * 128), (b"", b"")])) == [(b"a" * 64, b"b" * 128), (b"", b"")]


def test_empty_table(spark, documents):
    assert folds(documents([], SCHEMA)) == []


def test_oracle(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    got = op11_merkle(spark, "/root/testdata/sf0.01")
    want = con.execute(llm_oracles()["op11_merkle"])
    assert got.columns == [d[0] for d in want.description]
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(want.fetchall()) and {r[-1] for r in rows} == {True, False}
