import re

import duckdb

from tallyrec.llm.licenses import PHRASES, TEMPLATES, compile_template, scan, scan_licenses, words_of


def accepts(markup, text):
    a = compile_template(markup)
    return a.accepts_at(words_of(text).split(), 0)


def test_optional_and_replaceable_words():
    t = "one two <<beginOptional>>may <<beginOptional>>be<<endOptional>><<endOptional>> <<var;1;3>> end"
    assert accepts(t, "one two x end") == 4
    assert accepts(t, "One, two may be x y z END") == 8
    assert accepts(t, "one two may x end") == 5
    assert accepts(t, "one two end") is None
    assert accepts(t, "one two a b c d e end") is None
    assert accepts(t, "one 2 x end") is None


def test_full_texts():
    for name, label, _, markup in TEMPLATES:
        text = re.sub(r"<<var;.*?>>", "some body", re.sub(r"<<(begin|end)Optional>>", "", markup))
        _, finds = scan(words_of("before it " + text + " after"))
        assert any((f.template, f.label, f.first_word) == (name, label, 2) for f in finds), name
        words = words_of(text).decode().split()
        # one mandatory word changed: no match of a template without other wording
        words[1] = "changed"
        assert not any(f.template == name for f in scan(words_of(" ".join(words)))[1])


def test_changed_or_missing_end_is_refused():
    for name, _, score, markup in TEMPLATES:
        if score <= 0.75:
            continue
        text = re.sub(r"<<var;.*?>>", "some body", re.sub(r"<<(begin|end)Optional>>", "", markup))
        words = words_of(text).decode().split()
        for other in ([*words[:-1], "changed"], words[:-1]):
            assert not any(f.template == name for f in scan(words_of(" ".join(other)))[1]), name


WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE REGENTS OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS
OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN
IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
CLAUSES = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
THIRD = """3. Neither the name of the University nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""


def test_bsd_needs_its_warranty_clause():
    def found(text):
        return [(f.template, f.score) for f in scan(words_of(text))[1]]

    assert found(CLAUSES + WARRANTY) == found(CLAUSES + THIRD + WARRANTY) == [("bsd-text", 1.0)]
    assert found(CLAUSES) == found(CLAUSES + THIRD) == []
    assert found(CLAUSES + WARRANTY.replace("STRICT LIABILITY", "NO LIABILITY")) == []
    assert found(CLAUSES + THIRD.replace("without", "with") + WARRANTY) == []


def base(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    at, labels = [], set()
    for phrase, label in PHRASES.items():
        q = phrase.split()
        found = [k for k in range(len(words)) if words[k : k + len(q)] == q]
        at += found
        labels |= {label} if found else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_query_against_brute_force(spark, documents):
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    rows = [(i, t) for i, t in rows]
    rows += [(-1, None), (-2, ""), (-3, "!!"), (-4, "the MIT license the mit license"), (-4, "the MIT license the mit license"),
             (-5, "cc-by-nc by nc CC BY nc"), (-6, "éthe mit license"), (-7, "the mit licenseé"),
             (-8, "word " * 200_000 + "the mit license")]
    got = scan_licenses(documents(rows), "doc_id", "text").collect()
    mine = sorted((r["doc_id"], r["n_words"], r["n_base"], r["first_word"] or -1, r["last_word"] or -1, r["base_labels"]) for r in got)
    want = sorted((i, *[(-1 if x is None or x == 0 and k in (2, 3) else x) for k, x in enumerate(base(t))]) for i, t in rows)
    assert mine == want
    for r in got:
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert (r["score"] > 0) == bool(r["labels"])
    assert scan_licenses(documents([], "doc_id bigint, text string"), "doc_id", "text").count() == 0
