"""Licence scan: phrases, and templates with optional and replaceable wording.

A template is licence wording with two kinds of marks: ``<<beginOptional>> ...
<<endOptional>>`` (nestable) for words that may be missing, and ``<<var;min;max>>`` for
a run of any words of that length range. It is compiled to a token automaton: each
state waits for one word or accepts any; marks become jumps. A text carries the
template's label where the automaton, started at the template's first mandatory words,
reaches its end, so all mandatory wording stands there exactly and in order. The whole
text is searched.

Words are maximal runs of ``a-z``, digits and non-ASCII characters after lower-casing
A-Z. Base phrases are found as consecutive words; their places may overlap.

Defined results: a null text is empty; without words or licences, counts are 0, first and
last word null, labels empty and the score 0; repeated rows are kept; an empty table
gives an empty table; other columns are not read. The score is that of the strongest
find: 1 for a full licence text, 0.9 for a full licence header, 0.75 for a notice, 0.5 for
a base phrase alone. Texts and headers are written out to their last mandatory word.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyrec.llm.batches import map_arrow, text_groups

#: Phrases and their labels.
PHRASES = {
    "the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

_GPL = """is free software: you can redistribute it and/or modify it under the terms of the GNU
    <<beginOptional>>Lesser<<endOptional>> General Public License as published by the Free Software Foundation,
    <<beginOptional>>either<<endOptional>> version <<var;1;2>> of the License<<beginOptional>>, or (at your option) any
    later version<<endOptional>>. <<var;1;8>> is distributed in the hope that it will be useful, but WITHOUT ANY
    WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
    <<beginOptional>>Lesser<<endOptional>> General Public License for more details. You should have received a copy of
    the GNU <<beginOptional>>Lesser<<endOptional>> General Public License along with <<var;1;8>>. If not, """

#: Published licence wordings, with optional and replaceable parts marked.
TEMPLATES: tuple[tuple[str, str, float, str], ...] = (
    (
        "mit-text",
        "mit",
        1.0,
        """Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;1;12>>
        (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice
        <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or
        substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;1;20>> BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF
        OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "isc-text",
        "isc",
        1.0,
        """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software
        for any purpose with or without fee is hereby granted, provided that the above copyright notice and
        this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND <<var;1;20>> DISCLAIMS
        ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL <<var;1;20>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
        DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "bsd-text",
        "bsd",
        1.0,
        """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of
        source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution. <<beginOptional>><<beginOptional>>3.<<endOptional>>
        Neither the name of <<var;1;20>> nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission.<<endOptional>>
        THIS SOFTWARE IS PROVIDED BY <<var;1;20>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
        NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED. IN NO EVENT SHALL <<var;1;20>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
        EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
        LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
        IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "apache-header",
        "apache-2",
        0.9,
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use <<var;1;6>> except
        in compliance with the License. You may obtain a copy of the License at
        <<beginOptional>>http://<<endOptional>><<beginOptional>>https://<<endOptional>>www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is
        distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
        See the License for the specific language governing permissions and limitations under the License.""",
    ),
    ("gpl-header", "gpl", 0.9, _GPL + "see <<beginOptional>>http://<<endOptional>><<beginOptional>>https://<<endOptional>>www.gnu.org/licenses/"),
    ("gpl-header", "gpl", 0.9, _GPL + "write to the Free Software Foundation, Inc."),
    (
        "gpl-terms",
        "gpl",
        0.75,
        """is free software: you can redistribute it and/or modify it under the terms of the GNU
        <<beginOptional>>Lesser<<endOptional>> General Public License as published by the Free Software
        Foundation""",
    ),
    ("mit-notice", "mit", 0.75, "Released under the <<beginOptional>>terms of the<<endOptional>> MIT License"),
    ("mit-notice", "mit", 0.75, "Licensed under the <<beginOptional>>terms of the<<endOptional>> MIT License"),
    (
        "apache-notice",
        "apache-2",
        0.75,
        "Licensed under the Apache License <<beginOptional>>,<<endOptional>> Version 2",
    ),
    (
        "gpl-notice",
        "gpl-3",
        0.75,
        """licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License
        <<beginOptional>>as published by the Free Software Foundation<<endOptional>> version 3""",
    ),
    (
        "cc-by-nc-notice",
        "cc-by-nc",
        0.75,
        "Licensed under <<beginOptional>>a<<endOptional>> CC BY-NC <<beginOptional>>4.0<<endOptional>>",
    ),
    (
        "cc-by-nc-name",
        "cc-by-nc",
        0.75,
        "Creative Commons Attribution <<beginOptional>>-<<endOptional>> NonCommercial",
    ),
)

#: One mandatory word of every phrase and template; a text without any of them has no match.
_NEEDED = (b" mit ", b" apache ", b" nc ", b" permission ", b" redistribution ", b" gnu ", b" noncommercial ")

_TABLE = bytearray(b" " * 256)
for _c in (*range(48, 58), *range(97, 123), *range(128, 256)):
    _TABLE[_c] = _c
for _c in range(65, 91):
    _TABLE[_c] = _c + 32
_TABLE = bytes(_TABLE)

_ANY = b""


def words_of(text: str) -> bytes:
    """Words as UTF-8, one blank around each."""
    return b" " + b" ".join(text.encode("utf-8", "surrogatepass").translate(_TABLE).split()) + b" "


@dataclass(frozen=True)
class Automaton:
    """States 0..n; ``waits[s]`` is the word state s needs (empty: any); jumps need no word."""

    waits: tuple[bytes | None, ...]
    jumps: tuple[tuple[int, ...], ...]
    #: first mandatory words, where a search starts
    anchor: bytes

    def closed(self, states: Iterable[int]) -> frozenset[int]:
        found, todo = set(), list(states)
        while todo:
            s = todo.pop()
            if s not in found:
                found.add(s)
                todo.extend(self.jumps[s])
        return frozenset(found)

    def accepts_at(self, words: list[bytes], start: int) -> int | None:
        """Word after the match that starts at ``start``; None if there is none."""
        last = len(self.waits) - 1
        states = self.closed([0])
        at = start
        while last not in states:
            if at >= len(words):
                return None
            word = words[at]
            states = self.closed(
                s + 1 for s in states if self.waits[s] is not None and self.waits[s] in (_ANY, word)
            )
            if not states:
                return None
            at += 1
        return at


def compile_template(markup: str) -> Automaton:
    parts = re.split(r"(<<.*?>>)", markup)
    waits: list[bytes | None] = []
    jumps: list[list[int]] = []
    open_: list[int] = []
    anchor: list[bytes] = []
    anchored = False

    def state(word: bytes | None) -> int:
        waits.append(word)
        jumps.append([])
        return len(waits) - 1

    for part in parts:
        if part == "<<beginOptional>>":
            # a state that moves on without a word; the end of the part is filled in below
            open_.append(state(None))
            jumps[-1].append(len(waits))
            anchored = anchored or bool(anchor)
        elif part == "<<endOptional>>":
            jumps[open_.pop()].append(len(waits))
        elif part.startswith("<<var"):
            least, most = (int(x) for x in part[2:-2].split(";")[1:])
            for _ in range(least):
                state(_ANY)
            skips = [state(_ANY) for _ in range(most - least)]
            for s in skips:
                jumps[s].append(len(waits))
            anchored = anchored or bool(anchor)
        else:
            for word in words_of(part).split():
                state(word)
                if not open_ and not anchored:
                    anchor.append(word)
    waits.append(None)
    jumps.append([])
    if open_:
        raise ValueError("an optional part is not ended")
    if not anchor or waits[0] != anchor[0]:
        raise ValueError("a template starts with mandatory words")
    return Automaton(tuple(waits), tuple(map(tuple, jumps)), b" " + b" ".join(anchor) + b" ")


@functools.cache
def _compiled() -> tuple[tuple[str, str, float, Automaton], ...]:
    return tuple((name, label, score, compile_template(t)) for name, label, score, t in TEMPLATES)


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which ``phrase`` (blank on both sides) stands."""
    out, at, counted, word = [], joined.find(phrase), 0, 0
    while at >= 0:
        word += joined.count(b" ", counted, at)
        counted = at
        out.append(word)
        at = joined.find(phrase, at + 1)
    return out


@dataclass(frozen=True)
class Find:
    template: str
    label: str
    first_word: int
    #: one behind the last word
    end_word: int
    score: float


def scan(joined: bytes) -> tuple[dict[str, list[int]], list[Find]]:
    """Places of base phrases, and matches of templates."""
    if not any(x in joined for x in _NEEDED):
        return {}, []
    base = {p: found for p in PHRASES if (found := places(joined, f" {p} ".encode()))}
    finds, words = [], None
    for name, label, score, automaton in _compiled():
        for start in places(joined, automaton.anchor):
            words = words if words is not None else joined.split()
            end = automaton.accepts_at(words, start)
            if end is not None:
                finds.append(Find(name, label, start, end, score))
    return base, finds


RESULT = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, matches array<struct<template: string, first_word: bigint, end_word: bigint>>"
)


def scan_licenses(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per row: word and phrase counts, labels, score and the places of template matches."""

    def row(text: str | None) -> tuple:
        joined = words_of(text or "")
        base, finds = scan(joined)
        at = [x for found in base.values() for x in found]
        base_labels = {PHRASES[p] for p in base}
        labels = base_labels | {f.label for f in finds}
        score = max([0.0, *(0.5 for _ in base), *(f.score for f in finds)])
        return (
            joined.count(b" ") - 1 if len(joined) > 2 else 0,
            len(at),
            min(at, default=None),
            max(at, default=None),
            ",".join(sorted(base_labels)),
            ",".join(sorted(labels)),
            score,
            [
                {"template": f.template, "first_word": f.first_word, "end_word": f.end_word}
                for f in finds
            ],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        match = pa.struct([("template", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64())])
        kinds.append(pa.list_(match))
        for batch in batches:
            for start, texts in text_groups(batch, 1):
                columns = zip(*(row(t) for t in texts), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)).cast(pa.int64()),
                        *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                    ],
                    [x.split()[0] for x in RESULT.split("struct<")[0].split(", ")],
                )

    return map_arrow(df, [id_column, text_column], run, RESULT)
