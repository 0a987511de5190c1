"""License scan by template markup compiled to a token automaton.

A template is license wording with markup:

* ``<<beginOptional>> ... <<endOptional>>``: words that may be left out (may nest);
* ``<<var;name=...;words=a-b>>``: a to b words of any kind in that place.

All other words are mandatory and must match exactly, in order, with nothing
between. All templates together become one deterministic automaton over words
(subset construction; words in no template share one symbol). It is started
at every word that can begin a template and walked as long as it lives; a
template's match is the longest that begins there. The added templates are
notices and whole license texts, so one changed mandatory word refuses the label;
a notice right behind "not" or the like is none, and of the Creative Commons
licenses that begin at one word the longest name counts.

Words are maximal runs of ASCII letters, digits and non-ASCII characters,
A-Z in lower case. Defined cases: a null or empty text has no words, no
labels, score 0; repeated rows give repeated results; an empty table gives no
rows. Only id and text are read. A long text is one pass over its words.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from insight.llm.common import arrow_map, utf8

#: Bytes that part words are mapped to a space, A-Z to a-z.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(TO_WORDS).split()


@dataclass(frozen=True)
class Template:
    label: str
    wording: str
    base: bool = False
    family: str = ""


#: Fixed values of the contract: phrases and their labels.
BASE = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
#: Elements of the Creative Commons licenses behind BY.
CC_ELEMENTS = ("", "NC", "SA", "ND", "NC-SA", "NC-ND")
VERSION = "<<beginOptional>><<var;name=version;words=1-1>>.0<<endOptional>>"


def cc_templates() -> tuple[Template, ...]:
    """A notice and, for each license with elements, a label of its own; in a family the longest match counts."""
    by = tuple(Template("-".join(["cc-by", *e.lower().split("-")]),
                        f"CC BY {e} {VERSION} <<beginOptional>>international<<endOptional>>", family="cc")
               for e in CC_ELEMENTS if e)
    deed = tuple(Template("-".join(["cc-by", *e.lower().split("-")]) if e else "cc-by", "Creative Commons Attribution " + " ".join(
        {"NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}[x] for x in e.split("-") if x)
        + f" <<var;name=version;words=1-1>>.0 <<beginOptional>>International<<endOptional>> "
          "<<beginOptional>>Public<<endOptional>> License", family="cc-deed") for e in CC_ELEMENTS)
    return by + deed


#: The published wording of license texts, in their order, with optional and replaceable parts.
COPYRIGHT = "<<beginOptional>>Copyright <<beginOptional>>(c)<<endOptional>> <<var;name=holder;words=1-12>><<endOptional>>"
DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY <<var;name=party;words=1-8>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
    "<<var;name=liable;words=1-8>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution.")
BSD_THIRD = (
    "<<beginOptional>>3.<<endOptional>> Neither the name of <<var;name=owner;words=1-8>> nor the names of its contributors may be "
    "used to endorse or promote products derived from this software without specific prior written permission.")
WHOLE_TEXTS = (
    Template("mit-text",
             COPYRIGHT + " Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;name=work;words=1-4>> "
             "and associated documentation files <<beginOptional>>(the <<var;name=short;words=1-2>>)<<endOptional>>, to deal in the "
             "<<var;name=short;words=1-2>> without restriction, including without limitation the rights to use, copy, modify, merge, "
             "publish, distribute, sublicense, and/or sell copies of the <<var;name=short;words=1-2>>, and to permit persons to whom the "
             "<<var;name=short;words=1-2>> is furnished to do so, subject to the following conditions: The above copyright notice and "
             "this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or "
             "substantial portions of the <<var;name=short;words=1-2>>. THE <<var;name=short;words=1-2>> IS PROVIDED \"AS IS\", WITHOUT "
             "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
             "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;name=liable;words=1-8>> BE LIABLE FOR ANY CLAIM, DAMAGES "
             "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
             "<<var;name=short;words=1-2>> OR THE USE OR OTHER DEALINGS IN THE <<var;name=short;words=1-2>>."),
    Template("bsd-2-clause-text", f"{COPYRIGHT} <<beginOptional>>All rights reserved.<<endOptional>> {BSD_TWO} {DISCLAIMER}"),
    Template("bsd-3-clause-text", f"{COPYRIGHT} <<beginOptional>>All rights reserved.<<endOptional>> {BSD_TWO} {BSD_THIRD} {DISCLAIMER}"),
    Template("isc-text",
             COPYRIGHT + " Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
             "IS PROVIDED \"AS IS\" AND <<var;name=party;words=1-4>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
             "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;name=liable;words=1-4>> BE LIABLE FOR ANY "
             "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
             "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
             "USE OR PERFORMANCE OF THIS SOFTWARE."),
    Template("apache-2.0-header",
             COPYRIGHT + " Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use <<var;name=file;words=1-4>> "
             "except in compliance with the License. You may obtain a copy of the License at http<<beginOptional>>s<<endOptional>>"
             "<<beginOptional>>https<<endOptional>>://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
             "to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
             "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
             "limitations under the License."),
    Template("gpl-header",
             "<<beginOptional>>this program<<endOptional>> is free software: you can redistribute it and/or modify it "
             "under the terms of the GNU General Public License as published by the Free Software Foundation, "
             "either version <<var;name=version;words=1-1>> <<beginOptional>>of the License<<endOptional>>, or (at your option) any later "
             "version. <<var;name=work;words=1-3>> is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
             "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for "
             "more details. <<beginOptional>>You should have received a copy of the GNU General Public License along with "
             "<<var;name=work;words=1-3>>.<<endOptional>>"),
)
#: Our own: notices of one line, the Creative Commons licenses, and whole texts; a changed mandatory word refuses a label.
ADDED = (
    Template("gpl-notice", "<<beginOptional>>this work is<<endOptional>> licensed under <<beginOptional>>the terms of<<endOptional>> "
             "<<beginOptional>>the<<endOptional>> GNU General Public License <<beginOptional>>, version <<var;name=version;words=1-1>>"
             "<<beginOptional>>or (at your option) any later version<<endOptional>><<endOptional>>"),
    Template("apache-2.0", "licensed under the Apache License, <<beginOptional>>version<<endOptional>> 2.0"),
    Template("cc-by-notice", "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>Creative Commons<<endOptional>> CC BY "
             "<<beginOptional>><<beginOptional>>NC<<endOptional>> <<beginOptional>>SA<<endOptional>> <<beginOptional>>ND<<endOptional>> "
             "<<var;name=version;words=1-1>>.0<<endOptional>>"),
    Template("mit-notice", "<<beginOptional>>released<<endOptional>> <<beginOptional>>licensed<<endOptional>> under the MIT License"),
    *cc_templates(),
    *WHOLE_TEXTS,
)
#: Words that, right before an added match, deny it.
DENIED = frozenset((b"not", b"never", b"neither", b"nor", b"isn", b"longer"))
TEMPLATES = BASE + ADDED
MARK = re.compile(r"<<(beginOptional|endOptional|var;[^<>]*)>>")
ANY = None


class Automaton:
    """Deterministic word automaton of templates: ``moves[state][symbol]``, ``ends[state]`` template numbers."""

    def __init__(self, templates: tuple[Template, ...] = TEMPLATES) -> None:
        self.templates = templates
        self.eps: list[list[int]] = [[]]
        self.on: list[list[tuple[bytes | None, int]]] = [[]]
        final = {}
        for i, t in enumerate(templates):
            first = self._state()
            self.eps[0].append(first)
            final[self._template(t.wording, first)] = i
        words = sorted({w for moves in self.on for w, _ in moves if w is not ANY})
        self.symbol = {w: i + 1 for i, w in enumerate(words)}  # 0: a word of no template
        start = self._closure({0})
        ids, todo = {start: 0}, [start]
        self.moves: list[dict[int, int]] = []
        self.ends: list[tuple[int, ...]] = []
        while todo:
            here = todo.pop(0)
            self.ends.append(tuple(sorted(final[s] for s in here if s in final)))
            by: dict[int, set[int]] = defaultdict(set)
            anything = {t for s in here for w, t in self.on[s] if w is ANY}
            for s in here:
                for w, t in self.on[s]:
                    if w is not ANY:
                        by[self.symbol[w]].add(t)
            if anything:
                for sym in range(len(words) + 1):
                    by[sym] |= anything
            row = {}
            for sym, to in by.items():
                key = self._closure(to)
                if key not in ids:
                    ids[key] = len(ids)
                    todo.append(key)
                row[sym] = ids[key]
            self.moves.append(row)
        self.first = {w for w, sym in self.symbol.items() if sym in self.moves[0]}
        self.any_first = 0 in self.moves[0]

    def _state(self) -> int:
        self.eps.append([])
        self.on.append([])
        return len(self.eps) - 1

    def _closure(self, states: set[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.eps[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    def _template(self, wording: str, at: int) -> int:
        """Add a template behind a state; returns its last state."""
        opened: list[int] = []
        for i, part in enumerate(MARK.split(wording)):
            if i % 2 == 0:
                for word in words_of(part):
                    nxt = self._state()
                    self.on[at].append((word, nxt))
                    at = nxt
            elif part == "beginOptional":
                opened.append(at)
                nxt = self._state()
                self.eps[at].append(nxt)
                at = nxt
            elif part == "endOptional":
                nxt = self._state()
                self.eps[at].append(nxt)
                self.eps[opened.pop()].append(nxt)
                at = nxt
            else:
                least, most = map(int, re.search(r"words=(\d+)-(\d+)", part).groups())
                out = self._state()
                for k in range(most):
                    if k >= least:
                        self.eps[at].append(out)
                    nxt = self._state()
                    self.on[at].append((ANY, nxt))
                    at = nxt
                self.eps[at].append(out)
                at = out
        if opened:
            raise ValueError(f"an optional part is not closed: {wording!r}")
        return at

    def matches(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(start, end, template) of every start's longest match of each template, and of each family only its longest.

        An added template's match right behind a word of ``DENIED`` is none, nor is one of that template inside it (without
        its optional first words); the base phrases stay.
        """
        if not self.any_first and self.first.isdisjoint(words):
            return []
        out, denied = [], {}
        symbol, moves, ends, first = self.symbol, self.moves, self.ends, self.first
        for start, word in enumerate(words):
            if not self.any_first and word not in first:
                continue
            state, at, best = 0, start, {}
            while at < len(words):
                state = moves[state].get(symbol.get(words[at], 0), -1)
                if state < 0:
                    break
                at += 1
                for t in ends[state]:
                    best[t] = at
            if not best:
                continue
            if start and words[start - 1] in DENIED:
                denied |= best
            best = {t: end for t, end in best.items() if self.templates[t].base or end > denied.get(t, 0)}
            longest: dict[str, int] = {}
            for t, end in best.items():
                family = self.templates[t].family
                longest[family] = max(end, longest.get(family, 0))
            out += [(start, end, t) for t, end in best.items()
                    if not self.templates[t].family or end == longest[self.templates[t].family]]
        return out


@cache
def automaton(templates: tuple[Template, ...] = TEMPLATES) -> Automaton:
    """One automaton per Python worker."""
    return Automaton(templates)


def covered(spans: list[tuple[int, int, int]]) -> int:
    """Words that stand in at least one span."""
    n, until = 0, 0
    for start, end, _ in sorted(spans):
        n += max(0, end - max(start, until))
        until = max(until, end)
    return n


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Per document: id, n_words, covered_words, places: array of (label, base, start, stop)."""
    kind = dict(docs.select(id_col).dtypes)[id_col]
    place = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("stop", pa.int64())]))

    def run(batch: pa.RecordBatch) -> dict:
        machine = automaton(templates)
        n_words, n_covered, places = [], [], []
        for text in batch.column(1):
            words = words_of(text.as_py())
            found = machine.matches(words)
            n_words.append(len(words))
            n_covered.append(covered(found))
            places.append([{"label": templates[t].label, "base": templates[t].base, "start": s, "stop": e} for s, e, t in sorted(found)])
        return {id_col: batch.column(0), "n_words": pa.array(n_words, pa.int64()),
                "covered_words": pa.array(n_covered, pa.int64()), "places": pa.array(places, place)}

    return arrow_map(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, n_words bigint, covered_words bigint, "
                     "places array<struct<label:string,base:boolean,start:bigint,stop:bigint>>")
