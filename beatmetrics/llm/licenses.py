"""License scans by patience alignment.

A text's words are aligned with a template's: words that stand once in both are
anchors, the longest increasing subsequence of their places is kept, and the
gaps between anchors are aligned the same way.  The share of the template's
words that find a partner is its coverage.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatmetrics.llm.common import ship
from beatmetrics.llm.packing import slices
from beatmetrics.llm.toxicity import _TO_WORDS

# License texts, notices and titles of public licenses.  They travel with the
# scanner's function, 19 KB pickled with their phrases.
TEMPLATES: dict[str, str] = {}
# The phrases that tell a license and its version apart: each must stand in a match unbroken.
PHRASES: dict[str, list[str]] = {}
# Words that may not stand inside a match: clauses that make another license of it.
BARRED: dict[str, list[str]] = {}


def _add(name: str, text: str, *phrases: str, barred: tuple[str, ...] = ()) -> None:
    TEMPLATES[name], PHRASES[name], BARRED[name] = text, list(phrases), list(barred)


_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met: 1. Redistributions of source code must
retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the
distribution."""
_add("BSD-2-Clause-text", f"{_BSD} {_AS_IS}", barred=("endorse", "advertising"))
_add(
    "BSD-3-Clause-text",
    f"""{_BSD} 3. Neither the name of the copyright holder nor the names of its contributors may be
    used to endorse or promote products derived from this software without specific prior written
    permission. {_AS_IS}""",
    "endorse or promote products",
    barred=("advertising",),
)
_add(
    "MIT-text",
    """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
    and associated documentation files (the "Software"), to deal in the Software without restriction,
    including without limitation the rights to use, copy, modify, merge, publish, distribute,
    sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
    furnished to do so, subject to the following conditions: The above copyright notice and this
    permission notice shall be included in all copies or substantial portions of the Software. THE
    SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
    LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
    IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
    LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
    CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "permission notice shall be included",
)
_add(
    "ISC-text",
    """Permission to use, copy, modify, and/or distribute this software for any purpose with or
    without fee is hereby granted, provided that the above copyright notice and this permission notice
    appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
    REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
    SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
    DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
    NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
    OF THIS SOFTWARE.""",
    "permission notice appear in all copies",
)
for _name in ("MIT", "BSD", "ISC"):
    _add(_name, f"Released under the {_name} License.", f"{_name} license")

_add("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache license version 2 0")
_add(
    "Apache-2.0-header",
    """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
    in compliance with the License. You may obtain a copy of the License at
    http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
    writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
    WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
    language governing permissions and limitations under the License.""",
    "apache license version 2 0",
)
_title = "Apache License Version 2.0, January 2004"
_add("Apache-2.0-title", _title, _title)
_add(
    "MPL-2.0-header",
    """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
    the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "mozilla public license v 2 0",
)
_add(
    "MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0.",
    "mozilla public license version 2 0",
)

for _name, _kind, _version, _day, _thing in (
    ("GPL-2.0", "GNU General Public License", "2", "June 1991", "program"),
    ("GPL-3.0", "GNU General Public License", "3", "29 June 2007", "program"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1", "February 1999", "library"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3", "29 June 2007", "library"),
    ("AGPL-3.0", "GNU Affero General Public License", "3", "19 November 2007", "program"),
):
    _add(
        _name, f"This work is licensed under the {_kind}, version {_version}.",
        f"{_kind} version {_version}",
    )
    _title = f"{_kind} Version {_version}, {_day}"
    _add(f"{_name}-title", _title, _title)
    _add(
        f"{_name}-header",
        f"""This {_thing} is free software; you can redistribute it and/or modify it under the terms of
        the {_kind} as published by the Free Software Foundation; either version {_version} of the
        License, or (at your option) any later version. This {_thing} is distributed in the hope that it
        will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
        FITNESS FOR A PARTICULAR PURPOSE. See the {_kind} for more details. You should have received a
        copy of the {_kind} along with this {_thing}; if not, see www.gnu.org/licenses""",
        _kind,
        f"version {_version} of the license",
    )

_WORDS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
for _parts in ("BY", "BY-NC", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    _long = " ".join(_WORDS[x] for x in _parts.split("-"))
    for _version, _kind in (("3.0", "Unported"), ("4.0", "International")):
        _name = f"CC-{_parts}-{_version}"
        _add(_name, f"Licensed under CC {_parts} {_version}.", f"cc {_parts} {_version}")
        _add(
            f"{_name}-header",
            f"This work is licensed under a Creative Commons {_long} {_version} {_kind} License.",
            f"creative commons {_long} {_version}",
        )


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode().translate(_TO_WORDS).split() if text else []


def increasing(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, sorted by the first number, whose second numbers rise."""
    tails: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(places):
        at = bisect_left(tails, j)
        before.append(ends[at - 1] if at else -1)
        tails[at : at + 1] = [j]
        ends[at : at + 1] = [k]
    out = []
    k = ends[-1] if ends else -1
    while k >= 0:
        out.append(places[k])
        k = before[k]
    return out[::-1]


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Pairs of places with equal words, rising in both lists."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = increasing(
            [(i, at[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in at]
        )
        last = (a0, b0)
        for i, j in anchors:
            out.append((i, j))
            todo.append((last[0], i, last[1], j))
            last = (i + 1, j + 1)
        if anchors:
            todo.append((last[0], a1, last[1], b1))
    return sorted(out)


class Scanner:
    """Finds templates in texts; a match may be spread over twice a template's words."""

    def __init__(
        self,
        templates: dict[str, str],
        least: float,
        phrases: dict[str, list[str]],
        barred: dict[str, list[str]],
    ):
        self.templates = {name: words_of(t) for name, t in sorted(templates.items())}
        self.counts = {name: Counter(t) for name, t in self.templates.items()}
        self.known = {w for t in self.templates.values() for w in t}
        self.least = least
        self.phrases = {n: [words_of(p) for p in phrases.get(n, [])] for n in templates}
        self.barred = {n: {w for p in barred.get(n, []) for w in words_of(p)} for n in templates}

    def _accepts(self, name: str, words: list[bytes], pairs: list[tuple[int, int]]) -> bool:
        """Whether every phrase stands unbroken in the match and no barred word in between."""
        at = dict(pairs)
        for phrase in self.phrases[name]:
            n = len(phrase)
            if not any(
                words[i : i + n] == phrase and all(at.get(i + k) == j + k for k in range(n))
                for i, j in pairs
            ):
                return False
        barred = self.barred[name]
        return not barred or barred.isdisjoint(words[pairs[0][0] : pairs[-1][0] + 1])

    def _match(self, name: str, words: list[bytes], first: int, end: int) -> list[tuple[int, int]]:
        """The best accepted pairs behind ``first``: up to ``end``, up to twice the template's
        words, and from where the match really starts; words left out between count by half."""
        template = self.templates[name]
        best, most = [], 0.0
        todo, seen = [(first, end), (first, first + 2 * len(template))], set()
        while todo:
            a, b = todo.pop(0)
            b = min(b, len(words))
            if (a, b) in seen:
                continue
            seen.add((a, b))
            pairs = [(a + i, j) for i, j in align(words[a:b], template)]
            if not pairs:
                continue
            start = pairs[0][0]
            if start > a and len(seen) < 6:
                todo.append((start, start + 2 * len(template)))
            value = len(pairs) - (pairs[-1][0] + 1 - start - len(pairs)) / 2
            enough = len(pairs) / len(template) >= self.least
            if enough and (not best or value > most) and self._accepts(name, words, pairs):
                best, most = pairs, value
        return best

    def scan(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(template, first word, word behind, coverage) of every match."""
        words = words_of(text)
        places = [i for i, w in enumerate(words) if w in self.known]
        there = {words[i] for i in places}
        out = []
        for name, template in self.templates.items():
            need = max(1, math.ceil(self.least * len(template) - 1e-9))
            if len(places) < need or any(not there.issuperset(p) for p in self.phrases[name]):
                continue
            # Where the phrases stand; a template's window must hold one of each.
            spots = [
                [i for i in places if words[i] == p[0] and words[i : i + len(p)] == p]
                for p in self.phrases[name]
            ]
            if not all(spots):
                continue
            own = set(template)
            hits = [i for i in places if words[i] in own]
            k, done = 0, 0
            while k + need <= len(hits):
                # So many of the template's words must stand close together.
                first, last = hits[k], hits[k + need - 1]
                wide = first + 2 * len(template)
                if (
                    first < done
                    or last >= wide
                    or not all((i := bisect_left(s, first)) < len(s) and s[i] < wide for s in spots)
                ):
                    k += 1
                    continue
                near = Counter(words[first:wide])
                if sum(min(n, near[w]) for w, n in self.counts[name].items()) < need:
                    k += 1
                    continue
                pairs = self._match(name, words, first, last + 1 + len(template) - need)
                if pairs:
                    done = pairs[-1][0] + 1
                    coverage = round(len(pairs) / len(template), 6)
                    out.append((name, pairs[0][0], done, coverage))
                k += 1
        return sorted(out, key=lambda m: (m[1], m[0]))


def scan(
    df: DataFrame,
    templates: dict[str, str] | None = None,
    least: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, list[str]] | None = None,
    barred: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Rows (doc_id, license, coverage, n_matches, matches), one per row of the table.

    A match holds the share ``least`` of a template's words, each of its
    ``phrases`` unbroken and none of its ``barred`` words; own ``templates``
    have neither unless given.  ``matches`` lists template:first word:word behind of all matches by place,
    ``license`` is the template with the most covered words (the longer, then
    the first by name), null without a match.  A map over whole texts without a
    shuffle.  A null or empty text has no match; null and repeated ids stay; an
    empty table gives no rows; other columns are ignored.
    """
    ship(df.sparkSession)
    if templates is None:
        templates, phrases, barred = TEMPLATES, phrases or PHRASES, barred or BARRED
    scanner = Scanner(templates, least, phrases or {}, barred or {})
    sizes = {name: len(t) for name, t in scanner.templates.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1000):
                rows = [scanner.scan(t.as_py()) for t in batch.column(1)]
                best = [
                    min(r, key=lambda m: (-m[3] * sizes[m[0]], m[0])) if r else (None, 0, 0, 0.0)
                    for r in rows
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([b[0] for b in best], pa.string()),
                        pa.array([b[3] for b in best], pa.float64()),
                        pa.array([len(r) for r in rows], pa.int64()),
                        pa.array([",".join(f"{m[0]}:{m[1]}:{m[2]}" for m in r) for r in rows]),
                    ],
                    names=["doc_id", "license", "coverage", "n_matches", "matches"],
                )

    return df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, license string, coverage double, n_matches long, matches string"
    )
