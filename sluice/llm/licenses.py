"""License scans by patience alignment.

A template (a notice or a whole license text) is looked for in every document.
Words that occur once in both, in the stretch of text and in the template, are
anchors; the longest increasing subsequence of their positions is kept, and the
gaps between anchors are aligned the same way, where other words have become
unique.  A gap without anchors aligns its equal words at its two ends.  The
share of the template's words that are aligned is its coverage.

Stretches: every window of ``reach`` times the template's length that begins with
one of its words and holds enough of them is aligned.  Of overlapping findings
the one with most aligned words counts (ties: the first).

Coverage alone does not tell licenses apart whose notices differ in one word.
So a finding also needs each word that decides (``DECIDING``, and numbers of
versions) in its template aligned at least once, and no other such word may
stand between the aligned words or carry the version on behind them.

A quick test rules out most documents without loss: the template's longest words, together more than a share of
``1 - min_coverage`` of it, cannot all be missing.

Defined results: words are runs of letters and digits, upper and lower case
alike; null and empty texts have no findings; a license that occurs several
times gives a row each, overlapping findings of templates of one license (the name up to a blank) a single one;
SPDX tag lines give a row per identifier, as written and with coverage 1; rows that repeat an id are scanned each; other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import byte_slices, read_table, texts_as_bytes

MIN_COVERAGE = 0.85
REACH = 1.25
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")

#: Words that tell one license from another (names, versions, terms, clauses).
DECIDING = frozenset((
    b"gnu apache isc mozilla creative commons cc cc0 affero agpl lesser lgpl nc sa nd noncommercial sharealike "
    b"noderivatives noderivs endorse acknowledgement acknowledgment appear supporting unlicense").split())
#: Those that decide only before another word.
DECIDING_BEFORE = {b"mit": {b"license", b"licence"}, b"library": {b"general"}, b"non": {b"commercial"}, b"share": {b"alike"},
                   b"no": {b"derivatives", b"derivs"}}
#: Abbreviations beside the name itself.
SAME = {b"lgpl": b"lesser", b"agpl": b"affero"}
_LEADS = frozenset(b"version v by nc sa nd gpl lgpl agpl mpl apache attribution noncommercial sharealike noderivatives noderivs".split())

_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE ")
_ISC = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE.")
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. ")
_BSD_CLAUSE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. ")
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")


def _gnu_header(what: str, kind: str, version: str) -> str:
    return (f"This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind} "
            f"License as published by the Free Software Foundation; either version {version} of the License, or (at your "
            f"option) any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY "
            "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
            f"GNU {kind} License for more details.")


#: Notices as their licenses give them, and the texts of the short ones.
#: What follows a name ("text", "header") tells the templates of one license apart.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT": "Released under the MIT License.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "MIT full text": "",
    "ISC text": "",
    "0BSD text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                 "hereby granted. " + _ISC,
    "BSD-2-Clause text": _BSD + _BSD_WARRANTY,
    "BSD-3-Clause text": _BSD + _BSD_CLAUSE + _BSD_WARRANTY,
    "Unlicense text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the "
        "author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
        "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. "
        "We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to "
        "this software under copyright law. " + _WARRANTY + "AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "GPL-2.0 header": _gnu_header("program", "General Public", "2"),
    "LGPL-2.1 header": _gnu_header("library", "Lesser General Public", "2.1"),
    "LGPL-3.0 header": _gnu_header("library", "Lesser General Public", "3"),
    "AGPL-3.0 header": _gnu_header("program", "Affero General Public", "3"),
    "CC0-1.0": "This work is dedicated to the public domain under the Creative Commons CC0 1.0 Universal Public Domain "
               "Dedication.",
}
TEMPLATES["MIT full text"] = (
    TEMPLATES["MIT text"] + " " + _WARRANTY + "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
    "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
TEMPLATES["ISC text"] = TEMPLATES["ISC"] + " " + _ISC
for _kind, _id, _versions in (("General", "GPL", ("2", "3")), ("Lesser General", "LGPL", ("2.1", "3")),
                              ("Affero General", "AGPL", ("3",))):
    for _v in _versions:
        TEMPLATES.setdefault(f"{_id}-{_v if '.' in _v else _v + '.0'}",
                             f"This work is licensed under the GNU {_kind} Public License, version {_v}.")
for _id, _terms in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
                    ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    for _v, _scope in (("4.0", "International"), ("3.0", "Unported")):
        TEMPLATES.setdefault(f"CC-{_id}-{_v}", f"Licensed under CC {_id} {_v}.")
        if _v == "3.0":
            _terms = _terms.replace("NoDerivatives", "NoDerivs")
        TEMPLATES[f"CC-{_id}-{_v} notice"] = (
            f"This work is licensed under a Creative Commons {_terms} {_v} {_scope} License.")
#: A tag line names any license by its identifier, whether or not there is a template.
_SPDX = re.compile(rb"spdx-license-identifier:[ \t]*([a-z0-9.+() \t-]+)")
_SPDX_ID = re.compile(rb"[a-z0-9][a-z0-9.+-]*")
_SPDX_MORE = re.compile(rb"(?:\s*\))*\s+(?:and|or|with)\b[\s(]*")


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def deciding(low: bytes, spans: list[tuple[int, int]], start: int = 0, end: int | None = None) -> dict[int, bytes]:
    """Places of the words in ``start`` to ``end`` that decide, and what they say.

    Numbers count behind a word like "version", and behind such a number and a point; a zero there says nothing.
    """
    out, chain = {}, -1
    word = lambda i: low[slice(*spans[i])] if 0 <= i < len(spans) else b""
    for i in range(start, len(spans) if end is None else end):
        w = word(i)
        if w.isdigit() or (w[:1] == b"v" and w[1:].isdigit()):
            more = chain == i - 1 and low[spans[i - 1][1]:spans[i][0]] == b"."
            if more or w[:1] == b"v" or word(i - 1) in _LEADS:
                chain = i
                if not more or w.strip(b"0"):
                    out[i] = w.removeprefix(b"v")
        elif w in DECIDING or word(i + 1) in DECIDING_BEFORE.get(w, ()):
            out[i] = SAME.get(w, w)
    return out


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    ends: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        if pile:
            before[i] = ends[pile - 1]
        tops[pile:pile + 1], ends[pile:pile + 1] = [v], [i]
    out, at = [], ends[-1] if ends else -1
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Aligned places (in a, in b), increasing in both."""
    todo, out = [(0, len(a), 0, len(b))], []
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        both = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place]
        kept = [both[k] for k in increasing([j for _, j in both])]
        if not kept:
            continue
        out += kept
        edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def spdx_lines(raw: bytes) -> list[tuple[str, float, int, int]]:
    """A finding per license identifier of every SPDX tag line, in the form of ``Scanner.scan``."""
    low, out, first, seen = raw.lower(), [], 0, 0
    for line in _SPDX.finditer(low):
        at = line.start(1)
        while at < line.end(1) and low[at] in b" \t(":
            at += 1
        while m := _SPDX_ID.match(low, at, line.end(1)):
            start, end = m.start(), m.start() + len(m.group().rstrip(b".-"))
            first, seen = first + len(_WORD.findall(low, seen, start)), start
            out.append((raw[start:end].decode("ascii"), 1.0, first, first + len(_WORD.findall(low, start, end))))
            more = _SPDX_MORE.match(low, m.end(), line.end(1))
            if more and more.group().split()[-1].strip(b"()") == b"with":  # an exception follows, not a license
                skip = _SPDX_ID.match(low, more.end(), line.end(1))
                more = skip and _SPDX_MORE.match(low, skip.end(), line.end(1))
            if not more:
                break
            at = more.end()
    return out


class Scanner:
    """Templates ready for scanning; ``strict`` asks for the deciding words beside the coverage."""

    def __init__(self, templates: dict[str, str], min_coverage: float = MIN_COVERAGE, reach: float = REACH,
                 strict: bool = False) -> None:
        self.min_coverage, self.reach = min_coverage, reach
        self.decisive = None
        if strict:
            lows = {name: text.encode().lower() for name, text in templates.items()}
            self.decisive = {name: deciding(low, [m.span() for m in _WORD.finditer(low)]) for name, low in lows.items()}
        self.templates = [(name, words_of(text.encode())) for name, text in sorted(templates.items())]
        self.templates = [(name, words, Counter(words)) for name, words in self.templates if words]
        self.lengths = {name: len(words) for name, words, _ in self.templates}
        needed: set[bytes] = set()
        self.keys = []
        for _, words, counts in self.templates:
            # Without these words too little of the template is left.
            keys, held = set(), 0
            for w in sorted(counts, key=lambda w: (-len(w), w)):
                if held > (1 - min_coverage) * len(words):
                    break
                keys.add(w)
                held += counts[w]
            self.keys.append(keys)
            needed |= keys
        self.quick = re.compile(b"|".join(re.escape(w) for w in sorted(needed, key=lambda w: (-len(w), w))) or b"(?!)")

    def findings(self, raw: bytes) -> list[tuple[str, float, int, int]]:
        """As ``scan``, with one finding for overlapping ones of a license, and the identifiers of SPDX lines."""
        out, taken = [], defaultdict(list)
        for name, coverage, a, b in sorted(self.scan(raw), key=lambda x: (-x[1] * self.lengths[x[0]], x)):
            family = taken[name.split(" ")[0]]
            if all(b <= x or y <= a for x, y in family):
                family.append((a, b))
                out.append((name, coverage, a, b))
        return sorted(out + spdx_lines(raw))

    def scan(self, raw: bytes) -> list[tuple[str, float, int, int]]:
        """(license, coverage, first word, end word) of every finding."""
        low = raw.lower()
        if not self.quick.search(low):
            return []
        text = _WORD.findall(low)
        places = defaultdict(list)
        wanted = set().union(*(c for _, _, c in self.templates))
        for i, w in enumerate(text):
            if w in wanted:
                places[w].append(i)
        out, spans = [], None
        for (name, words, counts), keys in zip(self.templates, self.keys, strict=True):
            if keys.isdisjoint(places):
                continue
            need = self.min_coverage * len(words)
            if sum(min(n, len(places[w])) for w, n in counts.items() if w in places) < need:
                continue
            found = []
            for a, b in self._windows(places, counts, need, int(len(words) * self.reach) + 2):
                pairs = align(text[a:b], words)
                if len(pairs) < need:
                    continue
                if self.decisive is not None and spans is None:
                    spans = [m.span() for m in _WORD.finditer(low)]
                if self.decisive is None or self._decided(low, spans, [(a + i, j) for i, j in pairs], self.decisive[name]):
                    found.append((-len(pairs), a + pairs[0][0], a + pairs[-1][0] + 1))
            taken: list[tuple[int, int]] = []
            for n, a, b in sorted(set(found)):
                at = bisect_left(taken, (a, b))
                if (at == 0 or taken[at - 1][1] <= a) and (at == len(taken) or b <= taken[at][0]):
                    taken.insert(at, (a, b))
                    out.append((name, -n / len(words), a, b))
        return out

    @staticmethod
    def _decided(low: bytes, spans: list[tuple[int, int]], pairs: list[tuple[int, int]], wanted: dict[int, bytes]) -> bool:
        """Whether all deciding words of the template are aligned, and no others stand in between or behind."""
        if {w for _, j in pairs if (w := wanted.get(j)) is not None} != set(wanted.values()):
            return False
        last = pairs[-1][0]
        aligned, end = {i for i, _ in pairs}, last + 1
        # "version 2" is not in "version 2.1"
        while end < len(spans) and low[spans[end - 1][1]:spans[end][0]] == b"." and low[slice(*spans[end])].isdigit():
            end += 1
        own = set(wanted.values())
        return all(i in aligned or (i < last and w in own) for i, w in deciding(low, spans, pairs[0][0], end).items())

    @staticmethod
    def _windows(places: dict, counts: Counter, need: float, width: int) -> list[tuple[int, int]]:
        """Stretches of ``width`` words that begin with one of the template's words and hold enough of them."""
        hits = sorted((i, w) for w in counts for i in places.get(w, ()))
        have: Counter = Counter()
        held, end, found = 0, 0, []
        for i, w in hits:
            while end < len(hits) and hits[end][0] < i + width:
                v = hits[end][1]
                have[v] += 1
                held += have[v] <= counts[v]
                end += 1
            if held >= need:
                found.append((i, i + width))
            held -= have[w] <= counts[w]
            have[w] -= 1
        return found


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id",
                  text_col: str = "text", min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per finding: id, license, coverage, start_word, end_word."""
    scanner = Scanner(TEMPLATES if templates is None else templates, min_coverage, strict=True)
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))

    def run(batches):
        for whole in batches:
            for batch in byte_slices(whole, 1):
                found = [(i, *x) for i, t in enumerate(texts_as_bytes(batch.column(1))) for x in scanner.findings(t)]
                of, name, coverage, start, end = zip(*found, strict=True) if found else ((),) * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of, pa.int64())), pa.array(name, pa.string()),
                     pa.array(coverage, pa.float64()), pa.array(start, pa.int32()), pa.array(end, pa.int32())],
                    names=["key", "license", "coverage", "start_word", "end_word"])

    kind = rows.schema["key"].dataType.simpleString()
    return (rows.mapInArrow(run, f"key {kind}, license string, coverage double, start_word int, end_word int")
            .withColumnRenamed("key", id_col))


def op10_query(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))
