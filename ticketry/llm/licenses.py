"""License scans by patience alignment.

Where a text may hold a template is told by their common word pairs: each votes for the place the
template would start at. Places are looked at by their votes, most first, in windows that end at
findings made before, so copies that stand back to back are told apart. In a window, text and
template are aligned by patience: words that occur once in both are anchors, the longest increasing
sequence of them stays, and the gaps between are aligned the same way, those without anchors
exactly. The share of template words that are matched is the coverage.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from ticketry.llm.common import keyed

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    " and associated documentation files (the \"Software\"), to deal in the Software without"
    " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
    " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
    " Software is furnished to do so, subject to the following conditions:"
)
_GNU = (
    "{0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1}"
    " as published by the Free Software Foundation; either version {2} of the License, or (at your"
    " option) any later version. {0} is distributed in the hope that it will be useful, but WITHOUT"
    " ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR"
    " PURPOSE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met: Redistributions of source code must retain the"
    " above copyright notice, this list of conditions and the following disclaimer. Redistributions"
    " in binary form must reproduce the above copyright notice, this list of conditions and the"
    " following disclaimer in the documentation and/or other materials provided with the"
    " distribution.{} THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND"
    " ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF"
    " MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE"
    " COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,"
    " EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE"
    " GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND"
    " ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING"
    " NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF"
    " THE POSSIBILITY OF SUCH DAMAGE."
)
# The wording of public license notices.
TEMPLATES = {
    "MIT-full": _MIT + (
        " The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF"
        " ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,"
        " FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
        " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF"
        " CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE"
        " OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD-2-Clause": _BSD.format(""),
    "BSD-3-Clause": _BSD.format(
        " Neither the name of the copyright holder nor the names of its contributors may be used to"
        " endorse or promote products derived from this software without specific prior written"
        " permission."
    ),
    "GPL-2.0-header": _GNU.format("This program", "General Public License", "2"),
    "LGPL-2.1-header": _GNU.format("This library", "Lesser General Public License", "2.1"),
    "LGPL-3.0-header": _GNU.format("This library", "Lesser General Public License", "3"),
    "AGPL-3.0-header": _GNU.format("This program", "Affero General Public License", "3"),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy,"
        " modify, publish, use, compile, sell, or distribute this software, either in source code form or"
        " as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file"
        " except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in"
        " writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT"
        " WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation, either version"
        " 3 of the License, or (at your option) any later version. This program is distributed in the"
        " hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
        " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": _MIT,
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this permission"
        " notice appear in all copies."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy"
        " of the MPL was not distributed with this file, You can obtain one at"
    ),
}

#: Pairs of these words say nothing about a place.
COMMON = frozenset("a an and any at be by for in is it of on or that the this to with".split())
WORD = re.compile(r"[^\W_]+(?:\.\d+)*")
#: Coverage a finding needs, in percent of the template's words.
COVERAGE = 80
#: Words that a window reaches beyond the template's length, before the widest is tried.
SLACK = 8


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def patience(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched positions (text, template), increasing in both."""
    found: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        anchors = _anchors(text, template, a, b, c, d)
        if anchors:
            edges = [(a - 1, c - 1), *anchors, (b, d)]
            gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
            found += anchors
        else:
            found += _common(text, template, a, b, c, d)
    return sorted(found)


def _anchors(text, template, a, b, c, d) -> list[tuple[int, int]]:
    """Words that occur once in both gaps: the longest increasing sequence of their places."""
    here, there = Counter(text[a:b]), Counter(template[c:d])
    once = {w for w in here.keys() & there.keys() if here[w] == there[w] == 1}
    at = {text[i]: i for i in range(a, b) if text[i] in once}
    pairs = [(at[template[j]], j) for j in range(c, d) if template[j] in once]
    ends: list[int] = []  # text place that ends the best sequence of each length
    last, before = [], [-1] * len(pairs)
    for n, (i, _) in enumerate(pairs):
        k = bisect_left(ends, i)
        ends[k : k + 1] = [i]
        last[k : k + 1] = [n]
        before[n] = last[k - 1] if k else -1
    out, n = [], last[-1] if last else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def _common(text, template, a, b, c, d) -> list[tuple[int, int]]:
    """A longest common subsequence of a gap without anchors."""
    rows = [[0] * (d - c + 1) for _ in range(b - a + 1)]
    for i in range(b - a - 1, -1, -1):
        for j in range(d - c - 1, -1, -1):
            same = text[a + i] == template[c + j]
            rows[i][j] = rows[i + 1][j + 1] + 1 if same else max(rows[i + 1][j], rows[i][j + 1])
    out, i, j = [], 0, 0
    while i < b - a and j < d - c:
        if text[a + i] == template[c + j]:
            out.append((a + i, c + j))
            i, j = i + 1, j + 1
        elif rows[i + 1][j] >= rows[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def _pairs(templates: dict[str, list[str]]) -> dict[tuple[str, str], list[tuple[str, int]]]:
    index: dict[tuple[str, str], list[tuple[str, int]]] = {}
    for name, listed in templates.items():
        for i in range(len(listed) - 1):
            if listed[i] not in COMMON or listed[i + 1] not in COMMON:
                index.setdefault((listed[i], listed[i + 1]), []).append((name, i))
    return index


def places(found: list[str], index) -> dict[str, dict[int, list[int]]]:
    """Template -> place it would start at -> places of the word pairs that vote for it."""
    votes: dict[str, dict[int, list[int]]] = {}
    if index.keys().isdisjoint(zip(found, found[1:])):
        return votes
    for i, pair in enumerate(zip(found, found[1:])):
        for name, j in index.get(pair, ()):
            votes.setdefault(name, {}).setdefault(i - j, []).append(i)
    return votes


def _compact(found: list[str], matched: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same words, each as late before the next as it occurs; the last one stays."""
    out = matched[-1:]
    for i, j in reversed(matched[:-1]):
        at = out[-1][0] - 1
        while found[at] != found[i]:
            at -= 1
        out.append((at, j))
    return out[::-1]


def _finding(found: list[str], listed: list[str], start: int, lo: int, hi: int, need: int):
    """(first word, word after the last, matched words) of a copy near ``start`` in lo..hi, or None."""
    n = len(listed)
    a, b = max(lo, start - n), min(hi, start + 2 * n)
    here = Counter(found[a:b])
    if sum(min(k, here[w]) for w, k in Counter(listed).items()) < need:
        return None
    best, tried = None, set()
    for more in (0, min(SLACK, n), n):
        window = a, b = max(lo, start - more), min(hi, start + n + more)
        if b - a < need or window in tried:
            continue
        tried.add(window)
        matched = patience(found[a:b], listed)
        if len(matched) < need:
            continue
        matched = _compact(found[a:b], matched)
        first, last = a + matched[0][0], a + matched[-1][0] + 1
        if last - first > 2 * n:
            continue
        # Words that are put in weigh against words that are matched, so that copies stay apart.
        score = 3 * len(matched) - (last - first), len(matched)
        if best is None or score > best[0]:
            best = score, (first, last, len(matched))
        if len(matched) == n == last - first:
            break
    return best and best[1]


def _copies(found: list[str], listed: list[str], votes: dict[int, list[int]], coverage: int):
    """(first word, word after the last, matched words) of each copy of a template; none overlap."""
    need = -(-coverage * len(listed) // 100)
    taken: list[tuple[int, int, int]] = []
    for start in sorted(votes, key=lambda s: (-len(votes[s]), s)):
        looked = -1  # end of the free stretch looked at last
        for place in votes[start]:
            if place < looked:
                continue
            k = bisect_right(taken, (place, len(found) + 1, 0))
            lo = taken[k - 1][1] if k else 0
            hi = taken[k][0] if k < len(taken) else len(found)
            if place < lo:
                continue  # inside a finding
            looked = hi
            hit = _finding(found, listed, start, lo, hi, need)
            if hit:
                insort(taken, hit)
    return taken


def scan(text: str, templates: dict[str, list[str]], index, coverage: int = COVERAGE):
    """(template, first word, word after the last, matched words) of each finding in a text."""
    found = words(text)
    hits = []
    for name, votes in places(found, index).items():
        hits += [(name, *hit) for hit in _copies(found, templates[name], votes, coverage)]
    # A notice inside a longer one is part of it; of one stretch, the wording that fits best stays.
    hits.sort(key=lambda h: (h[1] - h[2], -h[3], len(templates[h[0]]), h[0]))
    kept: list[tuple] = []
    for hit in hits:
        if not any(k[1] <= hit[1] and hit[2] <= k[2] and k[3] >= hit[3] for k in kept):
            kept.append(hit)
    return sorted(kept, key=lambda h: (h[1], h[0]))


def scan_licenses(
    documents: DataFrame, templates: dict[str, str] | None = None, coverage: int = COVERAGE
) -> DataFrame:
    """__id, __th, license, start, end (words), matched and template_words of each finding.

    A finding matches at least ``coverage`` percent of a template's words, in order and within twice
    its length; words are runs of letters and digits in lower case. Null and empty texts, and
    texts without a notice, give no rows; equal rows give equal findings; an empty table gives an
    empty result. Whole texts are scanned, one at a time.
    """
    listed = {n: words(t) for n, t in (templates or TEMPLATES).items()}
    if any(len(w) < 2 for w in listed.values()):
        raise ValueError("a template has two words or more")

    def run(batches):
        index = _pairs(listed)
        names = ["__id", "__th", "license", "start", "end", "matched", "template_words"]
        kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4]
        for batch in batches:
            out = [[] for _ in names]
            rows = zip(*(batch.column(c).to_pylist() for c in ("__id", "__th", "__text")))
            for doc, th, text in rows:
                for name, first, last, matched in scan(text, listed, index, coverage):
                    row = (doc, th, name, first, last, matched, len(listed[name]))
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(list(map(pa.array, out, kinds)), names)

    return keyed(documents).mapInArrow(
        run,
        "__id long, __th long, license string, start long, end long, matched long, template_words long",
    )
