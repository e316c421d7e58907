"""License scan: winnowed fingerprints of templates find candidates, banded alignment measures them.

Texts and templates are words in lower case without punctuation. Every K words have a hash; of each WINDOW hashes in a row the smallest is a fingerprint
(winnowing), so a run of K + WINDOW - 1 common words always gives a common fingerprint. An inverted index from fingerprints to places in templates is
small and goes to every task. Where few changes can break every such run, in templates under BRIEF words, all hashes are looked up; and in those whose allowed changes can leave runs of under K words, hashes of two
words too, of which two must be near each other. Hits of a template near one diagonal are a candidate, and the template is aligned with the text there, within a
band: that gives the words of the template that the text has (coverage) and where they begin and end in the text (span, in code points).
Templates are notices, headers, short licenses, and of the long ones (Apache-2.0, GPL) the sections that grant rights or open them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from . import hashing
from .common import map_texts, prepare

#: Words of a hash, hashes of a window, least share of a template's words.
K, WINDOW, COVERAGE = 3, 3, 0.8
#: Words of a template under which all its hashes are looked up.
BRIEF = 40
#: Half the width of the band: words, and the share of a template's words, that a text may have more or less up to a place.
BAND_WORDS, BAND_SHARE = 6, 0.15

# Templates as (license, text). Names and years of holders are left out.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("all-rights-reserved", "All rights reserved. No part of this work may be reproduced without permission."),
    ("all-rights-reserved", "All rights reserved."),
    ("BSD", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("Apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."),
    ("Apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable (except as stated in this section) patent license to make, have made, use, offer to sell, sell, import, and otherwise transfer the Work, where such license applies only to those patent claims licensable by such Contributor that are necessarily infringed by their Contribution(s) alone or by combination of their Contribution(s) with the Work to which such Contribution(s) was submitted."),
    ("GPL-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most software and other practical works are designed to take away your freedom to share and change the works. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change all versions of a program--to make sure it remains free software for all its users."),
    ("GPL-2.0", "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change free software--to make sure the software is free for all its users. This General Public License applies to most of the Free Software Foundation's software and to any other program whose authors commit to using it."),
]


@dataclass
class Match:
    """A template in a text: words of it that the text has, of how many; first and last word in the text."""

    template: int
    matched: int
    words: int
    first: int
    last: int

    @property
    def coverage(self) -> float:
        return self.matched / self.words


def grams(h: np.ndarray, doc: np.ndarray | None = None, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k words in a row, and where they begin; none goes over the end of a document (doc: that of each word)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = hashing.mix(out * np.uint64(0xD6E8FEB86659FD93) + h[j : j + n])
    at = np.arange(n) if doc is None else np.flatnonzero(doc[:n] == doc[k - 1 :])
    return out[at], at


def fingerprints(g: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which hashes are the smallest of a window; windows at a document's end are shorter. doc: that of each hash."""
    n = len(g)
    chosen = np.zeros(n, bool)
    if not n:
        return chosen
    top = np.uint64(2**64 - 1)
    least = g.copy()
    for j in range(1, min(WINDOW, n)):
        least[:-j] = np.minimum(least[:-j], np.where(doc[j:] == doc[:-j], g[j:], top))
    for j in range(min(WINDOW, n)):
        chosen[j:] |= (g[j:] == least[: n - j]) & (doc[j:] == doc[: n - j])
    return chosen


def _run(n: int) -> int:
    """Words in a row that n words still have, at least, when as many are changed as COVERAGE allows."""
    changed = n - math.ceil(COVERAGE * n)
    return -(-(n - changed) // (changed + 1))


class _Places:
    """Hashes, sorted, and the (template, place) of each."""

    def __init__(self, rows: list[tuple[int, int, int]]) -> None:
        rows = sorted(rows)
        self.hashes = np.array([r[0] for r in rows], np.uint64)
        self.places = np.array([r[1:] for r in rows], np.int64).reshape(-1, 2)

    def hits(self, g: np.ndarray) -> Iterator[tuple[int, list[list[int]]]]:
        """Which of some hashes are here, and where."""
        if len(g) and len(self.hashes):
            first = np.searchsorted(self.hashes, g, "left")
            for i in np.flatnonzero(self.hashes[np.minimum(first, len(self.hashes) - 1)] == g):
                yield int(i), self.places[first[i] : np.searchsorted(self.hashes, g[i], "right")].tolist()


class Index:
    """Fingerprints of templates, all hashes of the brief ones, and the pairs of words of those that changes can leave without K words in a row."""

    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES) -> None:
        self.names = [n for n, _ in templates]
        self.words = [hashing.words([t], hashing.PLAIN).hashes for _, t in templates]
        winnowed, all_, pairs = [], [], []
        for i, h in enumerate(self.words):
            g, at = grams(h)
            brief = len(h) < BRIEF
            for j in range(len(g)) if brief else np.flatnonzero(fingerprints(g, np.zeros(len(g)))):
                (all_ if brief else winnowed).append((int(g[j]), i, int(at[j])))
            if _run(len(h)) < K:
                g, at = grams(h, k=2)
                pairs += [(int(x), i, int(p)) for x, p in zip(g, at, strict=True)]
        self.winnowed, self.all, self.pairs = _Places(winnowed), _Places(all_), _Places(pairs)

    def scan(self, texts: list[str | None]) -> Iterator[tuple[int, Match, int, int]]:
        """Of some texts: (number of the text, match, start, end in code points)."""
        found = hashing.words(texts, hashing.PLAIN)
        doc = np.repeat(np.arange(len(texts)), np.diff(found.first))
        g, at = grams(found.hashes, doc)
        chosen = np.flatnonzero(fingerprints(g, doc[at]))
        two, two_at = grams(found.hashes, doc, 2)
        hits: dict[tuple[int, int], list[tuple[int, int]]] = {}
        loose: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for index, hashes, starts, out in ((self.winnowed, g[chosen], at[chosen], hits), (self.all, g, at, hits), (self.pairs, two, two_at, loose)):
            for i, places in index.hits(hashes):
                for template, place in places:
                    out.setdefault((int(doc[starts[i]]), template), []).append((int(starts[i]), place))
        for key, places in loose.items():  # a pair of words alone says little: another must be near it
            places.sort()
            reach = BAND_WORDS + 2 * len(self.words[key[1]])
            near = [p for n, p in enumerate(places) if (n and p[0] - places[n - 1][0] <= reach) or (n + 1 < len(places) and places[n + 1][0] - p[0] <= reach)]
            if near:
                hits.setdefault(key, []).extend(near)
        by_doc: dict[int, list[Match]] = {}
        for (d, template), places in hits.items():
            begin, end = int(found.first[d]), int(found.first[d + 1])
            by_doc.setdefault(d, []).extend(self._candidates(template, [(x - begin, p) for x, p in places], found.hashes[begin:end]))
        for d, matches in sorted(by_doc.items()):
            base = int(found.base[d])
            raw = (texts[d] or "").encode("utf-8", "surrogatepass")
            for m in outer(matches):
                a, b = int(found.starts[found.first[d] + m.first]) - base, int(found.ends[found.first[d] + m.last]) - base
                yield d, m, len(raw[:a].decode("utf-8", "surrogatepass")), len(raw[:b].decode("utf-8", "surrogatepass"))

    def _candidates(self, template: int, places: list[tuple[int, int]], text: np.ndarray) -> Iterator[Match]:
        """Hits along a diagonal, parted where it moves by more than the band, to alignments."""
        words = self.words[template]
        band = BAND_WORDS + int(BAND_SHARE * len(words))
        groups: list[list[tuple[int, int]]] = []
        for x, p in sorted(places, key=lambda h: (h[0] - h[1], h[0])):
            if groups and x - p - (groups[-1][-1][0] - groups[-1][-1][1]) <= band:
                groups[-1].append((x, p))
            else:
                groups.append([(x, p)])
        for group in groups:
            for near in _near(sorted(group), len(words)):
                diagonals = sorted(x - p for x, p in near)
                found = align(words, text, diagonals[len(diagonals) // 2], band, template)
                if found and found.coverage >= COVERAGE:
                    yield found


def _near(group: list[tuple[int, int]], length: int) -> list[list[tuple[int, int]]]:
    """Hits in order of the text, parted where the template begins again."""
    out: list[list[tuple[int, int]]] = []
    for x, p in group:
        if out and not (p <= out[-1][-1][1] and x - out[-1][0][0] >= length // 2) and x - out[-1][0][0] < 2 * length:
            out[-1].append((x, p))
        else:
            out.append([(x, p)])
    return out


def align(words: np.ndarray, text: np.ndarray, diagonal: int, band: int, template: int = 0) -> Match | None:
    """The template's words in the text, place i near place i + diagonal: the most matches, with as few gaps as can be, within the band."""
    n, width = len(words), 2 * band + 1
    columns = np.arange(width)
    score = np.full((n + 1, width), -(10**6), np.int64)
    step = np.zeros((n + 1, width), np.int8)
    # row i: the first i words are done; column c: the text is at place i + diagonal + c - band
    place = diagonal + columns - band
    score[0, (place >= 0) & (place <= len(text))] = 0
    for i in range(1, n + 1):
        x = place + i
        there = (x >= 0) & (x <= len(text))
        same = there & (x >= 1)
        same[same] = text[x[same] - 1] == words[i - 1]
        open_ = (x >= 1) & (score[i - 1] > -(10**5))
        best = np.where(open_, score[i - 1] + np.where(same, 3, -1), -(10**6))
        how = np.where(open_, 1, 0)
        skip = np.append(score[i - 1, 1:], -(10**6)) - 1  # a word of the template that the text lacks
        how = np.where(skip > best, 2, how)
        best = np.where(there, np.maximum(best, skip), -(10**6))
        if i < n:  # words of the text that the template lacks
            run = np.maximum.accumulate(np.where(there, best + columns, -(10**7))) - columns
            how = np.where(there & (run > best), 3, how)
            best = np.where(there, np.maximum(best, run), -(10**6))
        score[i], step[i] = best, how
    i, c = n, int(np.lexsort((np.abs(columns - band), -score[n]))[0])  # of equal ones the nearest to the diagonal
    if score[n, c] <= -(10**5):
        return None
    matched, first, last = 0, -1, -1
    while i > 0:
        x, how = i + diagonal + c - band, step[i, c]
        if how == 1:
            if words[i - 1] == text[x - 1]:
                matched, first, last = matched + 1, x - 1, x - 1 if last < 0 else last
            i -= 1
        elif how == 2:
            i, c = i - 1, c + 1
        elif how == 3:
            c -= 1
        else:
            break
    return Match(template, matched, n, first, last) if matched else None


def outer(matches: list[Match]) -> list[Match]:
    """Without matches of which half the words or more lie within one with more words: a short notice is part of a longer header; of equal spans the best covered stays."""
    kept: list[Match] = []
    for m in sorted(matches, key=lambda m: (-m.matched, -m.coverage, m.first, m.template)):
        if not any(2 * (min(k.last, m.last) - max(k.first, m.first) + 1) >= m.last - m.first + 1 for k in kept):
            kept.append(m)
    return sorted(kept, key=lambda m: (m.first, m.template))


SCHEMA = "doc_id long, license string, template int, coverage double, matched_words int, start long, end long"


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """A row for each license text in each row of docs (doc_id, text), with its coverage and its span in code points.

    Null, empty and clean texts have no rows; repeated rows and null ids have theirs each. A text may have several, also of one license. The index grows
    with the templates only. Texts of any length are read whole. Other columns are not read, whatever their names; an empty table gives no rows.
    """
    shared = prepare(docs.sparkSession).sparkContext.broadcast(Index(templates))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for b in batches:
            texts, ids, rows = b["text"].tolist(), b["doc_id"].tolist(), []
            for begin, end in hashing.chunks(texts):
                rows += [(ids[begin + d], index.names[m.template], m.template, m.coverage, m.matched, s, e) for d, m, s, e in index.scan(texts[begin:end])]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return map_texts(docs, run, SCHEMA)
