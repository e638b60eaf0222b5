"""License scans by patience alignment of texts with license templates.

Words that occur once in a stretch of the text and once in the template are anchors;
the longest increasing subsequence of their positions is kept, and the gaps between
anchors are aligned in the same way; gaps without anchors, of any size, by a longest
common subsequence. A template is found where the aligned words cover enough of it.

Where to align is settled by one pass over the text per template: the stretch that ends
at each word and gains most, where an aligned word gains and every word of the stretch
costs. A second copy is never worth the words between, so copies in a row are
stretches of their own. Exact bounds keep that pass to places that can reach the
coverage.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quartermill.llm.common import extend, list_array, text_buffer

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
COVERAGE = 0.8
#: A license may be spread over so many times the words of its template.
SPREAD = 2
#: What an aligned word gains and a word of the stretch costs. A stretch of the greatest
#: spread with the least coverage still gains, and a jump over a template's length costs
#: more than the words that such a copy may lack.
GAIN, COST = 10, 3
#: Tables of a common subsequence up to so many cells; larger ones are halved first.
CELLS = 1 << 22

# Notices, statements and texts of public licenses, by identifier. Those that
# differ from another one by a few words only (the notices of the GPL's relatives) are left out,
# since each would be found in the other.
TEMPLATES = {
    "Apache-2.0 statement": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MIT statement": "Released under the MIT License.",
    "MIT text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT complete text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "GPL-3.0 statement": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "BSD-2-Clause text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "ISC text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-2-Clause complete text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-3-Clause third clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "ISC complete text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "Unlicense text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "CC0-1.0 statement": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY-NC-4.0 statement": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 statement": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, in order of the first member, whose second members rise."""
    tops, at, back = [], [], []
    for k, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b)
            at.append(k)
        else:
            tops[pile], at[pile] = b, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with every beginning of ``b``."""
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == x)))
    return row


def subsequence(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Longest common subsequence of two arrays as pairs of positions, early in ``a`` where there is a choice."""
    if not len(a) or not len(b):
        return []
    if len(a) * len(b) > CELLS and len(a) > 1:
        half = len(a) // 2
        cut = int(np.argmax(lengths(a[:half], b) + lengths(a[half:][::-1], b[::-1])[::-1]))
        return subsequence(a[:half], b[:cut]) + [(i + half, j + cut) for i, j in subsequence(a[half:], b[cut:])]
    table = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    for i in range(len(a) - 1, -1, -1):
        below = table[i + 1]
        table[i, :-1] = np.maximum.accumulate(np.maximum(below[:-1], below[1:] + (b == a[i]))[::-1])[::-1]
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif table[i, j + 1] >= table[i + 1, j]:
            j += 1
        else:
            i += 1
    return out


def common_subsequence(a: list, b: list) -> list[tuple[int, int]]:
    """:func:`subsequence` of two lists of any values."""
    number: dict = {}
    return subsequence(*(np.array([number.setdefault(w, len(number)) for w in x], np.int64) for x in (a, b)))


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned positions of two word lists."""
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
        where = {w: k for k, w in enumerate(b[b0:b1], b0) if in_b[w] == 1 and in_a[w] == 1}
        anchors = increasing([(k, where[w]) for k, w in enumerate(a[a0:a1], a0) if w in where])
        if not anchors:
            out += [(a0 + i, b0 + j) for i, j in common_subsequence(a[a0:a1], b[b0:b1])]
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(edges, edges[1:])]
    return sorted(out)


class Template:
    """A template's words as numbers, and how to find them."""

    def __init__(self, name: str, text: str, vocabulary: dict[bytes, int]):
        self.name = name
        self.words = [vocabulary.setdefault(w, len(vocabulary)) for w in WORD.findall(text.encode().lower())]
        self.counts = Counter(self.words)
        row = np.array(self.words)
        self.equal = {w: row == w for w in self.counts}

    def need(self, coverage: float) -> int:
        """How many words must be aligned."""
        return max(1, int(np.ceil(coverage * len(self.words) - 1e-9)))

    def find(self, words: np.ndarray, coverage: float) -> list[tuple[float, int, int]]:
        """``(coverage, first word, behind the last word)`` of every place in the text, none of which overlap.

        ``words`` are numbers; those that no template has are -1.
        """
        size = len(self.words)
        need = self.need(coverage)
        out = []
        for low, high in self.regions(words, need):
            behind = low
            for start, stop in self.stretches(words, low, high, need):
                if start < behind:
                    continue
                pairs = patience(words[start:stop].tolist(), self.words)
                if len(pairs) >= need:
                    first, last = start + pairs[0][0], start + pairs[-1][0] + 1
                    out.append((len(pairs) / size, first, last))
                    behind = last
        return out

    def regions(self, words: np.ndarray, need: int) -> list[tuple[int, int]]:
        """Ranges of the text that may hold the template: enough of its words within its spread, each as often as it has them."""
        mine = np.zeros(len(words) + 1, bool)
        mine[:-1] = np.isin(words, np.array(list(self.counts)))
        spots = np.flatnonzero(mine[:-1])
        if len(spots) < need:
            return []
        dense = spots[need - 1 :] - spots[: len(spots) - need + 1] < SPREAD * len(self.words)
        reach = np.zeros(len(words) + 1, np.int64)
        np.add.at(reach, spots[: len(dense)][dense], 1)
        np.add.at(reach, spots[need - 1 :][dense] + 1, -1)
        inside = np.concatenate([[False], np.cumsum(reach[:-1]) > 0, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        out = []
        for low, high in zip(edges[::2].tolist(), edges[1::2].tolist()):
            values, counts = np.unique(words[low:high], return_counts=True)
            held = dict(zip(values.tolist(), counts.tolist()))
            if sum(min(n, held.get(w, 0)) for w, n in self.counts.items()) >= need:
                out.append((low, high))
        return out

    def stretches(self, words: np.ndarray, low: int, high: int, need: int) -> list[tuple[int, int]]:
        """Stretches of a region that may reach the coverage, each the best that begins where it does, in order."""
        size, bits = len(self.words), 40
        gain, cost, mask = GAIN << bits, COST << bits, (1 << bits) - 1
        # A column per beginning of the template; a cell holds the score, then the start of the stretch.
        row = np.zeros(size + 1, np.int64)
        least = GAIN * need - COST * SPREAD * size
        best: dict[int, tuple[int, int]] = {}
        for i in range(low, high):
            np.maximum(row, i, out=row)  # a stretch may begin at each word, with nothing
            hit = self.equal.get(int(words[i]))
            new = row - cost
            if hit is not None:
                new[1:][hit] = np.maximum(new[1:][hit], row[:-1][hit] + (gain - cost))
                np.maximum.accumulate(new, out=new)
            row = new
            score, start = int(row[-1]) >> bits, int(row[-1]) & mask
            if hit is not None and score >= least and score > best.get(start, (least - 1, 0))[0]:
                best[start] = (score, i + 1)
        # Where stretches overlap, the better one is taken.
        taken: list[tuple[int, int]] = []
        for start, (_, stop) in sorted(best.items(), key=lambda x: (-x[1][0], x[0])):
            if stop - start <= SPREAD * size and all(stop <= a or start >= b for a, b in taken):
                taken.append((start, stop))
        return sorted(taken)


class Templates:
    """All templates, and which of them a text has enough words for."""

    def __init__(self, texts: list[tuple[str, str]], coverage: float):
        self.vocabulary: dict[bytes, int] = {}
        made = [Template(*t, self.vocabulary) for t in texts]
        self.own = [t for t in made if t.words and t.need(coverage) <= len(t.words)]
        self.words = np.array([w for t in self.own for w in t.counts], np.int64)
        self.counts = np.array([n for t in self.own for n in t.counts.values()], np.int64)
        self.first = np.cumsum([0, *(len(t.counts) for t in self.own)])[:-1]
        self.needs = np.array([t.need(coverage) for t in self.own])

    def likely(self, words: np.ndarray) -> list[Template]:
        """Templates of whose words the text holds enough, each as often as the template has it."""
        known = words[words >= 0]
        if not self.own or len(known) < self.needs.min():
            return []
        there = np.bincount(known, minlength=len(self.vocabulary))
        held = np.add.reduceat(np.minimum(there[self.words], self.counts), self.first)
        return [self.own[k] for k in np.flatnonzero(held >= self.needs)]


def scan_licenses(docs: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """Add ``licenses``: what license templates cover which stretches of each text.

    Entries hold the template's name, the share of its words that are aligned (at least
    ``coverage``) and the stretch in code points, in order of place and name. Words are
    lower-cased runs of ASCII letters, digits and all characters outside ASCII. Null,
    empty and word-free texts have none, and so have all texts without templates; a
    license that a text repeats is found each time, altered copies in a row with their
    own coverage each. Alignment by unique words is not always the longest possible, so
    an altered copy close to the least coverage may be missed. Texts are scanned whole,
    repeated rows alike; empty tables give no rows; other columns pass through, save
    those named like the output.
    """
    plain = sorted(templates.items())

    def run(batch):
        templates = Templates(plain, coverage)
        get = templates.vocabulary.get
        data, offsets, _ = text_buffer(batch.column(batch.schema.names.index(text)))
        raw, at = data.tobytes(), offsets.tolist()
        counts, rows = [], []
        for x, y in zip(at, at[1:]):
            low = raw[x:y].lower()
            words = WORD.findall(low)
            numbers = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
            hits = sorted((a, t.name, share, b) for t in templates.likely(numbers) for share, a, b in t.find(numbers, coverage))
            if hits:
                spans = [(m.start(), m.end()) for m in WORD.finditer(low)]
                point = lambda k: len(low[:k].decode())
                rows += [(name, share, point(spans[a][0]), point(spans[b - 1][1])) for a, name, share, b in hits]
            counts.append(len(hits))
        kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64())
        parts = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        return [list_array(pa.StructArray.from_arrays(parts, names=["name", "coverage", "start", "stop"]), np.array(counts, np.int32))]

    return extend(docs, "licenses array<struct<name: string, coverage: double, start: long, stop: long>>", run, text)
