"""License scans: fingerprints of templates pick candidates, banded alignment decides.

A fingerprint is a single word: longer grams, and winnowing them, lose notices whose
changed words hit every gram.  An inverted index leads from a word to the templates
that have it, and every word of a document is looked up.  A diagonal is a candidate if
its band covers as many of a template's words as a match needs, so no match is lost.
Around it the words are aligned to the template's within the band; a match is reported
when at least ``COVERAGE`` of the template's words are matched in order and none of
them is in another match of it.

The templates are few and fixed, so they travel with the task.

Defined cases: null and wordless texts and those of fewer than ``LEAST_WORDS`` words have no matches; a template that occurs several
times in a text is reported each time; rows repeated whole are reported each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartulary.llm.shared import bounded_batches, row_blocks, utf8_column
from cartulary.llm.wordhash import word_hashes

LEAST_WORDS, BAND, COVERAGE = 5, 8, 0.8

# Public license texts, headers and notices.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "mit-notice": "Released under the MIT License.",
    "mit-grant": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc0-1.0-notice": "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
    "gpl-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
        "or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "lgpl-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
    ),
    "agpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    ),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "mit": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
        "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
        "notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY '
        "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the "
        "use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions: "
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, "
        "an acknowledgment in the product documentation would be appreciated but is not required. "
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that "
        "recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make "
        "this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
        "relinquishment in perpetuity of all present and future rights to this software under copyright law."
    ),
    "bsl-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by "
        'this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, '
        "and to permit third-parties to whom the Software is furnished to do so, all subject to the following: "
        "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be "
        "included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in "
        "the form of machine-executable object code generated by a source language processor."
    ),
}


def _words(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return word_hashes(raw, np.array([0, len(raw)]), digits=True)[0]


class Index:
    """Inverted index from a word to the templates that have it, and how often."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        self.words = [_words(t) for t in templates.values()]
        self.need = [least_matched(len(w)) for w in self.words]
        self.hashes = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.words]))
        # often[k][x]: how often template k has word x of ``hashes``; the last column is for all other words
        self.often = np.zeros((len(self.words), len(self.hashes) + 1), np.int64)
        for often, w in zip(self.often, self.words):
            np.add.at(often, np.searchsorted(self.hashes, w), 1)

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """Place of each word in ``hashes``, their number for words of no template."""
        at = np.searchsorted(self.hashes, h)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == h[known]
        return np.where(known, at, len(self.hashes))

    def candidates(self, at: np.ndarray, owner: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Per template the rows with enough of its words, repeated or not, within the words that one band covers."""
        out = []
        for k, w in enumerate(self.words):
            mine = (self.often[k] > 0)[at]
            count = np.concatenate(([0], np.cumsum(mine)))
            last = np.flatnonzero(mine)
            enough = count[last + 1] - count[np.maximum(last + 1 - len(w) - 2 * BAND, 0)] >= self.need[k]
            out.append((k, np.unique(owner[last[enough]])))
        return out

    def diagonals(self, k: int, at: np.ndarray) -> list[int]:
        """Diagonals whose band covers enough words of the template, none counted oftener than the template has it."""
        n, m = len(self.words[k]), len(at)
        d = np.arange(self.need[k] - n - BAND, m + BAND - self.need[k] + 1)
        lo, hi = np.clip(d - BAND, 0, m), np.clip(d + n + BAND, 0, m)
        total = np.zeros(len(d), np.int64)
        for x in np.flatnonzero(self.often[k]).tolist():
            places = np.flatnonzero(at == x)
            if len(places):
                total += np.minimum(np.searchsorted(places, hi) - np.searchsorted(places, lo), self.often[k][x])
        return d[total >= self.need[k]].tolist()

    def scan(self, h: np.ndarray) -> list[tuple[int, float, int, int]]:
        """Matches (template, coverage, first word, end) in the words of one text."""
        if len(h) < LEAST_WORDS:
            return []
        at = self.look_up(h)
        found = []
        for k, rows in self.candidates(at, np.zeros(len(h), np.int64)):
            if len(rows):
                found += [(k, *hit) for hit in occurrences(self.words[k], h, self.diagonals(k, at))]
        return sorted(found, key=lambda x: (x[2], x[0]))


def least_matched(n: int) -> int:
    """The fewest words of ``n`` that are ``COVERAGE``."""
    return next(x for x in range(n + 1) if x >= COVERAGE * n)


def occurrences(template: np.ndarray, text: np.ndarray, diagonals: list[int]) -> list[tuple[float, int, int]]:
    """Matches that share no word, from the alignments around ``diagonals``: exact ones first, then those with the
    fewest words missing or between.  An alignment that meets a reported match is sought again in the words left."""
    n, m = len(template), len(text)
    need, mine = least_matched(n), np.isin(text, template)
    taken, found, queue = np.zeros(m, bool), [], []
    for d in diagonals:
        if 0 <= d <= m - n and not taken[d : d + n].any() and (text[d : d + n] == template).all():
            taken[d : d + n] = True
            found.append((1.0, d, d + n))

    def seek(d: int) -> None:
        lo, hi = max(d - BAND, 0), min(d + n + BAND, m)
        edges = np.flatnonzero(np.diff(np.concatenate(([1], taken[lo:hi], [1]))))
        for x, y in zip((edges[::2] + lo).tolist(), (edges[1::2] + lo).tolist()):
            if mine[x:y].sum() >= need and (hit := aligned(template, text[x:y], d - x)):
                coverage, first, end = hit
                matched = round(coverage * n)
                heapq.heappush(queue, (n + end - first - 2 * matched, first + x, end + x, coverage, d))

    for d in diagonals:
        seek(d)
    while queue:
        _, first, end, coverage, d = heapq.heappop(queue)
        if taken[first:end].any():
            seek(d)
        else:
            taken[first:end] = True
            found.append((coverage, first, end))
            seek(d)
    return found


def aligned(template: np.ndarray, text: np.ndarray, diagonal: int) -> tuple[float, int, int] | None:
    """Longest common subsequence of the template and the text around a diagonal, within the band, the one over the
    fewest words of the text: (coverage, first matched word, end), or None below ``COVERAGE``."""
    n = len(template)
    if 0 <= diagonal and diagonal + n <= len(text) and (text[diagonal : diagonal + n] == template).all():
        return 1.0, diagonal, diagonal + n
    width = 2 * BAND + 1
    words, wanted = text.tolist(), template.tolist()
    # best[c]: (matched, latest beginning) of the prefix ending at band column c; top: (matched, -span, end)
    best, top = [(0, -1)] * (width + 1), (0, 0, 0)
    for i in range(n):
        row = [(0, -1)] * (width + 1)
        left = (0, -1)
        for c in range(width):
            j = diagonal + i + c - BAND
            up = best[c + 1]  # same text place, template word skipped
            cell = max(up, left)
            if 0 <= j < len(words) and words[j] == wanted[i]:
                m, first = best[c]
                first = first if m else j
                cell = max(cell, (m + 1, first))
                top = max(top, (m + 1, first - j - 1, j + 1))
            row[c] = left = cell
        best = row
    matched, span, end = top
    return (matched / n, end + span, end) if matched >= COVERAGE * n else None


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """A row per match: doc_id, license, coverage, span_start, span_end (bytes of the UTF-8 text), n_words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        for b in batches:
            offsets, raw = utf8_column(b, "text")
            ids, rows = b.column("doc_id").to_pylist(), []
            for i, j in row_blocks(offsets, 1 << 19):
                h, owner, first, end, _ = word_hashes(raw, offsets[i : j + 1], digits=True)
                if not len(h):
                    continue
                cuts = np.searchsorted(owner, np.arange(j - i + 1))
                some = np.unique(np.concatenate([r for _, r in index.candidates(index.look_up(h), owner)]))
                for r in some.tolist():
                    lo, hi = cuts[r], cuts[r + 1]
                    for k, coverage, x, y in index.scan(h[lo:hi]):
                        span = int(first[lo + x] - offsets[i + r]), int(end[lo + y - 1] - offsets[i + r])
                        rows.append((ids[i + r], index.names[k], coverage, *span, y - x))
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "license", "coverage", "span_start", "span_end", "n_words"])

    bounded_batches(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, license string, coverage double, span_start long, span_end long, n_words long")
