"""License scans: an inverted index of winnowed fingerprints, then banded alignment.

The templates' runs of words are hashed and winnowed; the index maps fingerprints to
templates and places.  Runs are of ``k`` words, of two in notices shorter than ``short``
words, whose pairs are all kept.  Texts look up all their runs, so a run of k + window - 1
shared words (two in a short notice) always meets the index.  Hits of one template on near
diagonals form a candidate; if enough of the template's words stand there, a banded
alignment counts the matched words and gives the matched span.  A finding needs ``coverage``
of the template's words and at least one such run.

The templates are a fixed list, so the index has a fixed size and travels with the code;
texts are read once, without a shuffle.

Defined results: null and empty texts have no findings and so no rows; a null id is kept;
rows repeated are scanned each; a finding is reported for the best template of its place, of
equal ones the first by name; a template may be found many times in one text; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abundara.llm.common import text_bytes

#: Texts and notices of public licenses, without their copyright lines.
_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
TEMPLATES = {
    "MIT": f"{_MIT_GRANT} {_WARRANTY}",
    "MIT-grant": _MIT_GRANT,
    "MIT-notice": "Released under the MIT License.",
    "BSD-2-Clause": f"{_BSD_START} {_BSD_END}",
    "BSD-3-Clause": f"{_BSD_START} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. {_BSD_END}",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "GPL-3.0-start": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}
EDGE = b".,;:()\"'!?*#$%&|<>[]{}"


def words_of(text: bytes) -> list[bytes]:
    return [w.strip(EDGE) for w in text.lower().split()]


class Index:
    """Winnowed fingerprints of the templates, and their words as small numbers (0: no template's word)."""

    def __init__(self, templates: dict[str, str], k: int, window: int, short: int = 15):
        self.names = list(templates)
        words = [words_of(t.encode()) for t in templates.values()]
        self.number = {w: n + 1 for n, w in enumerate(sorted({w for ws in words for w in ws}))}
        self.templates = [np.array([self.number[w] for w in ws], np.int64) for ws in words]
        self.places: dict[int, dict[int, list[tuple[int, int]]]] = {}  # length of a run, its digest, templates and places
        for t, ids in enumerate(self.templates):
            size, near = (k, window) if len(ids) >= short else (min(2, len(ids)), 1)
            runs, places = self.runs(ids, size), self.places.setdefault(size, {})
            for at in sorted({max(range(a, min(a + near, len(runs))), key=lambda j: (-int(runs[j]), j)) for a in range(max(1, len(runs) - near + 1))} if len(runs) else ()):
                places.setdefault(int(runs[at]), []).append((t, at))
        self.keys = {size: np.array(sorted(p), np.uint64) for size, p in self.places.items()}

    def runs(self, ids: np.ndarray, k: int) -> np.ndarray:
        """Digests of all runs of k words."""
        if len(ids) < k or not k:
            return np.zeros(0, np.uint64)
        total = np.zeros(len(ids) - k + 1, np.uint64)
        for j in range(k):
            total = (total + ids[j : j + len(total)].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
        return total

    def hits(self, ids: np.ndarray):
        """(template, diagonal) of all runs of a text that the index holds."""
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        for size, places in self.places.items():
            if len(ids) < size:
                continue
            start = np.flatnonzero(known[size:] - known[:-size] == size)
            runs = self.runs(ids, size)[start]
            hit = np.isin(runs, self.keys[size])
            for at, run in zip(start[hit].tolist(), runs[hit].tolist(), strict=True):
                for t, place in places[run]:
                    yield t, at - place

    def numbers(self, words: list[bytes]) -> np.ndarray:
        get = self.number.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))


def align(template: np.ndarray, text: np.ndarray, offset: int, band: int) -> tuple[int, int, int]:
    """Most template words matched in order within ``band`` of a diagonal, and the matched span of text (end exclusive)."""
    width = 2 * band + 1
    count = np.zeros(width + 1, np.int64)  # best count at each diagonal; the last stands outside the band
    first = np.full(width + 1, -1, np.int64)
    last = np.full(width + 1, -1, np.int64)
    for i, word in enumerate(template.tolist()):
        at = i + offset - band + np.arange(width)
        inside = (at >= 0) & (at < len(text))
        match = np.zeros(width, bool)
        match[inside] = text[at[inside]] == word
        new = count.copy()
        new_first, new_last = first.copy(), last.copy()
        # a template word skipped: the diagonal falls by one
        new[:-2], new_first[:-2], new_last[:-2] = count[1:-1], first[1:-1], last[1:-1]
        new[width - 1], new_first[width - 1], new_last[width - 1] = 0, -1, -1
        took = match & (count[:-1] + 1 > new[:-1])
        new[:-1][took] = count[:-1][took] + 1
        new_first[:-1][took] = np.where(first[:-1][took] < 0, at[took], first[:-1][took])
        new_last[:-1][took] = at[took]
        for d in range(1, width):  # a text word skipped: the diagonal rises
            if new[d - 1] > new[d]:
                new[d], new_first[d], new_last[d] = new[d - 1], new_first[d - 1], new_last[d - 1]
        count, first, last = new, new_first, new_last
        # stepping to the next template word keeps the diagonal
    best = int(count[:-1].argmax())
    return int(count[best]), int(first[best]), int(last[best]) + 1


def find(index: Index, text: bytes, coverage: float, band: int) -> list[tuple[str, float, int, int, int]]:
    """(template, coverage, matched words, first word, last word + 1) of each finding, by place."""
    ids = index.numbers(words_of(text))
    diagonals = sorted(set(index.hits(ids)))
    found, done = [], {}
    for t, diagonal in diagonals:
        template = index.templates[t]
        n = len(template)
        near = min(band, max(1, n // 3))  # a short notice's next occurrence lies beyond its band
        need = int(np.ceil(coverage * n - 1e-9))
        if diagonal + n // 2 < done.get(t, 0):
            continue  # its middle lies in an accepted occurrence
        part = ids[max(0, diagonal - near) : diagonal + n + near]
        if np.isin(template, part).sum() < need:
            continue
        matched, a, b = align(template, ids, diagonal, near)
        if matched >= need:
            found.append((index.names[t], matched / n, matched, a, b))
            done[t] = max(done.get(t, 0), b)
    found.sort(key=lambda f: (-f[2], f[3], f[0]))
    starts, kept = [], []  # accepted spans lie apart, so a new one need be compared with its neighbours only
    for f in found:
        k = bisect.bisect_left(starts, f[3])
        if (k == 0 or kept[k - 1][4] <= f[3]) and (k == len(kept) or f[4] <= starts[k]):
            starts.insert(k, f[3])
            kept.insert(k, f)
    return kept


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, k: int = 5, window: int = 4, coverage: float = 0.8, band: int = 8) -> DataFrame:
    """doc_id, license, coverage, matched_words, start_word, end_word of every finding."""
    chosen = templates or TEMPLATES

    def run(batches):
        index = Index(chosen, k, window)
        for batch in batches:
            rows = [(key, *f) for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for f in find(index, text.as_py(), coverage, band)]
            if rows:
                kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
                names = ["doc_id", "license", "coverage", "matched_words", "start_word", "end_word"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "doc_id long, license string, coverage double, matched_words long, start_word long, end_word long"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text")).mapInArrow(run, schema)
