"""License texts in documents: winnowed fingerprints pick candidates, banded alignment decides.

1. Templates are cut into words; hashes of K-word runs are winnowed over windows of WINDOW runs, and
   the kept ones form an inverted index from hash to (template, place). Any stretch of
   K + WINDOW - 1 equal words shares a kept hash.
2. A text's words are looked up in the templates' vocabulary. Runs with a foreign word can't occur
   in a template; they rank last in winnowing, for templates and texts alike.
3. Hits of one template on neighbouring diagonals form a candidate. A local alignment inside the
   band around these diagonals gives the matched words, and their share of the template is its
   coverage; rows at or above the least coverage are reported with their span.

Templates are the constant TEMPLATES, other texts by name, or a table (license, text) of at most
TEMPLATE_BYTES; they go to the workers with the code. The pass is narrow: no shuffle, no state between
documents. Licenses that share most of their words (GPL versions, BSD forms, CC notices) each give a
row; the coverage tells them apart.

Null and empty texts match nothing; null ids stay null; repeated rows each give rows; an empty
table gives an empty result; other columns are ignored. Of overlapping reports of one template the
one with more matched words stays, of equal ones the earlier.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 3
WINDOW = 2
LEAST_COVERAGE = 0.8

#: Characters of a table of templates, at most.
TEMPLATE_BYTES = 8_000_000

WORD = re.compile(r"[^\W_]+")
LAST = np.uint64(0xFFFFFFFFFFFFFFFF)

#: Fixed texts of public license notices.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
    ' associated documentation files (the "Software"), to deal in the Software without restriction, including'
    " without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies"
    " of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
    " conditions: The above copyright notice and this permission notice shall be included in all copies or"
    " substantial portions of the Software.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
    " compliance with the License. You may obtain a copy of the License at"
    " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software"
    ' distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,'
    " either express or implied.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
    " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at"
    " your option) any later version.",
    "gpl-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU"
    " General Public License as published by the Free Software Foundation; either version 2 of the License, or (at"
    " your option) any later version.",
    "lgpl-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU"
    " Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License,"
    " or (at your option) any later version.",
    "lgpl-3.0": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU"
    " Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or"
    " (at your option) any later version.",
    "agpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
    " Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or"
    " (at your option) any later version.",
    "gnu-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without"
    " even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public"
    " License for more details.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the"
    " MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met: Redistributions of source code must retain the above copyright"
    " notice, this list of conditions and the following disclaimer.",
    "bsd-3-clause-full": "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright"
    " notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce"
    " the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or"
    " other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its"
    " contributors may be used to endorse or promote products derived from this software without specific prior"
    " written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS"
    " OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR"
    " A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY"
    " DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,"
    " PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER"
    " CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR"
    " OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
    " hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT'
    " NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO"
    " EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN"
    " ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR"
    " OTHER DEALINGS IN THE SOFTWARE.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy,"
    " modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled"
    " binary, for any purpose, commercial or non-commercial, and by any means.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights"
    " to this work.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International"
    " License.",
    "cc-by-nc-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
}


def words_of(text: str) -> list[str]:
    return WORD.findall(lowered(text))


def winnowed(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the least hash of every window, the rightmost of equal ones; foreign runs never."""
    if not len(hashes):
        return np.empty(0, int)
    window = min(window, len(hashes))
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    least = window - 1 - views[:, ::-1].argmin(axis=1)
    places = np.unique(np.arange(len(views)) + least)
    return places[hashes[places] != LAST]


def align(template: list[int], text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """(matched words, start, stop) of the best local alignment on diagonals low to high.

    Equal words count 2, other pairs and skipped words -1. A row of the band is one array of cells; a
    cell is a number that orders by score, then matched words, then the earlier start.
    """
    text = np.asarray(text, np.int64)
    lanes = np.arange(high - low + 1, dtype=np.int64)
    start_bits = (len(template) + len(lanes)).bit_length()
    matched_bits = len(template).bit_length()
    point, word = np.int64(1) << (start_bits + matched_bits), np.int64(1) << start_bits
    latest = word - 1
    padded = np.full(len(template) + len(lanes), -2)  # text[low], text[low + 1], ...; -2 is no word at all
    first, last = max(low, 0), min(low + len(padded), len(text))
    if first < last:
        padded[first - low : last - low] = text[first:last]
    slope = lanes * point
    best, best_stop = np.int64(0), 0
    row = np.zeros(len(lanes), np.int64)
    for i, wanted in enumerate(template):
        cells = np.where(row == 0, latest - i - lanes, row)  # an alignment that begins here
        cells += np.where(padded[i : i + len(lanes)] == wanted, 2 * point + word, -point)
        np.maximum(cells[:-1], row[1:] - point, out=cells[:-1])
        row = np.maximum.accumulate(cells + slope) - slope
        row[row < point] = 0
        lane = int(row.argmax())
        if row[lane] > best:
            best, best_stop = row[lane], i + low + lane + 1
    if not best:
        return 0, 0, 0
    return int(best >> start_bits & (1 << matched_bits) - 1), low + int(latest - (best & latest)), best_stop


class Index:
    """Vocabulary and winnowed postings of the templates."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        cut = [words_of(t) for t in templates.values()]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for words in cut for w in words}))}
        self.templates = [[self.vocabulary[w] for w in words] for words in cut]
        self.band = [max(3, len(t) // 5) for t in self.templates]
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for number, words in enumerate(self.templates):
            hashes = self.hashes(np.array(words))
            for place in winnowed(hashes):
                self.postings[int(hashes[place])].append((number, int(place)))
        self.known = np.sort(np.array(list(self.postings), np.uint64))

    def hashes(self, ids: np.ndarray) -> np.ndarray:
        """Of K-word runs; LAST for runs with a foreign word (-1)."""
        n = len(ids) - K + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        out, foreign = np.zeros(n, np.uint64), np.zeros(n, bool)
        for i in range(K):
            part = ids[i : i + n]
            foreign |= part < 0
            out = (out + part.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
        out[foreign] = LAST
        return out

    def find(self, text: str) -> list[tuple[str, int, int, int, float]]:
        """(template, start, stop, matched words, coverage) by start."""
        lookup = self.vocabulary.get
        ids = np.array([lookup(w, -1) for w in words_of(text)], np.int64)
        hashes = self.hashes(ids)
        places = winnowed(hashes)
        places = places[np.isin(hashes[places], self.known)]
        if not len(places):
            return []
        diagonals: dict[int, list[int]] = defaultdict(list)
        for place in places.tolist():
            for number, at in self.postings[int(hashes[place])]:
                diagonals[number].append(place - at)
        offsets = None
        rows = []
        for number, found in diagonals.items():
            template, band = self.templates[number], self.band[number]
            kept: list[tuple[int, int, int]] = []
            results = []
            for low, high in stretches(sorted(set(found)), band):
                matched, start, stop = align(template, ids, low - band, high + band)
                if matched >= LEAST_COVERAGE * len(template):
                    results.append((matched, start, stop))
            for matched, start, stop in sorted(results, key=lambda r: (-r[0], r[1])):
                if all(stop <= a or b <= start for _, a, b in kept):
                    kept.append((matched, start, stop))
            if kept and offsets is None:
                offsets = [m.span() for m in WORD.finditer(lowered(text))]
            rows += [
                (self.names[number], offsets[a][0], offsets[b - 1][1], m, round(m / len(template), 6)) for m, a, b in kept
            ]
        return sorted(rows, key=lambda r: (r[1], r[0]))


def lowered(text: str) -> str:
    """text.lower() with one character for each of text, so that offsets hold."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c.lower()[0] for c in text)


def stretches(diagonals: list[int], band: int) -> list[tuple[int, int]]:
    """Runs of sorted diagonals whose neighbours are at most band apart, each at most 4 bands wide.

    Wider runs are cut; each part is aligned with a band more on either side, which holds every alignment
    that drifts by a band or less, and its cost doesn't grow with the text.
    """
    runs = [[diagonals[0], diagonals[0]]]
    for d in diagonals[1:]:
        if d - runs[-1][1] <= band and d - runs[-1][0] <= 4 * band:
            runs[-1][1] = d
        else:
            runs.append([d, d])
    return [(a, b) for a, b in runs]


def listed_templates(templates: DataFrame) -> dict[str, str]:
    """The texts of a table (license, text) by name, which must be unique; null and empty texts are left out."""
    rows = templates.select("license", F.col("text").cast("string").alias("text")).filter("license IS NOT NULL AND text <> ''")
    size, n, names = rows.agg(F.sum(F.length("text")), F.count("*"), F.count_distinct("license")).first()
    if (size or 0) > TEMPLATE_BYTES:
        raise ValueError(f"templates of {size} characters; at most {TEMPLATE_BYTES} go to the workers")
    if n != names:
        raise ValueError("a license name stands twice in the table of templates")
    return dict(rows.sort("license").collect())


def find_licenses(
    docs: DataFrame, templates: dict[str, str] | DataFrame = TEMPLATES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, license, start, stop (code points), matched words and coverage."""
    if isinstance(templates, DataFrame):
        templates = listed_templates(templates)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc_id", "license", "start", "stop", "matched", "coverage"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]

    def run(batches):
        index = Index(templates)
        for batch in batches:
            rows = [
                (doc_id, *row)
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))
                for row in index.find(text.as_py())
            ]
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = "doc_id long, license string, start long, stop long, matched long, coverage double"
    return source.filter("text <> ''").mapInArrow(run, schema)
