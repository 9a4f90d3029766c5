"""License scans: an inverted index of template words, an exact count filter, then banded sequence alignment.

Template notices are read as words (lower-cased, parted by white space and ASCII punctuation), and an inverted index
lists which template has which word where. An alignment within the band spans at most the template's words and twice
the band more of the document, and what it matches are template words; so only texts with a window of that size that
holds enough words of a template can have its notice. There every diagonal is a candidate whose band meets enough
different places of the template. On each of them the template is aligned to the document's words within the band
(match 2, mismatch and gap -1, free ends), and the alignment's matched words give coverage, and its ends the span.
Both filters are necessary conditions, so the result is that of aligning every template on every diagonal.

The index grows with the templates only, never with the corpus, so it goes out with the task.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.arrow import WORD_BYTES, Words, slices

#: Wording of common public license notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "mit": "Released under the MIT License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
        law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    "gpl-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
        to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software.""",
    "bsd-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution.""",
    "mpl-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}


def words_of(text: str) -> list[str]:
    batch = pa.RecordBatch.from_arrays([pa.array([text], pa.string())], ["text"])
    words = Words(batch, lower=True, punctuation=True)
    return [words.word(i).decode() for i in range(len(words.starts))]


def align(doc: list[str], template: list[str], diagonal: int, band: int) -> tuple[int, int, int]:
    """Best local alignment with |place in doc - place in template - diagonal| <= band: (matched words, from, to)."""
    n, m = len(doc), len(template)
    width = 2 * band + 1
    score = np.zeros((m + 1, width), np.int32)
    came = np.zeros((m + 1, width), np.int8)  # 1 both, 2 template word skipped, 3 document word skipped
    best, at = 0, None
    for j in range(1, m + 1):
        for b in range(width):
            i = j - 1 + diagonal + b - band  # the document word that meets template word j - 1
            if not 0 <= i < n:
                continue
            s, c = score[j - 1, b] + (2 if doc[i] == template[j - 1] else -1), 1
            if b + 1 < width and score[j - 1, b + 1] - 1 > s:
                s, c = score[j - 1, b + 1] - 1, 2
            if b and score[j, b - 1] - 1 > s:
                s, c = score[j, b - 1] - 1, 3
            if s > 0:
                score[j, b], came[j, b] = s, c
                if s > best:
                    best, at = int(s), (j, b)
    if at is None:
        return 0, 0, 0
    j, b = at
    matched, last, first = 0, j - 1 + diagonal + b - band + 1, None
    while j > 0 and score[j, b] > 0:
        i = j - 1 + diagonal + b - band
        c = came[j, b]
        if c == 1:
            if doc[i] == template[j - 1]:
                matched += 1
            first = i
            j -= 1
        elif c == 2:
            j, b = j - 1, b + 1
        else:
            b -= 1
    return matched, first if first is not None else 0, last


def disjoint(found: list[tuple[str, float, int, int, int]]) -> list[tuple[str, float, int, int, int]]:
    """Where notices overlap the one with more matched words, then more coverage, stays."""
    kept: list[tuple[int, tuple[str, float, int, int, int]]] = []  # by first word; they never overlap
    for r in sorted(set(found), key=lambda r: (-r[2], -r[1], r[3], r[4], r[0])):
        at = bisect.bisect_left(kept, (r[3],))
        if (at == 0 or kept[at - 1][1][4] <= r[3]) and (at == len(kept) or kept[at][0] >= r[4]):
            kept.insert(at, (r[3], r))
    return [r for _, r in kept]


class Index:
    """Word -> (template, place) of the templates' words."""

    def __init__(self, templates: dict[str, str], band: int, least: float):
        self.names, self.band = list(templates), band
        self.words, hashes = [], []
        for text in templates.values():
            words = Words(pa.RecordBatch.from_arrays([pa.array([text], pa.string())], ["text"]), lower=True, punctuation=True)
            self.words.append([words.word(i).decode() for i in range(len(words.starts))])
            hashes.append(words.hashes())
        # the least matched words, by the very test that decides
        self.need = [next((n for n in range(1, len(w) + 1) if n >= least * len(w)), len(w) + 1) for w in self.words]
        self.keys, code = np.unique(np.concatenate([*hashes, np.empty(0, np.uint64)]), return_inverse=True)
        #: for each template its words' numbers among the keys, and which numbers it has (the last stands for other words)
        self.codes = np.split(code, np.cumsum([len(h) for h in hashes])[:-1]) if hashes else []
        self.has = np.zeros((len(self.words), len(self.keys) + 1), bool)
        for t, c in enumerate(self.codes):
            self.has[t, c] = True

    def code(self, h: np.ndarray) -> np.ndarray:
        """The number of each word, that of other words for those in no template."""
        if not len(self.keys):
            return np.zeros(len(h), np.int32)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, at, len(self.keys)).astype(np.int32)

    def dense(self, t: int, code: np.ndarray) -> np.ndarray:
        """Places where a window begins that holds enough words of template t."""
        sums = np.zeros(len(code) + 1, np.int32)
        np.cumsum(self.has[t][code], out=sums[1:])
        span = len(self.words[t]) + 2 * self.band
        return np.flatnonzero(sums[np.minimum(np.arange(len(code)) + span, len(code))] - sums[:-1] >= self.need[t])

    def diagonals(self, t: int, code: np.ndarray) -> np.ndarray:
        """Diagonals whose band meets enough different places of template t."""
        m, band = len(self.words[t]), self.band
        mark = np.zeros(len(code) + 1, np.int32)
        starts = self.dense(t, code)
        np.add.at(mark, starts, 1)
        np.add.at(mark, np.minimum(starts + m + 2 * band, len(code)), -1)
        i = np.flatnonzero((np.cumsum(mark[:-1]) > 0) & self.has[t][code])
        a, j = np.nonzero(code[i][:, None] == self.codes[t][None, :])
        if not len(a):
            return np.empty(0, np.int64)
        d = (i[a] - j)[:, None] + np.arange(-band, band + 1)[None, :]
        met = np.unique((d + m + band) * m + j[:, None])
        found, n = np.unique(met // m, return_counts=True)
        return found[n >= self.need[t]] - m - band

    def scan(self, words: list[str], code: np.ndarray, which: list[int]) -> list[tuple[str, float, int, int, int]]:
        """(template, coverage, matched, from word, to word) of each notice of the templates ``which``."""
        found = []
        for t in which:
            template = self.words[t]
            for d in self.diagonals(t, code).tolist():
                matched, first, end = align(words, template, d, self.band)
                if matched >= self.need[t]:
                    found.append((self.names[t], matched / len(template), matched, first, end))
        return disjoint(found)


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, band: int = 4, least: float = 0.8) -> DataFrame:
    """One row per notice found: doc_id, license, coverage (matched / template words), matched, start_word, end_word.

    Words are numbered over the whole text from 0; end_word is exclusive. Notices that cover at least ``least`` of a
    template are reported; where two overlap the one with more matched words stays. Null and empty texts, and texts
    without a notice, have no rows; null ids stay null; repeated rows are each scanned; an empty table gives no rows;
    other columns are not read. Templates without words are never found.
    """
    index = Index(TEMPLATES if templates is None else templates, band, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=WORD_BYTES):
            rows: list[tuple] = []
            words = Words(batch, lower=True, punctuation=True)
            code = index.code(words.hashes())
            # texts that may hold a template's notice; a window may run into the next text, which only adds a candidate
            which: dict[int, list[int]] = {}
            for t in range(len(index.names)):
                for r in np.unique(np.searchsorted(words.first, index.dense(t, code), "right") - 1).tolist():
                    which.setdefault(r, []).append(t)
            for r in sorted(which):
                a, b = words.first[r], words.first[r + 1]
                rows += [(batch.column(0)[r].as_py(), *x) for x in index.scan([words.word(i).decode(errors="replace") for i in range(a, b)], code[a:b], which[r])]
            cols = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "license", "coverage", "matched", "start_word", "end_word"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, license string, coverage double, matched int, start_word int, end_word int")
