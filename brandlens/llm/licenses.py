"""License scans by patience alignment.

A text and a template are aligned on words that occur once in both: the longest increasing
subsequence of their places gives anchors, and each gap between anchors is aligned in the same
way, down to gaps without such words, where equal words at either end are matched. The chain of
matched words is cut where the text leaves a long gap; a piece that matches enough of the template
is a find, and its share of the template's words is the coverage.

A licence may stand in a text several times. The template's words are parted at long gaps before
they are aligned. Where they repeat without such a gap, the stretch around each place of a repeated
word, up to its next places on both sides, is aligned as well: there the word is an anchor. Of
finds that overlap, the one that matches most stays; what lies between finds is searched again.

Only words of a template can match, so a text is reduced to those first, and a template is skipped
if the words it shares with the text cannot reach the least coverage. Both are exact.

Words are runs of letters, digits, - and . inside, in lower case.

Cases: null, empty and very long texts are scanned whole; a text may have several licences and
one several times, one row each; a text without one has no row; repeated rows are found each; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import text_column

_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
_FOUND = "doc_id long, license string, coverage double, n_matched long, n_template long, first_word long, last_word long"

# Sentences of public licences and the usual notices that name them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "MIT": "Released under the MIT License.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "BSD text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."),
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means."),
    "Zlib text": (
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
}


def increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence."""
    tops: list[int] = []
    piles: list[int] = []
    before: list[int] = []
    for at, value in enumerate(values):
        pile = bisect_left(tops, value)
        before.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(value)
            piles.append(at)
        else:
            tops[pile], piles[pile] = value, at
    chain, at = [], piles[-1] if piles else -1
    while at >= 0:
        chain.append(at)
        at = before[at]
    return chain[::-1]


def align(text: list[int], template: list[int]) -> list[tuple[int, int]]:
    """Pairs of places with equal words, rising in both lists."""
    pairs, todo = [], [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a >= b or c >= d:
            continue
        once = {w for w, n in Counter(template[c:d]).items() if n == 1}
        seen = Counter(w for w in text[a:b] if w in once)
        place = {w: i for i, w in enumerate(template[c:d], start=c) if seen.get(w) == 1}
        both = [(i, place[w]) for i, w in enumerate(text[a:b], start=a) if w in place]
        anchors = [both[k] for k in increasing([j for _, j in both])]
        pairs += anchors
        if anchors:
            ends = [(a - 1, c - 1), *anchors, (b, d)]
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:])]
    return sorted(pairs)


class Scanner:
    def __init__(self, templates: dict[str, str], least: float, most_gap: int) -> None:
        self.least, self.most_gap = least, most_gap
        self.code: dict[str, int] = {}
        self.templates = {name: [self.code.setdefault(w, len(self.code)) for w in _WORD.findall(text.lower())] for name, text in templates.items()}
        self.needs = {name: Counter(words) for name, words in self.templates.items()}

    def pieces(self, mine: list[tuple[int, int]], template: list[int], low: int, high: int) -> list[list[int]]:
        """Finds of one alignment, as indexes into mine (place and word)."""
        at = [low + i for i, _ in align([w for _, w in mine[low:high]], template)]
        cuts = [k for k in range(1, len(at)) if mine[at[k]][0] - mine[at[k - 1]][0] > self.most_gap]
        return [at[a:b] for a, b in zip([0, *cuts], [*cuts, len(at)]) if b - a >= self.least * len(template)]

    def finds(self, mine: list[tuple[int, int]], template: list[int]) -> list[list[int]]:
        """The places of the matched words of each occurrence, in the order of the text."""
        needs = Counter(template)
        cuts = [k for k in range(1, len(mine)) if mine[k][0] - mine[k - 1][0] > self.most_gap]
        out, todo = [], list(zip([0, *cuts], [*cuts, len(mine)]))
        while todo:
            low, high = todo.pop()
            where: dict[int, list[int]] = {}
            for i in range(low, high):
                where.setdefault(mine[i][1], []).append(i)
            if sum(min(n, len(where.get(w, ()))) for w, n in needs.items()) < self.least * len(template):
                continue
            found = self.pieces(mine, template, low, high)
            again = sorted((len(x), w) for w, x in where.items() if len(x) > 1 and needs[w] == 1)
            # An occurrence lacks fewer of the template's words than are tried.
            for _, w in again[:int((1 - self.least) * len(template)) + 1]:
                ends = [low - 1, *where[w], high]
                for before, after in zip(ends, ends[2:]):
                    found += self.pieces(mine, template, before + 1, after)
            taken: list[list[int]] = []
            for piece in sorted(found, key=lambda x: (-len(x), x[-1] - x[0], x[0])):
                k = bisect_left(taken, piece)
                if (not k or taken[k - 1][-1] < piece[0]) and (k == len(taken) or piece[-1] < taken[k][0]):
                    taken.insert(k, piece)
            out += taken
            if taken:
                edges = [low - 1, *(e for x in taken for e in (x[0], x[-1])), high]
                todo += [(a + 1, b) for a, b in zip(edges[::2], edges[1::2])]
        return [[mine[i][0] for i in piece] for piece in sorted(out)]

    def scan(self, text: str) -> list[tuple[str, float, int, int, int, int]]:
        """Licence, coverage, matched words, template words, first and last word of each find."""
        code = self.code
        places, words = [], []
        for place, word in enumerate(_WORD.findall(text.lower())):
            if word in code:
                places.append(place)
                words.append(code[word])
        held, out = Counter(words), []
        for name, template in self.templates.items():
            if sum(min(n, held[w]) for w, n in self.needs[name].items()) < self.least * len(template):
                continue
            own = self.needs[name]
            mine = [(p, w) for p, w in zip(places, words) if w in own]
            for hit in self.finds(mine, template):
                out.append((name, len(hit) / len(template), len(hit), len(template), hit[0], hit[-1]))
        return out


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = 0.8, most_gap: int = 12) -> DataFrame:
    """One row for each licence found in each document (doc_id, text)."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least, most_gap)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            rows = [(doc, *hit) for doc, text in zip(ids, text_column(batch)) for hit in scanner.scan(text)]
            kinds = [pa.int64(), pa.string(), pa.float64(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 7, kinds)],
                                             names=[f.split()[0] for f in _FOUND.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(find, _FOUND)
