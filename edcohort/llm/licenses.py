"""Operator 7: license scans by patience alignment.

A template is aligned with a text like two versions of a file: words unique to both are anchors,
the longest increasing subsequence of their positions is kept, and the gaps between kept anchors
are aligned the same way.  A gap without anchors matches equal words at its two ends.  Coverage
is the share of template words that are matched.

A text is aligned only with templates that it can cover: to match ``t`` of m words it must hold all
but (m - ceil(t m)) of the template's distinct words, which a hash set of the template words
decides for all texts of a batch at once.  This filter is exact; no text or template is cut.
Gaps before the first and after the last anchor reach ``SLACK`` words plus twice the template's
rest into the text, so that a match is one passage and not words from all over a document.
A notice that stands several times is aligned in a window around each place (``best_passage``).
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T

SLACK = 8

# Public license notices and texts.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    "bsd-2-clause-conditions": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    "cc-by-4.0-short": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-short": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0-short": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies.""",
    "mit-short": "Released under the MIT License.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
        shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY
        OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
        LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR
        THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "mpl-2.0-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}
WORD = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+(?:\.[0-9]+)*")
_INSIDE = np.array([chr(b).isalnum() and b < 128 or b >= 128 for b in range(256)])
_RAW = T.mix(np.arange(701, 957, dtype=np.uint64))
_RAW[65:91] = _RAW[97:123]


def words_of(text: str) -> list[str]:
    """Lower-case words, runs of letters and digits; a version number is one word."""
    return [w.lower() for w in WORD.findall(text)]


def increasing(positions: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence (patience sorting)."""
    tops, piles, back = [], [], []
    for i, p in enumerate(positions):
        at = bisect_left(tops, p)
        if at == len(tops):
            tops.append(p)
            piles.append(i)
        else:
            tops[at], piles[at] = p, i
        back.append(piles[at - 1] if at else -1)
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched (text position, template position) pairs, increasing in both."""
    return align_ranges(text, template, [(0, len(text), 0, len(template), True, True)])


def align_ranges(text: list[str], template: list[str], todo: list[tuple]) -> list[tuple[int, int]]:
    """``align`` within ranges (text from, to, template from, to, open to the left, to the right)."""
    matched = []
    while todo:
        a, b, c, d, open_left, open_right = todo.pop()
        if a >= b or c >= d:
            continue
        where: dict[str, int] = {}
        for k in range(c, d):
            where[template[k]] = -1 if template[k] in where else k
        seen: dict[str, int] = {}
        for k in range(a, b):
            if text[k] in where:
                seen[text[k]] = -1 if text[k] in seen else k
        anchors = sorted((k, where[w]) for w, k in seen.items() if k >= 0 and where[w] >= 0)
        if anchors:
            anchors = [anchors[k] for k in increasing([t for _, t in anchors])]
            matched += anchors
            edges = [(a - 1, c - 1), *anchors, (b, d)]
            for n, ((p, q), (r, s)) in enumerate(zip(edges, edges[1:], strict=False)):
                lo, hi, reach = p + 1, r, SLACK + 2 * (s - q - 1)
                if n == 0 and open_left:
                    lo = max(lo, hi - reach)
                if n == len(edges) - 2 and open_right:
                    hi = min(hi, lo + reach)
                todo.append((lo, hi, q + 1, s, n == 0 and open_left, n == len(edges) - 2 and open_right))
            continue
        if not open_left:  # equal words right after the anchor before
            while a < b and c < d and text[a] == template[c]:
                matched.append((a, c))
                a, c = a + 1, c + 1
        if not open_right:  # and right before the anchor behind
            while a < b and c < d and text[b - 1] == template[d - 1]:
                b, d = b - 1, d - 1
                matched.append((b, d))
    return sorted(matched)


def best_passage(text: list[str], template: list[str], missing: int) -> list[tuple[int, int]]:
    """The alignment that matches most, then over the shortest span, then first: of the whole text, or of a
    window around one place of the text.

    A notice that stands twice has no unique words.  A passage that lacks at most ``missing`` template words
    matches one of any ``missing`` + 1 of them, so each occurrence of as many of the rarest is an anchor
    once; its window ends at the neighbouring occurrences, so that it holds one copy of the word."""
    best = align(text, template)
    if len(best) == len(template):
        return best
    places: dict[str, list[int]] = {w: [] for w in template}
    for k, w in enumerate(text):
        if w in places:
            places[w].append(k)
    end = len(template)

    def rank(pairs):
        return (len(pairs), pairs[0][0] - pairs[-1][0], -pairs[0][0]) if pairs else (0, 0, 0)

    for q in sorted(range(end), key=lambda q: (len(places[template[q]]), q))[:missing + 1]:
        found = places[template[q]]
        once = template.count(template[q]) == 1
        for i, p in enumerate(found):
            lo = found[i - 1] + 1 if once and i else 0
            hi = found[i + 1] if once and i + 1 < len(found) else len(text)
            for slack, times in ((0, 1), (SLACK, 2)):
                left, right = max(lo, p - slack - times * q), min(hi, p + 1 + slack + times * (end - q - 1))
                pairs = align_ranges(text, template, [(left, p, 0, q, True, False), (p + 1, right, q + 1, end, False, True)])
                best = max(best, sorted([*pairs, (p, q)]), key=rank)
                if len(best) == end:
                    return best
    return best


class Scanner:
    def __init__(self, templates: dict[str, str], min_percent: int):
        self.min_percent = min_percent
        self.templates = [(name, words_of(text)) for name, text in sorted(templates.items())]
        self.templates = [(name, words) for name, words in self.templates if words]
        vocabulary = sorted({p for _, words in self.templates for w in words for p in w.split(".")})
        hashes = np.array([int(_hashes(w.encode())[1][0]) for w in vocabulary], np.uint64)
        self.order = np.argsort(hashes)
        self.known = hashes[self.order]
        at = {w: k for k, w in enumerate(vocabulary)}
        self.has = np.zeros((len(self.templates), len(vocabulary)), np.int32)
        self.least = np.zeros(len(self.templates), np.int64)
        for k, (_, words) in enumerate(self.templates):
            parts = {at[p] for w in words for p in w.split(".")}
            self.has[k, list(parts)] = 1
            missing = len(words) - -(-min_percent * len(words) // 100)
            lost = sorted((len(set(w.split("."))) for w in set(words)), reverse=True)[:missing]
            self.least[k] = len(parts) - sum(lost)

    def candidates(self, texts: pa.Array) -> np.ndarray:
        """(texts x templates) which texts hold enough of the template's words."""
        held = np.zeros((len(texts), self.has.shape[1]), bool)
        for i, _, raw, bounds in T.byte_blocks(texts):
            s, h = _hashes(raw, bounds)
            at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
            hit = self.known[at] == h
            doc = i + np.searchsorted(bounds, s[hit], side="right") - 1
            held[doc, self.order[at[hit]]] = True
        return held.astype(np.int32) @ self.has.T >= self.least

    def scan(self, text: str, wanted) -> list[tuple]:
        """(template, coverage, matched, first word, last word) of the covered templates among ``wanted``,
        best first: by coverage, then length, then name."""
        words = words_of(text)
        out = []
        for k in wanted:
            name, template = self.templates[k]
            pairs = best_passage(words, template, len(template) - -(-self.min_percent * len(template) // 100))
            if pairs and 100 * len(pairs) >= self.min_percent * len(template):
                out.append((name, len(pairs) / len(template), len(pairs), pairs[0][0], pairs[-1][0], len(template)))
        return sorted(out, key=lambda r: (-r[1], -r[5], r[0]))


def _hashes(raw, bounds=None):
    raw = np.frombuffer(raw, np.uint8) if isinstance(raw, bytes) else raw
    s, _, h, _ = T.run_hashes(raw, np.array([0, len(raw)]) if bounds is None else bounds, _INSIDE, _RAW, 1)
    return s, h


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, *, id_col: str = "doc_id", text_col: str = "text",
                  min_percent: int = 80) -> DataFrame:
    """(doc_id, license, coverage, n_matched, first_word, last_word, licenses) for each row of ``docs``: the
    best covered template (greatest coverage, then longest, then by name) with the word span of its match,
    and the names of all covered templates in that order.

    Null and empty texts, and texts that cover no template, have a null license, coverage 0 and no
    names.  Templates without words are ignored.  Repeated rows give repeated results."""
    templates = TEMPLATES if templates is None else templates

    def run(batches):
        scanner = Scanner(templates, min_percent)
        for b in T.tidied(batches):
            texts = b.column("text")
            fits = scanner.candidates(texts) if scanner.templates else np.zeros((len(texts), 0), bool)
            found = [scanner.scan(texts[k].as_py(), np.flatnonzero(row)) if row.any() and texts[k].is_valid else [] for k, row in enumerate(fits)]
            best = [f[0][:5] if f else (None, 0.0, 0, None, None) for f in found]
            cols = list(zip(*best, strict=True)) if best else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                 pa.array([[x[0] for x in f] for f in found], pa.list_(pa.string()))],
                names=["doc_id", "license", "coverage", "n_matched", "first_word", "last_word", "licenses"])

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {kind}, license string, coverage double, n_matched long, first_word long, last_word long, licenses array<string>")
