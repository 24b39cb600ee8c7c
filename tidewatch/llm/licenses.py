"""License scans: winnowed fingerprints of templates in an inverted index pick candidates, banded alignment verifies them.

The index is as large as the templates, whatever the corpus, and goes to every task with them. Every word n-gram of a
document is looked up, so a run of words that a template's winnowing guarantees a fingerprint for is never missed.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a fingerprint, and fingerprints of a winnowing window.
GRAM, WINNOW = 5, 4
#: Templates of fewer words than SHORT have a fingerprint at every place, of SHORT_GRAM words: of an occurrence of coverage
#: 0.8 with up to a band of words put in, two words stay together.
SHORT, SHORT_GRAM = 20, 2
#: Words that an alignment may be off its diagonal, at most; share of a template's words that has to be matched.
BAND, MIN_COVERAGE = 12, 0.8

# Public license notices, as their publishers word them.
TEMPLATES: dict[str, str] = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
        "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain '
        "a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See '
        "the License for the specific language governing permissions and limitations under the License."
    ),
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that "
        "it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies."
    ),
}

#: Words: ASCII letters and digits and all characters beyond ASCII.
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")
_WORD_BYTES = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_WORD_BYTES).split()


def winnow(codes: list[int], window: int = WINNOW) -> list[int]:
    """Positions of the fingerprints: of every ``window`` consecutive codes the one of least hash, the last of equal ones."""
    hashes = [(c * 0x9E3779B97F4A7C15 ^ c >> 7) & 0xFFFFFFFFFFFF for c in codes]
    if len(codes) <= window:
        return [min(range(len(codes)), key=lambda i: (hashes[i], -i))] if codes else []
    return sorted({min(range(s, s + window), key=lambda i: (hashes[i], -i)) for s in range(len(codes) - window + 1)})


def align(template: list[int], text: list[int], offset: int, band: int = BAND) -> tuple[int, int, int]:
    """Best alignment of all of ``template`` near the diagonal that starts at ``offset`` of ``text``: matched words, first and last matched position.

    Words match or don't; skipped words on either side cost nothing but what they could have matched. Of equally many
    matches the alignment of the shortest span, then of the earliest end, is taken. Cells are (matches, start).
    """
    best = (0, 0)
    end = -1
    low = offset - band
    width = 2 * band + 1
    nothing = (0, -1)
    row = [nothing] * (width + 1)
    for i, word in enumerate(template):
        # cell j of the row stands for text position low + i + j; the row before is shifted by one
        new = [nothing] * (width + 1)
        for j in range(width):
            p = low + i + j
            cell = row[j + 1] if row[j + 1] > (new[j - 1] if j else nothing) else (new[j - 1] if j else nothing)
            if 0 <= p < len(text) and text[p] == word:
                m, s = row[j]
                got = (m + 1, s if m else p)
                if got > cell:
                    cell = got
                if got[0] > best[0] or (got[0] == best[0] and p - got[1] < end - best[1]):
                    best, end = got, p
            new[j] = cell
        row = new
    return best[0], best[1], end


@dataclass(frozen=True)
class Index:
    """The templates as numbers of their words, and their fingerprints: gram length -> code -> (template, position)."""

    names: tuple[str, ...]
    vocabulary: dict[bytes, int]
    templates: tuple[tuple[int, ...], ...]
    grams: dict[int, dict[int, list[tuple[int, int]]]]

    @classmethod
    def build(cls, templates: dict[str, str] = TEMPLATES, gram: int = GRAM, window: int = WINNOW) -> Index:
        names = tuple(n for n, t in sorted(templates.items()) if words(t))
        split = [words(templates[n]) for n in names]
        vocabulary = {w: i for i, w in enumerate(sorted({w for t in split for w in t}))}
        numbered = tuple(tuple(vocabulary[w] for w in t) for t in split)
        grams: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for k, t in enumerate(numbered):
            n = min(SHORT_GRAM if len(t) < SHORT else gram, len(t))
            codes = [cls.code(t[i : i + n], len(vocabulary)) for i in range(len(t) - n + 1)]
            for i in range(len(codes)) if len(t) < SHORT else winnow(codes, window):
                grams.setdefault(n, {}).setdefault(codes[i], []).append((k, i))
        return cls(names, vocabulary, numbered, grams)

    def band(self, template: int, most: int) -> int:
        """A quarter of the template at most, so that two occurrences never share a band."""
        return min(most, max(1, len(self.templates[template]) // 4))

    @staticmethod
    def code(numbers: Iterable[int], base: int) -> int:
        out = 0
        for x in numbers:
            out = (out * base + x) % (1 << 62)
        return out

    def candidates(self, numbers: np.ndarray) -> list[tuple[int, int]]:
        """(template, text position of its first word) for every fingerprint met; -1 stands for words of no template."""
        out = []
        for n, table in self.grams.items():
            size = len(numbers) - n + 1
            if size <= 0:
                continue
            known = np.flatnonzero(np.convolve(numbers >= 0, np.ones(n, dtype=np.int64), "valid") == n)
            if not len(known):
                continue
            code = np.zeros(len(known), dtype=np.int64)
            for i in range(n):
                code = (code * len(self.vocabulary) + numbers[known + i]) % (1 << 62) if n * len(self.vocabulary).bit_length() >= 62 else code * len(self.vocabulary) + numbers[known + i]
            for p, c in zip(known.tolist(), code.tolist(), strict=True):
                out += [(k, p - i) for k, i in table.get(c, ())]
        return out

    def find(self, text: str | None, min_coverage: float = MIN_COVERAGE, band: int = BAND) -> list[tuple[str, int, int, float, int, int]]:
        """(license, matched words, template words, coverage, start, end) of every occurrence; spans in code points, end exclusive.

        Candidates of one template within the band are one occurrence; of a short template each is aligned, and of those
        that overlap the best stays. Occurrences come in the order of start, then name.
        """
        get = self.vocabulary.get
        numbers = np.array([get(w, -1) for w in words(text)], dtype=np.int64)
        if (numbers >= 0).sum() < 3 and not any(len(t) < 3 for t in self.templates):
            return []
        near: list[tuple[int, int]] = []
        for k, p in sorted(set(self.candidates(numbers))):
            if len(self.templates[k]) >= SHORT and near and near[-1][0] == k and p - near[-1][1] <= self.band(k, band):
                continue
            near.append((k, p))
        if not near:
            return []
        listed = numbers.tolist()
        places = None
        found = []
        aligned: list[tuple[int, int, int, int]] = []
        for k, p in near:
            t = self.templates[k]
            width = self.band(k, band)
            if len(t) < SHORT:
                around = set(listed[max(0, p - width) : max(0, p + len(t) + width)])
                if sum(w in around for w in t) < min_coverage * len(t):
                    continue
            matched, first, last = align(list(t), listed, p, width)
            if matched >= min_coverage * len(t):
                aligned.append((k, matched, first, last))
        taken: dict[int, list[tuple[int, int]]] = {}
        for k, matched, first, last in sorted(aligned, key=lambda a: (a[0], -a[1], a[3] - a[2], a[2])):
            t = self.templates[k]
            if len(t) < SHORT:
                spans = taken.setdefault(k, [])
                if any(first <= e and s <= last for s, e in spans):
                    continue
                spans.append((first, last))
            places = places or [m.span() for m in _WORD.finditer(text or "")]
            found.append((self.names[k], matched, len(t), matched / len(t), places[first][0], places[last][1]))
        return sorted(set(found), key=lambda f: (f[4], f[0], f[5]))


_SCHEMA = "doc_id long, license string, matched_words int, template_words int, coverage double, start int, end int"


def _scanned(index: Index, min_coverage: float, band: int):
    def run(batches):
        for batch in batches:
            rows = [(i, *f) for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for f in index.find(t.as_py(), min_coverage, band)]
            if rows:
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32())
                names = ["doc_id", "license", "matched_words", "template_words", "coverage", "start", "end"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, min_coverage: float = MIN_COVERAGE, band: int = BAND, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for every license occurrence in ``docs``: doc_id, license, matched_words, template_words, coverage, start, end.

    A document without one, a null or an empty text gives no row; rows that repeat an id are scanned each; null ids stay
    null. Of an occurrence with edits, one fingerprint of the template has to be whole; templates of fewer than SHORT words
    always keep one at a coverage of 0.8. An empty table gives an empty result. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scanned(Index.build(templates), min_coverage, band), _SCHEMA)
