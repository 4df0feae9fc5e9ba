"""License scan: winnowed fingerprints of templates pick candidates, banded alignment measures them."""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.decontaminate import words_of

# Widest band; a quarter of the template's words if that is less.
BAND = 8
# Matched share of a template's words from which it is reported.
COVERAGE = 0.8
# Broadcast bound of the templates, in words.
TEMPLATE_WORDS = 1_000_000
KNOWN_WORDS = 400_000

# Well-known license notices.
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License."
    ),
    "MIT line": "Released under the MIT License.",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software."
    ),
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version."
    ),
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 line": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License."
    ),
    "BSD clauses": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:"
    ),
    "ISC permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies."
    ),
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def align(template: np.ndarray, words: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """(matched words, start, end) of the best local alignment near a diagonal.

    Word i of the template may meet words i + diagonal - band to i + diagonal + band
    of the text. A match counts 2, a gap or another word -1.
    """
    width = 2 * band + 1
    shift = np.arange(width)
    scores = np.zeros((len(template) + 1, width), dtype=np.int64)
    same = np.zeros((len(template) + 1, width), dtype=bool)
    for row in range(1, len(template) + 1):
        place = row - 1 + diagonal - band + shift
        inside = (place >= 0) & (place < len(words))
        same[row, inside] = words[place[inside]] == template[row - 1]
        above = np.append(scores[row - 1, 1:], 0) - 1
        best = np.maximum(scores[row - 1] + np.where(same[row], 2, -1), above)
        best = np.maximum(np.where(inside, best, 0), 0)
        scores[row] = np.maximum.accumulate(best + shift) - shift
        scores[row, ~inside] = 0
    row, column = (int(x) for x in np.unravel_index(scores.argmax(), scores.shape))
    matched, end, start = 0, row + diagonal - band + column, 0
    start = end
    while row and scores[row, column] > 0:
        here = scores[row, column]
        if here == scores[row - 1, column] + (2 if same[row, column] else -1):
            matched += int(same[row, column])
            start = row - 1 + diagonal - band + column
            row -= 1
        elif column + 1 < width and here == scores[row - 1, column + 1] - 1:
            row, column = row - 1, column + 1
        else:
            column -= 1
    return matched, start, end


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words."""
    count = max(0, len(words) - size + 1)
    hashes = np.zeros(count, dtype=np.uint64)
    for place in range(size):
        hashes = (hashes ^ words[place : place + count]) * np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(29)
    return hashes


def winnowed(hashes: np.ndarray, window: int) -> np.ndarray:
    """The smallest hash of every ``window`` consecutive ones, each once."""
    return np.unique(np.lib.stride_tricks.sliding_window_view(hashes, window).min(axis=1))


def shared_run(length: int, need: int, band: int) -> int:
    """Words in a row that a passage shares with a template if it matches ``need`` of its words.

    It leaves out length - need words at most. Words put in between shift the diagonal, and
    only words left out shift it back, so with a band to either side there are at most
    length - need + 2 * band places with some. All these places cut the matched words into
    one run more than there are of them, and one run has at least its share.
    """
    breaks = 2 * (length - need) + 2 * band
    return math.ceil(need / (breaks + 1))


class TemplateIndex:
    """Winnowed fingerprints of the templates, inverted, and what a passage needs of their words.

    The grams and windows of a template are so short that any run of ``shared_run`` words has one of
    its fingerprints: no passage that reaches ``coverage`` is without.
    """

    def __init__(self, templates: Sequence[tuple[str, str]], coverage: float = COVERAGE):
        self.names = [name for name, _ in templates]
        self.known: dict[bytes, int] = {}
        texts = [words_of(text.encode()) for _, text in templates]
        self.words = [self.hashed(text) for text in texts]
        self.need = [max(1, math.ceil(coverage * len(text))) for text in texts]
        self.keys = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.words]))
        self.order = [np.argsort(words, kind="stable") for words in self.words]
        self.terms = [np.searchsorted(self.keys, words) for words in self.words]
        owners: defaultdict[int, defaultdict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for number, words in enumerate(self.words):
            run = shared_run(len(words), self.need[number], self.band(number))
            size = (run + 1) // 2
            for gram in winnowed(gram_hashes(words, size), run - size + 1).tolist():
                owners[size][gram].add(number)
        self.prints = {
            size: (np.array(sorted(grams), dtype=np.uint64), [grams[gram] for gram in sorted(grams)])
            for size, grams in owners.items()
        }

    def band(self, number: int) -> int:
        return max(1, min(BAND, len(self.words[number]) // 4))

    def hashed(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        known = self.known
        for word in set(words).difference(known):
            known[word] = zlib.crc32(word) | zlib.adler32(word) << 32
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def candidates(self, words: np.ndarray) -> list[int]:
        """The templates with a fingerprint in the text of which it has enough words, wherever they are."""
        numbers: set[int] = set()
        for size, (prints, owners) in self.prints.items():
            grams = gram_hashes(words, size)
            place = np.minimum(np.searchsorted(prints, grams), len(prints) - 1)
            for found in np.unique(place[prints[place] == grams]).tolist():
                numbers |= owners[found]
        if not numbers:
            return []
        place = np.minimum(np.searchsorted(self.keys, words), len(self.keys) - 1)
        present = np.zeros(len(self.keys), dtype=bool)
        present[place[self.keys[place] == words]] = True
        return sorted(n for n in numbers if present[self.terms[n]].sum() >= self.need[n])

    def hits(self, number: int, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(template position, text position) of all equal words, by template position."""
        order = self.order[number]
        values = self.words[number][order]
        first = np.searchsorted(values, words, "left")
        many = np.searchsorted(values, words, "right") - first
        at = np.repeat(np.arange(len(words)), many)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        position = order[np.repeat(first, many) + nth]
        by_position = np.argsort(position, kind="stable")
        return position[by_position], at[by_position]

    def passages(self, number: int, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(matched words, start, end) of the template's alignments with enough matched words.

        Every diagonal whose band has enough of the template's words is aligned, most words
        first, unless the alignments found already hold too many of them for another passage,
        or match as much as it can.
        """
        template, need, band = self.words[number], self.need[number], self.band(number)
        position, at = self.hits(number, words)
        diagonal = at - position
        # A hit counts for the diagonals at most a band away that its word did not count for yet.
        again = np.append(False, position[1:] == position[:-1])
        low = diagonal - band
        low[1:] = np.where(again[1:], np.maximum(low[1:], diagonal[:-1] + band + 1), low[1:])
        base = len(template) + band
        size = base + len(words) + band + 1
        counts = np.cumsum(
            np.bincount(low + base, minlength=size) - np.bincount(diagonal + band + 1 + base, minlength=size)
        )
        own = np.bincount(diagonal + base, minlength=size)
        enough = np.flatnonzero(counts >= need)
        enough = enough[np.lexsort((enough, -own[enough], -counts[enough]))]
        best: list[tuple[int, int, int]] = []
        for place in enough.tolist():
            centre = place - base
            near = [x for x in best if x[1] < centre + len(template) + band and centre - band < x[2]]
            if near and counts[place] <= min(x[0] for x in near):
                inside = np.abs(diagonal - centre) <= band
                for _, start, end in near:
                    inside &= (at < start) | (at >= end)
                if len(np.unique(position[inside])) < need:
                    continue
            matched, start, end = align(template, words, centre, band)
            if matched < need:
                continue
            rivals = [x for x in best if x[1] < end and start < x[2]]
            if all((matched, -start) > (x[0], -x[1]) for x in rivals):
                best = [*(x for x in best if x not in rivals), (matched, start, end)]
        return best

    def matches(self, text: str) -> list[tuple[str, int, int, int, float]]:
        """(license, start, end, matched words, coverage) of all templates found, by position.

        Alignments of one template that overlap count once, the best of them.
        """
        words = self.hashed(words_of(text.encode()))
        found = [
            (number, *each)
            for number in self.candidates(words)
            for each in self.passages(number, words)
        ]
        if not found:
            return []
        offsets = [match.span() for match in WORD.finditer(text)]
        return sorted(
            (
                (
                    self.names[number],
                    offsets[start][0],
                    offsets[end - 1][1],
                    matched,
                    matched / len(self.words[number]),
                )
                for number, matched, start, end in found
            ),
            key=lambda match: (match[1], match[0]),
        )


def find_licenses(
    documents: DataFrame,
    templates: Sequence[tuple[str, str]] | None = None,
    coverage: float = COVERAGE,
) -> DataFrame:
    """(doc_id, license, start, end, matched_words, coverage): one row a template found in a text.

    Whole texts are scanned where they lie; the index of the templates, at most
    TEMPLATE_WORDS words, is broadcast. Spans are code points, end exclusive. A
    template is found if at least ``coverage`` of its words align in order within a
    band. Null, empty and clean texts give no row, an empty table none at all; repeated rows give
    theirs each. Texts of any length are scanned whole. Other columns are not read, so their
    names may clash.
    """
    chosen = list(TEMPLATES.items()) if templates is None else list(templates)
    chosen = [(name, text) for name, text in chosen if words_of(text.encode())]
    if sum(len(words_of(text.encode())) for _, text in chosen) > TEMPLATE_WORDS:
        raise ValueError("too many templates to broadcast: scan in several calls")
    context = documents.sparkSession.sparkContext.broadcast(TemplateIndex(chosen, coverage))
    names = ["license", "start", "end", "matched_words", "coverage"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: TemplateIndex = context.value
        for batch in batches:
            rows, places = [], []
            for place, value in enumerate(batch.column("text")):
                if value.is_valid:
                    found = index.matches(value.as_py())
                    rows += found
                    places += [place] * len(found)
            ids = batch.column("doc_id").take(pa.array(places, pa.int64()))
            columns = [
                pa.array([row[at] for row in rows], kind) for at, kind in enumerate(kinds)
            ]
            yield pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", *names])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text")).mapInArrow(
        scan,
        f"doc_id {kind}, license string, start long, end long, matched_words long, coverage double",
    )
