"""License scans with a generalised suffix automaton of licence words.

The automaton holds every run of words of all templates. A text is streamed through it, which
gives its matching statistics: for each word the longest run of words ending there that some
template holds. Where it finds runs of ``LEAST_MATCH`` words or more, each template's own automaton gives
the runs that this template does not continue, whichever others do. They are chained for each
template: in the order of both the text and the template, with at most ``GAP`` words of
the text between two of them. A chain is a span of the text; the share of the template's words
that it covers is its score, and at ``LEAST_COVER`` or more it gives the template's label.

Base phrases are found wherever their words stand one after the other, and always count.

Words are runs of letters, digits and bytes above 127 after A-Z are made small; a null text is
empty and an empty text has no words. Results hold for whole texts of any length, in memory
proportional to one text; repeated rows have equal results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from opsreport.llm.common import bytes_list, record, struct_column, text_or_empty

LEAST_MATCH = 4
GAP = 8
LEAST_COVER = 0.6

# Phrases that count wherever they stand, with their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Notices and clauses of public licences, with the labels of the method.
TEMPLATES = (
    ("mit-notice", "Released under the MIT License."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    (
        "apache-2.0-text",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    (
        "gpl-text",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    (
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.",
    ),
    (
        "isc-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
)

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)

SCAN, SCAN_ARROW = record(
    "n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, n_spans long, longest_match long"
)


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_TABLE).split()


class Automaton:
    """Suffix automaton of several word sequences, with the places where each state ends."""

    def __init__(self, sequences: list[list[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for t, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._extend(last, word, ends)
                ends[last].add((t, place))
        # A state's places are also those of the shorter runs it links to.
        for s in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            ends[self.link[s]] |= ends[s]
        self.ends = [tuple(sorted(e)) for e in ends]

    def _new(self, length: int, ends: list) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        ends.append(set())
        return len(self.link) - 1

    def _split(self, p: int, word: int, ends: list) -> int:
        """The state of p's run and the word, of exactly one word more than p."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        twin = self._new(self.length[p] + 1, ends)
        self.next[twin] = dict(self.next[q])
        self.link[twin] = self.link[q]
        self.link[q] = twin
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, word: int, ends: list) -> int:
        if word in self.next[last]:
            return self._split(last, word, ends)
        new = self._new(self.length[last] + 1, ends)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        self.link[new] = self._split(p, word, ends) if p >= 0 else 0
        return new

    def matches(self, ids: list[int], least: int) -> Iterator[tuple[int, int, int]]:
        """(last place, length, state) of every run of ``least`` words that goes no further."""
        state = size = 0
        for place, word in enumerate(ids):
            to = self.next[state].get(word)
            if to is None and size >= least:
                yield place - 1, size, state
            while to is None and state:
                state = self.link[state]
                size = self.length[state]
                to = self.next[state].get(word)
            if to is None:
                state = size = 0
            else:
                state, size = to, size + 1
        if size >= least:
            yield len(ids) - 1, size, state


class Scanner:
    """Phrases and templates, ready to scan texts."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES) -> None:
        self.code: dict[bytes, int] = {}
        number = lambda text: [
            self.code.setdefault(w, len(self.code)) for w in words_of(text.encode())
        ]
        self.phrases = [(number(p), label) for p, label in phrases]
        sequences = [number(t) for _, t in templates]
        self.labels = [label for label, _ in templates]
        self.sizes = [len(s) for s in sequences]
        self.automaton = Automaton(sequences)
        self.own = [Automaton([s]) for s in sequences]

    def scan(self, data: bytes) -> tuple:
        words = words_of(data)
        get = self.code.get
        ids = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
        base, labels = [], set()
        for phrase, label in self.phrases:
            n = len(ids) - len(phrase) + 1
            if n <= 0:
                continue
            at = np.flatnonzero(ids[:n] == phrase[0])
            for k in range(1, len(phrase)):
                at = at[ids[at + k] == phrase[k]]
            if len(at):
                base += at.tolist()
                labels.add(label)
        spans, longest = self.spans(ids)
        best = max((s[3] for s in spans), default=0.0)
        own = labels | {s[0] for s in spans if s[3] >= LEAST_COVER}
        return (
            len(words),
            len(base),
            min(base, default=None),
            max(base, default=None),
            ",".join(sorted(labels)),
            ",".join(sorted(own)),
            min(1.0, best),
            len(spans),
            longest,
        )

    def spans(self, ids: np.ndarray) -> tuple[list[tuple[str, int, int, float]], int]:
        """Covered spans (label, first word, last word, share of the template), longest match."""
        known = np.concatenate(([0], (ids >= 0).astype(np.int8), [0]))
        starts = np.flatnonzero(np.diff(known) == 1)
        stops = np.flatnonzero(np.diff(known) == -1)
        longest = 0
        hits: dict[int, list[tuple[int, int, int]]] = {}
        for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
            if b - a >= LEAST_MATCH:
                part = ids[a:b].tolist()
                size = max((m[1] for m in self.automaton.matches(part, LEAST_MATCH)), default=0)
                longest = max(longest, size)
                for t, automaton in enumerate(self.own if size else ()):
                    for last, size, state in automaton.matches(part, LEAST_MATCH):
                        hits.setdefault(t, []).extend(
                            (a + last - size + 1, end - size + 1, size)
                            for _, end in automaton.ends[state]
                        )
        out = []
        for t, own in sorted(hits.items()):
            out += [
                (self.labels[t], a, b, covered / self.sizes[t]) for a, b, covered in chains(own)
            ]
        return out, longest


def chains(hits: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Best chains of (text place, template place, words): (first, last word, words covered).

    A chain takes hits in the order of text and template; between two there are at most ``GAP``
    words of the text. Of hits that overlap, what is new in both counts. Chains are taken by
    the words they cover, and no two share a word of the text.
    """
    hits = sorted(hits)
    best: list[tuple[int, int]] = []  # words covered, hit before
    low = 0
    widest = max((h[2] for h in hits), default=0)
    for k, (at, there, size) in enumerate(hits):
        while hits[low][0] < at - GAP - widest:
            low += 1
        top = (size, -1)
        for j in range(low, k):
            a, b, n = hits[j]
            if a + n + GAP < at or b >= there or a >= at:
                continue
            shared = max(a + n - at, b + n - there, 0)
            if shared < size and best[j][0] + size - shared > top[0]:
                top = (best[j][0] + size - shared, j)
        best.append(top)
    out: list[tuple[int, int, int]] = []
    used: set[int] = set()
    taken: list[tuple[int, int]] = []
    for k in sorted(range(len(hits)), key=lambda k: (-best[k][0], hits[k])):
        way, j = [], k
        while j >= 0 and j not in used:
            way.append(j)
            j = best[j][1]
        if not way or j >= 0:
            continue
        used.update(way)
        first = hits[way[-1]][0]
        last = hits[k][0] + hits[k][2] - 1
        if all(last < a or first > b for a, b in taken):
            taken.append((first, last))
            out.append((first, last, best[k][0]))
    return sorted(out)


_SCANNER: list[Scanner] = []


def scanner() -> Scanner:
    if not _SCANNER:
        _SCANNER.append(Scanner())
    return _SCANNER[0]


@arrow_udf(SCAN)
def _scan(text: pa.Array) -> pa.Array:
    s = scanner()
    return struct_column([s.scan(b) for b in bytes_list(text)], SCAN_ARROW)


def license_scan(text: str | Column) -> Column:
    """Struct of counts, labels and score for a text column."""
    return _scan(text_or_empty(text))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and what the scan finds in its text."""
    return docs.select(F.col(id_col), license_scan(text_col).alias("s")).select(id_col, "s.*")
