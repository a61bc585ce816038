"""Licence scans with a generalised suffix automaton.

The automaton holds every run of words of every template. A document streams
through it: after each word, the state and the length of the longest run of
template words that ends there (its matching statistic). The state leads to
every place of every template where a long match ends. The matches are
chained per template, in order of both texts, by dynamic programming: where two
overlap, only the uncovered words of the second count. Of overlapping chains of
one template the one that covers the most words becomes a span.

Defined results: null and empty texts have no words, no spans, score 0 and
an empty list of labels; texts are streamed whole; repeated rows are scanned
each for itself; null ids are carried along; an empty table gives an empty
result; columns other than the id and the text are ignored. Templates with
the same words share states; a match counts for each of them.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from moorage.llm.common import map_rows, plain_words

# Phrases that name a licence, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Common licence statements and notices, by label.
TEMPLATES: list[tuple[str, str]] = [
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    ("cc", "Licensed under CC BY-NC 4.0."),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
]


class Automaton:
    """All runs of words of several texts; states keep a place where their runs end, per text."""

    def __init__(self, texts: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for number, words in enumerate(texts):
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, word)
                self.ends[last].add((number, place))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            self.ends[self.link[state]] |= self.ends[state]
        self._shorter: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A copy of ``target`` that holds only its runs reachable over ``state``."""
        clone = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = clone
        while state != -1 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if (known := self.next[last].get(word)) is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        made, state = self._state(self.length[last] + 1, {}, 0), last
        while state != -1 and word not in self.next[state]:
            self.next[state][word] = made
            state = self.link[state]
        if state != -1:
            target = self.next[state][word]
            exact = self.length[target] == self.length[state] + 1
            self.link[made] = target if exact else self._split(state, word, target)
        return made

    def matches(self, words: list[int], least: int) -> list[tuple[int, int, int]]:
        """Longest matches that no following word extends: (end, length, state), at least ``least`` long."""
        found, state, length = [], 0, 0
        for place, word in enumerate(words):
            if word not in self.next[state]:
                if length >= least:
                    found.append((place, length, state))
                while state and word not in self.next[state]:
                    state = self.link[state]
                    length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
        if length >= least:
            found.append((len(words), length, state))
        return found

    def _places(self, state: int, least: int) -> list[tuple[int, int]]:
        """Text and place of every end of the last ``least`` words of the state's runs."""
        if (state, least) not in self._shorter:
            shorter = state
            while self.length[self.link[shorter]] >= least:
                shorter = self.link[shorter]
            self._shorter[state, least] = sorted(self.ends[shorter])
        return self._shorter[state, least]

    def all_matches(self, words: list[int], least: int) -> list[tuple[int, int, int, int]]:
        """Every match of at least ``least`` words that can't be made longer: (end, length, text, end in the text)."""
        found, state, length = [], 0, 0
        open_at: dict[tuple[int, int], int] = {}
        for place, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            if length < least and not open_at:
                continue
            now = {}
            if length >= least:
                for text, end in self._places(state, least):
                    now[text, end] = open_at.pop((text, end - 1), least - 1) + 1
            found += [(place, n, text, end + 1) for (text, end), n in open_at.items()]
            open_at = now
        return found + [(len(words), n, text, end + 1) for (text, end), n in open_at.items()]


class Span(NamedTuple):
    label: str
    template: int
    start: int
    end: int
    covered: int
    share: float


#: Start and end in the document, start and end in the template.
Match = tuple[int, int, int, int]


class Scanner:
    """Scans texts for phrases and template spans. ``least`` words make a match, ``gap`` words may part two of a chain."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES, least: int = 3, gap: int = 8, share: float = 0.5):
        self.least, self.gap, self.share = least, gap, share
        self.phrases = [(plain_words(phrase), label) for phrase, label in phrases.items()]
        split = [(label, plain_words(text)) for label, text in templates]
        known = dict.fromkeys(word for _, words in [*split, *((l, p) for p, l in self.phrases)] for word in words)
        self.ids = {word: number for number, word in enumerate(known)}
        self.templates = [(label, [self.ids[word] for word in words]) for label, words in split]
        self.automaton = Automaton([words for _, words in self.templates])

    def words(self, text: str | None) -> np.ndarray:
        """Numbers of the words; -1 for words that no template or phrase has."""
        found = plain_words(text)
        get = self.ids.get
        return np.fromiter((get(word, -1) for word in found), np.int32, len(found))

    def places(self, numbers: np.ndarray) -> list[tuple[int, str]]:
        """Start and label of every place of a phrase."""
        found = []
        for phrase, label in self.phrases:
            n = len(numbers) - len(phrase) + 1
            if n > 0:
                hits = np.ones(n, bool)
                for shift, word in enumerate(phrase):
                    hits &= numbers[shift : shift + n] == self.ids[word]
                found += [(int(start), label) for start in np.flatnonzero(hits)]
        return sorted(found)

    def spans(self, numbers: np.ndarray) -> list[Span]:
        """Chains of matches that cover at least ``share`` of a template; those of one template don't overlap."""
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (numbers >= 0).view(np.int8), [0]))))
        matches: dict[int, list[Match]] = {}
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start >= self.least:
                for stop, length, template, high in self.automaton.all_matches(numbers[start:end].tolist(), self.least):
                    matches.setdefault(template, []).append((start + stop - length, start + stop, high - length, high))
        found = []
        for template, rows in matches.items():
            label, words = self.templates[template]
            if sum(stop - start for start, stop, _, _ in rows) < self.share * len(words):
                continue
            for start, stop, covered in self._chains(rows, self.share * len(words)):
                found.append(Span(label, template, start, stop, covered, covered / len(words)))
        return sorted(found, key=lambda span: (span.start, span.end, span.template))

    def _chains(self, rows: list[Match], needed: float) -> list[tuple[int, int, int]]:
        """Start, end and covered words of the best chain, then of the best ones to its left and right, and so on."""
        found, parts = [], []
        for row in sorted(rows):
            if parts and row[0] - reach <= self.gap:
                parts[-1].append(row)
                reach = max(reach, row[1])
            else:
                parts.append([row])
                reach = row[1]
        while parts:
            part = parts.pop()
            if not part or (best := self._best(part))[2] < needed:
                continue
            found.append(best)
            start, stop, _ = best
            parts.append([(a, min(b, start), c, d - max(0, b - start)) for a, b, c, d in part if min(b, start) - a >= self.least])
            parts.append([(max(a, stop), b, c + max(0, stop - a), d) for a, b, c, d in part if b - max(a, stop) >= self.least])
        return found

    def _best(self, rows: list[Match]) -> tuple[int, int, int]:
        """The chain that covers the most words; of equal ones one near the middle, so that the rest falls into halves."""
        rows = sorted(rows, key=lambda row: (row[1], row[3], row[0]))
        begun, covered = [], []
        for j, (start, stop, low, high) in enumerate(rows):
            most, first = stop - start, start
            for i in range(j - 1, -1, -1):
                _, stop_i, _, high_i = rows[i]
                if stop_i < start - self.gap:
                    break
                skip = max(0, stop_i - start, high_i - low)
                if skip < stop - start and start + skip - stop_i <= self.gap and low + skip - high_i <= self.gap:
                    most, first = max((most, first), (covered[i] + stop - start - skip, begun[i]))
            begun.append(first)
            covered.append(most)
        most = max(covered)
        ends = [i for i, n in enumerate(covered) if n == most]
        end = ends[len(ends) // 2]
        return begun[end], rows[end][1], most


SPANS = "array<struct<label:string,template:int,start_word:int,end_word:int,covered:int,share:double>>"


def scan(docs: DataFrame, scanner: Scanner | None = None, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: number of words, phrase places (start, label), and template spans."""
    scanner = scanner or Scanner()
    kind = docs.schema[key].dataType.simpleString()

    def row(k, t):
        numbers = scanner.words(t)
        places = [{"start_word": start, "label": label} for start, label in scanner.places(numbers)]
        spans = [dict(zip(("label", "template", "start_word", "end_word", "covered", "share"), s)) for s in scanner.spans(numbers)]
        return k, len(numbers), places, spans

    return map_rows(
        docs, [key, text], row,
        f"`{key}` {kind}, n_words long, places array<struct<start_word:long,label:string>>, spans {SPANS}",
    )
