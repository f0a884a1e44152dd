"""Licence scans: a generalised suffix automaton of licence words, matching statistics, chained spans.

One automaton holds every substring of all templates and phrases. A text is streamed through it once:
at each word it knows the longest run of words ending there that stands in some template (the matching
statistics). A base phrase ends wherever its state is on the suffix-link path of the current state.
Long matches are chained per template, in order and over small gaps, into spans; the share of the
template that a chain covers decides whether the template's label is given.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from marquee.llm.shared import map_rows, plain_words, texts_of

# The phrases to find and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Public licence notices, as (label, words).
TEMPLATES = (
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
    and associated documentation files (the "Software"), to deal in the Software without restriction,
    including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
    and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
    subject to the following conditions: The above copyright notice and this permission notice shall be
    included in all copies or substantial portions of the Software."""),
    ("mit", """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
    BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
    NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR
    OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
    CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
    except in compliance with the License. You may obtain a copy of the License at
    http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
    software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
    CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
    permissions and limitations under the License."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted
    provided that the following conditions are met: Redistributions of source code must retain the above
    copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form
    must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
    documentation and/or other materials provided with the distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
    fee is hereby granted, provided that the above copyright notice and this permission notice appear in
    all copies."""),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the
    GNU General Public License as published by the Free Software Foundation, either version 3 of the
    License, or (at your option) any later version. This program is distributed in the hope that it will be
    useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
    PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
    of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)


@dataclass(frozen=True)
class Settings:
    phrases: tuple[tuple[str, str], ...] = tuple(PHRASES.items())
    templates: tuple[tuple[str, str], ...] = TEMPLATES
    shortest: int = 4  # words of a match that is chained
    gap: int = 12  # words between chained matches, at most, in the text and in the template
    share: float = 0.6  # of a template's words that a chain must cover for its label


@dataclass
class Automaton:
    """Generalised suffix automaton over word numbers, with what each state means for the scan."""

    settings: Settings
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    go: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])

    def __post_init__(self) -> None:
        s = self.settings
        self.phrase_words = [self._words(t) for t, _ in s.phrases]
        self.template_words = [self._words(t) for _, t in s.templates]
        ends: dict[int, list[tuple[int, int]]] = {}
        for number, words in enumerate([*self.phrase_words, *self.template_words]):
            at = 0
            for place, w in enumerate(words):
                at = self._extend(at, w)
                if number >= len(s.phrases):
                    ends.setdefault(at, []).append((number - len(s.phrases), place))
        # Phrases that end in a state, also through its suffix links.
        self.found: list[tuple[int, ...]] = [()] * len(self.go)
        whole = {}
        for number, words in enumerate(self.phrase_words):
            at = 0
            for w in words:
                at = self.go[at][w]
            if words:
                whole.setdefault(at, []).append(number)
        # Where in the templates the words of a state end: its own places and those below it.
        self.places: list[list[tuple[int, int]]] = [ends.get(v, []) for v in range(len(self.go))]
        for v in sorted(range(1, len(self.go)), key=self.length.__getitem__):
            self.found[v] = (*self.found[self.link[v]], *whole.get(v, ()))
        for v in sorted(range(1, len(self.go)), key=self.length.__getitem__, reverse=True):
            if self.link[v] > 0:
                self.places[self.link[v]] = self.places[self.link[v]] + self.places[v]
        self.pairs = {
            (a, b)
            for words in [*self.phrase_words, *self.template_words]
            for a, b in zip(words, words[1:], strict=False)
        }

    def _words(self, text: str) -> list[int]:
        return [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in plain_words(text)]

    def _copy(self, p: int, q: int, w: int) -> int:
        """The state of the words up to ``p`` and ``w``, split off from the longer ones of ``q``."""
        if self.length[p] + 1 == self.length[q]:
            return q
        twin = self._state(self.length[p] + 1, dict(self.go[q]), self.link[q])
        self.link[q] = twin
        while p >= 0 and self.go[p].get(w) == q:
            self.go[p][w] = twin
            p = self.link[p]
        return twin

    def _state(self, length: int, go: dict[int, int], link: int) -> int:
        self.go.append(go)
        self.link.append(link)
        self.length.append(length)
        return len(self.go) - 1

    def _extend(self, last: int, w: int) -> int:
        if w in self.go[last]:
            return self._copy(last, self.go[last][w], w)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and w not in self.go[p]:
            self.go[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._copy(p, self.go[p][w], w)
        return new

    def statistics(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """(place, state, length of the longest match ending there) for each word of a run."""
        at = size = 0
        for place, w in enumerate(words):
            while at and w not in self.go[at]:
                at = self.link[at]
                size = self.length[at]
            if w in self.go[at]:
                at, size = self.go[at][w], size + 1
            yield place, at, size

    def scan(self, text: str) -> dict:
        """Base places, labels and template spans of one whole text."""
        words = plain_words(text)
        number = self.vocabulary.get
        ids = [number(w, -1) for w in words]
        places: list[tuple[int, int]] = []  # (start, phrase)
        matches: dict[int, list[tuple[int, int, int]]] = {}  # template -> (start, template start, length)
        for start, run in self._runs(ids):
            before: tuple[int, int, int] | None = None
            for place, state, size in self.statistics(run):
                places += [
                    (start + place - n + 1, p)
                    for p in self.found[state]
                    if (n := len(self.phrase_words[p])) <= size  # its state also holds its suffixes
                ]
                if before and size <= before[2]:  # the match before could not be made longer
                    self._keep(start, before, matches)
                before = (place, state, size)
            self._keep(start, before, matches)
        spans = [
            (label, first, last, covered / len(self.template_words[t]))
            for t, found in sorted(matches.items())
            for label in [self.settings.templates[t][0]]
            for first, last, covered in self._chains(found)
        ]
        kept = [x for x in spans if x[3] >= self.settings.share]
        base = sorted({self.settings.phrases[p][1] for _, p in places})
        return {
            "n_words": len(words),
            "n_base": len(places),
            "first_word": min(places)[0] if places else None,
            "last_word": max(places)[0] if places else None,
            "base_labels": ",".join(base),
            "labels": ",".join(sorted({*base, *(x[0] for x in kept)})),
            "score": 1.0 if places else min(1.0, max((x[3] for x in spans), default=0.0)),
            "spans": [{"label": x[0], "first_word": x[1], "last_word": x[2], "share": x[3]} for x in kept],
        }

    def _runs(self, ids: list[int]) -> Iterator[tuple[int, list[int]]]:
        """Runs of words whose neighbours stand side by side in some template.

        Elsewhere the longest match is a single word, which neither a phrase (unless it is one word) nor
        a chain needs.
        """
        if any(len(p) == 1 for p in self.phrase_words) or self.settings.shortest < 2:
            yield 0, ids
            return
        pairs, start = self.pairs, -1
        for i, pair in enumerate(zip(ids, ids[1:], strict=False)):
            if pair in pairs:
                if start < 0:
                    start = i
            elif start >= 0:
                yield start, ids[start : i + 1]
                start = -1
        if start >= 0:
            yield start, ids[start:]

    def _keep(self, start: int, match: tuple[int, int, int] | None, matches: dict) -> None:
        if match and match[2] >= self.settings.shortest:
            place, state, size = match
            for template, end in self.places[state]:
                matches.setdefault(template, []).append((start + place - size + 1, end - size + 1, size))

    def _chains(self, found: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
        """(first word, last word, words covered) of chains: each next match lies, in the text and in
        the template, behind the last one by ``gap`` words at most; the longest chain to a match wins."""
        best: list[tuple[int, int]] = []  # words covered, start in the text
        found = sorted(found)
        used = [False] * len(found)
        low = 0
        for i, (x, y, n) in enumerate(found):
            cover, first, via = n, x, -1
            while low < i and found[low][0] + found[low][2] + self.settings.gap < x:
                low += 1
            for j in range(low, i):
                u, v, m = found[j]
                over = max(0, u + m - x, v + m - y)  # words that both have
                if u < x and v < y and over < n and x - u - m <= self.settings.gap and y - v - m <= self.settings.gap:
                    if best[j][0] + n - over > cover:
                        cover, first, via = best[j][0] + n - over, best[j][1], j
            best.append((cover, first))
            if via >= 0:
                used[via] = True
        for i, (x, _, n) in enumerate(found):
            if not used[i]:
                yield best[i][1], x + n - 1, best[i][0]


SPAN = "array<struct<label: string, first_word: bigint, last_word: bigint, share: double>>"


def scan_licences(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``spans`` are the template chains that cover at least ``settings.share`` of a template. A null or
    empty text has no words, no labels ("") and score 0; first_word and last_word are then null. The
    score is 1 where a base phrase stands, else the largest share of a template covered. Overlapping
    places of a phrase all count. Repeated rows are scanned each; an empty table gives an empty result.
    The automaton depends on the templates only and travels with the task.
    """
    automaton = Automaton(settings)
    texts = texts_of(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            found = [automaton.scan(t) for t in b["text"]]
            yield {"doc_id": b["doc_id"]} | {n: [f[n] for f in found] for n in names}

    return map_rows(
        texts,
        rows,
        f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        f"base_labels string, labels string, score double, spans {SPAN}",
    )
