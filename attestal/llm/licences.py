"""Licence scans: a generalised suffix automaton over the words of licence notices.

The automaton accepts every run of words of every template. A file's words are
streamed through it once; after each word it knows the longest run ending there
that some template has (the matching statistics). Runs that cannot be extended
and are long enough become fragments; fragments of one template that follow
each other in the file and in the template are chained, over gaps, to the span
that covers most of the template. Spans that cover enough are reported; where
spans of several templates overlap, the one with more words stands.

Files are read in place: no shuffle, and what a task holds is one batch of
texts. The automaton is built from the templates in each worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestal.llm.common import bound_batches

# --- fixed values: phrases of the contract, and public licence notices and their common short forms ---
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions"""),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License."""),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details."""),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any
        later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License
        for more details."""),
    ("agpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version."""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means."""),
    ("cc0", """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to
        this software to the public domain worldwide. This software is distributed without any warranty."""),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "licensed under CC BY-NC"), ("cc-by-sa", "licensed under CC BY-SA"), ("cc-by-nd", "licensed under CC BY-ND"),
    ("cc-by-nc-sa", "licensed under CC BY-NC-SA"), ("cc-by", "licensed under CC BY"), ("cc0", "Creative Commons Zero"),
    ("apache", "licensed under the Apache License, Version 2.0"), ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "licensed under the GNU General Public License, version 2"), ("lgpl", "GNU Lesser General Public License"),
    ("agpl", "GNU Affero General Public License"), ("mit", "released under the MIT License"), ("mit", "licensed under the MIT License"),
    ("bsd", "licensed under the BSD License"), ("bsd", "released under the BSD License"), ("isc", "licensed under the ISC License"),
    ("mpl", "Mozilla Public License"), ("mit", "SPDX-License-Identifier: MIT"), ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"), ("bsd", "SPDX-License-Identifier: BSD-2-Clause"),
    ("gpl", "SPDX-License-Identifier: GPL-2.0"), ("gpl", "SPDX-License-Identifier: GPL-3.0"),
    ("lgpl", "SPDX-License-Identifier: LGPL-2.1"), ("mpl", "SPDX-License-Identifier: MPL-2.0"), ("isc", "SPDX-License-Identifier: ISC"),
]
# --- end of the fixed values ---

#: Words of the shortest run that counts as a fragment, the widest gap between chained fragments in the file,
#: and the share of a template that a span must cover.
LEAST_RUN, GAP, SHARE = 3, 30, 0.75
#: Bytes of a text whose words are listed at a time.
CHUNK = 1 << 20

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def words(text: bytes) -> Iterator[list[bytes]]:
    """Words of a UTF-8 text in order, A-Z lower-cased, some at a time; a word is never cut."""
    at, size = 0, len(text)
    while at < size:
        end = at + CHUNK
        if end < size:
            found = _BREAK.search(text, end)
            end = found.start() if found else size
        yield _WORD.findall(text[at:end].lower())
        at = end


class Automaton:
    """Every run of words of the templates, with the places where each run ends in them."""

    def __init__(self, templates: list[list[bytes]]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.longest, self.suffix, self.moves = [0], [-1], [{}]
        for template in templates:
            state = 0
            for word in template:
                state = self._extend(state, self.vocabulary.setdefault(word, len(self.vocabulary)))
        # a later template may have split a state: the ends are walked to when all states are there
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.longest]
        self.whole: list[int] = []
        for number, template in enumerate(templates):
            state = 0
            for i, word in enumerate(template):
                state = self.moves[state][self.vocabulary[word]]
                self.ends[state].append((number, i + 1))
            self.whole.append(state)
        for state in sorted(range(1, len(self.longest)), key=lambda s: -self.longest[s]):
            self.ends[self.suffix[state]] += self.ends[state]
        self.ends[0] = []

    def _new(self, longest: int, suffix: int, moves: dict[int, int]) -> int:
        self.longest.append(longest)
        self.suffix.append(suffix)
        self.moves.append(moves)
        return len(self.longest) - 1

    def _extend(self, last: int, word: int) -> int:
        """The state of the run that ``word`` makes of the run of ``last``."""
        known = self.moves[last].get(word)
        if known is not None:
            return known if self.longest[known] == self.longest[last] + 1 else self._split(last, word, known)
        fresh, at = self._new(self.longest[last] + 1, 0, {}), last
        while at >= 0 and word not in self.moves[at]:
            self.moves[at][word] = fresh
            at = self.suffix[at]
        if at >= 0:
            known = self.moves[at][word]
            self.suffix[fresh] = known if self.longest[known] == self.longest[at] + 1 else self._split(at, word, known)
        return fresh

    def _split(self, at: int, word: int, known: int) -> int:
        """The runs of ``known`` that are no longer than those of ``at`` and one word, as a state of their own."""
        half = self._new(self.longest[at] + 1, self.suffix[known], dict(self.moves[known]))
        self.suffix[known] = half
        while at >= 0 and self.moves[at].get(word) == known:
            self.moves[at][word] = half
            at = self.suffix[at]
        return half

    def above(self, state: int) -> Iterator[int]:
        """The state and those of its proper suffixes."""
        while state > 0:
            yield state
            state = self.suffix[state]


class Scanner:
    """The templates as one automaton, and the labels of what it finds."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]) -> None:
        self.labels = [label for label, _ in templates] + list(phrases.values())
        texts = [text for _, text in templates] + list(phrases)
        lists = [[w for part in words(text.encode()) for w in part] for text in texts]
        self.sizes = [len(template) for template in lists]
        self.notices = len(templates)
        self.automaton = Automaton(lists)
        at = {self.automaton.whole[i]: i for i in range(self.notices, len(lists))}
        #: By state: the phrases (number, words) that end with its runs, longest first.
        self.phrases = [
            [(at[s], self.sizes[at[s]]) for s in self.automaton.above(state) if s in at] for state in range(len(self.automaton.longest))
        ]

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """Words; (phrase, first word) of each base place; (template, first word, word after, words covered) of each span."""
        automaton = self.automaton
        moves, suffix, longest, phrases = automaton.moves, automaton.suffix, automaton.longest, self.phrases
        get = automaton.vocabulary.get
        state = length = position = 0
        places: list[tuple[int, int]] = []
        chains = Chains(self.sizes, self.notices)
        for part in words(text):
            for word in map(get, part):
                position += 1
                if word is None:
                    if length >= LEAST_RUN:
                        chains.add(position - 1, length, automaton.ends[state])
                    state = length = 0
                    continue
                follow = moves[state].get(word)
                if follow is None:
                    if length >= LEAST_RUN:
                        chains.add(position - 1, length, automaton.ends[state])
                    while state and word not in moves[state]:
                        state = suffix[state]
                    length = longest[state]
                    follow = moves[state].get(word)
                    if follow is None:
                        continue
                state, length = follow, length + 1
                for phrase, size in phrases[state]:
                    if size <= length:
                        places.append((phrase, position - size))
        if length >= LEAST_RUN:
            chains.add(position, length, automaton.ends[state])
        return position, places, chains.spans()


class Chains:
    """Fragments, in the order in which they end in the file, chained by template."""

    def __init__(self, sizes: list[int], notices: int) -> None:
        self.sizes, self.notices = sizes, notices
        # by template: by the place in the template where a chain ends, (words covered, first word, word after)
        self.open: dict[int, dict[int, tuple[int, int, int]]] = {}
        self.found: dict[tuple[int, int], tuple[int, int]] = {}

    def add(self, stop: int, length: int, ends: list[tuple[int, int]]) -> None:
        start = stop - length
        for template, end in ends:
            if template >= self.notices:
                continue
            chains = self.open.setdefault(template, {})
            best = (length, start, stop)
            for other, (covered, first, after) in list(chains.items()):
                if after + GAP < start:
                    del chains[other]
                    continue
                fresh = min(length, stop - after, end - other)
                if fresh > 0 and covered + fresh > best[0]:
                    best = (covered + fresh, first, stop)
            if end not in chains or best >= chains[end]:
                chains[end] = best
            if best[0] >= SHARE * self.sizes[template]:
                # of the chains with one first word the one that covers most stands
                key = (template, best[1])
                self.found[key] = max(self.found.get(key, (0, 0)), (best[0], best[2]))

    def spans(self) -> list[tuple[int, int, int, int]]:
        """Spans in file order; of overlapping ones the one with more words, then with more of its template, stands."""
        order = [(t, first, stop, covered) for (t, first), (covered, stop) in self.found.items()]
        order.sort(key=lambda s: (-s[3], -s[3] / self.sizes[s[0]], s[1], s[0]))
        taken: list[tuple[int, int, int, int]] = []
        # blocks of words keep the search for overlaps short
        blocks: dict[int, list[tuple[int, int]]] = {}
        for span in order:
            near = range(span[1] >> 8, (span[2] - 1 >> 8) + 1)
            if all(stop <= span[1] or start >= span[2] for b in near for start, stop in blocks.get(b, ())):
                taken.append(span)
                for b in near:
                    blocks.setdefault(b, []).append(span[1:3])
        return sorted(taken, key=lambda s: s[1])


@cache
def scanner() -> Scanner:
    return Scanner(TEMPLATES, PHRASES)


SPAN = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("after_word", pa.int64()), ("share", pa.float64())])
RESULT = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(),
    "labels": pa.string(), "score": pa.float64(), "spans": pa.list_(SPAN),
}
_SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label: string, first_word: long, after_word: long, share: double>>"
)


def verdict(text: bytes) -> tuple:
    """The values of ``RESULT`` for one text."""
    scan = scanner()
    n, places, found = scan.scan(text)
    starts = [start for _, start in places]
    base = {scan.labels[phrase] for phrase, _ in places}
    spans = [
        {"label": scan.labels[t], "first_word": first, "after_word": stop, "share": covered / scan.sizes[t]} for t, first, stop, covered in found
    ]
    labels = base | {s["label"] for s in spans}
    score = max([s["share"] for s in spans] + [1.0] * bool(base), default=0.0)
    first, last = (min(starts), max(starts)) if starts else (None, None)
    return n, len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score, spans


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [verdict(value.as_py() or b"") for value in batch.column("_text").cast(pa.binary())]
        columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(RESULT.values())]
        kept = batch.drop_columns(["_text"])
        yield pa.RecordBatch.from_arrays([*kept.columns, *columns], names=[*kept.schema.names, *RESULT])


def scan_licences(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """All rows with the licences their text names or quotes.

    Adds ``n_words``; of the base phrases ``n_base`` (all places), ``first_word``,
    ``last_word`` (null without a place) and ``base_labels``; ``labels`` (base
    and covered templates); ``score``, the largest covered share (1 with a base
    phrase, 0 without a label); and ``spans``, the covered stretches. Input
    columns of these names, in any case, are replaced; all others are kept,
    the text unless ``keep_text`` is off. A null text counts as empty and has
    no word. Repeated rows are judged alike. An empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    names = [c for c in docs.columns if c.lower() not in RESULT and (keep_text or c.lower() != text.lower())]
    # carried by place, so that no name can clash with one of ours
    carried = docs.select(F.col(text).alias("_text"), *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(names)])
    schema = carried.drop("_text").schema.simpleString()[len("struct<") : -1]
    found = carried.mapInArrow(_scan_batches, f"{schema + ', ' if names else ''}{_SCHEMA}")
    return found.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(names)], *RESULT)
