"""License scans: texts streamed through a generalised suffix automaton of license tokens.

The automaton holds every run of words of every template. A text's words are streamed through it,
which gives the matching statistics: at each word the longest run ending there that some template
contains. Matches that cannot grow further are placed in the templates they occur in, and matches
that follow each other in both text and template are chained into spans of covered template words.

Whole templates that are short phrases are found at every place: the states of the automaton know
the phrases that end in them. The templates are few and fixed, so the automaton travels to the
tasks; texts are read once, in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mergelane.llm.arrow import LOWER, steps, text_bytes

# Phrases that are reported at every place, with their labels.
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)

# Well-known notices, with SPDX-like labels.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license, version 2.0"),
    ("apache-2.0", "licensed under the apache license, version 2.0 (the \"license\"); you may not use this file except in "
     "compliance with the license. you may obtain a copy of the license at http://www.apache.org/licenses/license-2.0 "
     "unless required by applicable law or agreed to in writing, software distributed under the license is distributed "
     "on an \"as is\" basis, without warranties or conditions of any kind, either express or implied."),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"software\"), to deal in the software without restriction, including without limitation "
     "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and "
     "to permit persons to whom the software is furnished to do so, subject to the following conditions: the above "
     "copyright notice and this permission notice shall be included in all copies or substantial portions of the software."),
    ("bsd", "redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met: redistributions of source code must retain the above copyright notice, this list "
     "of conditions and the following disclaimer."),
    ("isc", "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license, v. 2.0. if a copy of the mpl "
     "was not distributed with this file, you can obtain one at http://mozilla.org/mpl/2.0/"),
    ("gpl-3.0", "this work is licensed under the gnu general public license, version 3"),
    ("gpl-notice", "this program is free software: you can redistribute it and/or modify it under the terms of the gnu "
     "general public license as published by the free software foundation, either version 3 of the license, or (at your "
     "option) any later version."),
    ("gpl-notice", "this program is distributed in the hope that it will be useful, but without any warranty; without even "
     "the implied warranty of merchantability or fitness for a particular purpose. see the gnu general public license for "
     "more details."),
    ("cc-by-nc-4.0", "licensed under cc by-nc 4.0"),
    ("cc-by-4.0", "licensed under cc by 4.0"),
    ("cc-by-sa-4.0", "licensed under cc by-sa 4.0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution-sharealike 4.0 international license"),
    ("cc0-1.0", "to the extent possible under law, the author has waived all copyright and related or neighboring rights "
     "to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

# Bytes outside of words become blanks: a word is made of a-z (A-Z lower-cased), 0-9 and non-ASCII characters.
_WORD_BYTES = bytes(
    c if 97 <= (c := LOWER[b]) <= 122 or 48 <= c <= 57 or c >= 128 else 32 for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Limits:
    """What counts as a find.

    min_match: words a match needs to enter a chain; max_gap: words of the text between two matches of a chain;
    min_cover: covered share of the template's words that reports its label.
    """

    min_match: int = 3
    max_gap: int = 8
    min_cover: float = 0.8


class Automaton:
    """Generalised suffix automaton over word ids, one state per class of equal end places."""

    def __init__(self, phrases: Sequence[tuple[str, str]], templates: Sequence[tuple[str, str]]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        self.labels = [label for label, _ in (*phrases, *templates)]
        self.sizes: list[int] = []
        for t, (_, text) in enumerate((*phrases, *templates)):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text.encode())]
            self.sizes.append(len(ids))
            state = 0
            for end, word in enumerate(ids, 1):
                state = self._extend(state, word)
                self.ends[state].add((t, end))
        # End places go up the suffix links; a state then knows all templates and phrases its runs end in.
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            self.ends[self.link[state]] |= self.ends[state]
        n = len(phrases)
        self.phrases: list[list[tuple[int, int]]] = []
        for state in range(len(self.next)):
            # Phrases that are suffixes of the state's runs: those ending here as a whole, and those of its link.
            own = [(t, self.sizes[t]) for t, end in self.ends[state] if t < n and end == self.sizes[t] == self.length[state]]
            self.phrases.append(own)
        for state in sorted(range(1, len(self.next)), key=lambda s: self.length[s]):
            self.phrases[state] = self.phrases[state] + self.phrases[self.link[state]]
        self.places = [sorted(x) for x in self.ends]

    def _state(self, length: int, link: int, following: dict[int, int], ends: set) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(ends)
        return len(self.next) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A state for the runs of `target` that come from `state`; takes over the transitions to it."""
        clone = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]), set())
        self.link[target] = clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: int) -> int:
        target = self.next[last].get(word)
        if target is not None:
            return target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        new = self._state(self.length[last] + 1, 0, {}, set())
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            exact = self.length[target] == self.length[state] + 1
            self.link[new] = target if exact else self._split(state, word, target)
        return new

    def scan(self, ids: np.ndarray, limits: Limits) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """(phrase, start) of all places of phrases, and (template, first, last, covered) of all chains."""
        found: list[tuple[int, int]] = []
        matches: list[tuple[int, int, int]] = []  # end, length, state
        follow, link, lengths, phrases = self.next, self.link, self.length, self.phrases
        known = np.flatnonzero(ids >= 0)
        previous, state, length = -2, 0, 0
        for at, word in zip(known.tolist(), ids[known].tolist()):
            if at != previous + 1:
                if length >= limits.min_match:
                    matches.append((previous + 1, length, state))
                state, length = 0, 0
            elif length >= limits.min_match and word not in follow[state]:
                matches.append((at, length, state))
            while state and word not in follow[state]:
                state = link[state]
                length = lengths[state]
            if word in follow[state]:
                state = follow[state][word]
                length += 1
            previous = at
            for phrase, size in phrases[state]:
                if size <= length:
                    found.append((phrase, at + 1 - size))
        if length >= limits.min_match:
            matches.append((previous + 1, length, state))
        return found, self._chain(matches, limits)

    def _chain(self, matches: list[tuple[int, int, int]], limits: Limits) -> list[tuple[int, int, int, int]]:
        """Chains of matches in order, per template: the text goes on within `max_gap`, the template goes forward.

        A match goes on with the template's open chain at its first place behind it, or else ends that
        chain and opens one at its first place.
        """
        out = []
        open_chains: dict[int, list[int]] = {}  # template: first word, end in the text, end in the template, covered
        for end, length, state in matches:
            start = end - length
            by_template: dict[int, list[int]] = {}
            for t, t_end in self.places[state]:
                by_template.setdefault(t, []).append(t_end)
            for t, t_ends in by_template.items():
                if chain := open_chains.get(t):
                    shared = max(0, chain[1] - start)  # words of both matches count once
                    behind = [e for e in t_ends if e - length + shared >= chain[2]]
                    if behind and shared < length and start - chain[1] <= limits.max_gap:
                        chain[1:] = [end, behind[0], chain[3] + length - shared]
                        continue
                    out.append((t, chain[0], chain[1] - 1, chain[3]))
                open_chains[t] = [start, end, t_ends[0], length]
        out.extend((t, c[0], c[1] - 1, c[3]) for t, c in open_chains.items())
        return out


def scan_licenses(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: its id, n_words, ``places`` and ``spans``.

    places: array of (label, first_word, last_word), every place where a phrase stands, in order of the text.
    spans: array of (label, first_word, last_word, cover), chained matches of templates with at least
    `limits.min_cover` of the template's words, in order of the text. Words count from 0.

    A null text is empty: no words, empty arrays. Rows stay as they are, repeated ones and null ids
    included; other columns go, whatever their names; an empty table gives an empty one. Texts are
    scanned whole.
    """
    automaton = Automaton(phrases, templates)
    n_phrases = len(phrases)
    id_type = docs.schema[id_col].dataType.simpleString()
    place = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64())])
    span = pa.struct([*place, ("cover", pa.float64())])

    def one(text: bytes) -> tuple[int, list[dict], list[dict]]:
        own = words(text)
        ids = np.fromiter(map(automaton.vocabulary.get, own, repeat(-1)), dtype=np.int32, count=len(own))
        found, chains = automaton.scan(ids, limits)
        places = [
            {"label": automaton.labels[p], "first_word": at, "last_word": at + automaton.sizes[p] - 1} for p, at in found
        ]
        spans = [
            {"label": automaton.labels[t], "first_word": first, "last_word": last, "cover": min(1.0, n / automaton.sizes[t])}
            for t, first, last, n in chains
            if t >= n_phrases and n >= limits.min_cover * automaton.sizes[t]
        ]
        order = lambda x: (x["first_word"], x["last_word"], x["label"])
        return len(own), sorted(places, key=order), sorted(spans, key=order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            rows = [one(t) for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.list_(place)),
                    pa.array([r[2] for r in rows], pa.list_(span)),
                ],
                names=["id", "n_words", "places", "spans"],
            )

    kind = "label string, first_word long, last_word long"
    schema = f"id {id_type}, n_words long, places array<struct<{kind}>>, spans array<struct<{kind}, cover double>>"
    frame = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return frame.mapInArrow(run, schema).withColumnRenamed("id", id_col)
