"""Licence spans by matching statistics against a generalised suffix automaton.

The automaton holds the word sequences of all licence templates.  A text's words stream
through it: at every word it knows the longest suffix that some template contains.  Long
matches that cannot be extended are chained, template by template, where both sides
advance; a chain that covers enough of its template is a licence span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases whose every place counts, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Notices and grants of public licences, several to a label.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy "
        "of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer",
    ),
    "cc-by": (
        "licensed under a Creative Commons Attribution 4.0 International License",
        "licensed under CC BY",
        "licensed under the Creative Commons Attribution license",
    ),
    "gpl": (
        "licensed under the GNU General Public License, version 3",
        "under the terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    "mit": (
        "licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without restriction",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
    "reserved": ("All rights reserved", "No part of this publication may be reproduced"),
}

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z in lower case: digits, a-z and all beyond ASCII."""
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower())


class SuffixAutomaton:
    """Smallest automaton of all factors of several word sequences.

    A state knows, for each sequence it occurs in, the ends of all its places there.
    """

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, list[int]]] = [{}]

    def _state(self, length: int, follows: dict[bytes, int], link: int) -> int:
        self.next.append(follows)
        self.length.append(length)
        self.link.append(link)
        self.ends.append({})
        return len(self.link) - 1

    def _split(self, parent: int, word: bytes, child: int) -> int:
        """The state of the shorter strings of ``child`` that ``parent`` leads to."""
        if self.length[child] == self.length[parent] + 1:
            return child
        twin = self._state(self.length[parent] + 1, dict(self.next[child]), self.link[child])
        self.ends[twin] = {n: list(places) for n, places in self.ends[child].items()}
        self.link[child] = twin
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = twin
            parent = self.link[parent]
        return twin

    def add(self, number: int, words: Sequence[bytes]) -> None:
        last = 0
        for place, word in enumerate(words):
            known = self.next[last].get(word)
            if known is not None:
                state = self._split(last, word, known)
            else:
                state, parent = self._state(self.length[last] + 1, {}, 0), last
                while parent >= 0 and word not in self.next[parent]:
                    self.next[parent][word] = state
                    parent = self.link[parent]
                if parent >= 0:
                    self.link[state] = self._split(parent, word, self.next[parent][word])
            up = state
            while up > 0:
                self.ends[up].setdefault(number, []).append(place + 1)
                up = self.link[up]
            last = state

    def matches(self, words: Sequence[bytes], least: int) -> Iterator[tuple[int, int, int]]:
        """End, length and state of every match of ``least`` words that cannot grow rightwards."""
        state = size = 0
        for i, word in enumerate(words):
            after = self.next[state].get(word)
            if after is None:
                if size >= least:
                    yield i, size, state
                while after is None and state:
                    state = self.link[state]
                    size = self.length[state]
                    after = self.next[state].get(word)
                if after is None:
                    size = 0
                    continue
            state, size = after, size + 1
        if size >= least:
            yield len(words), size, state


@dataclass
class LicenceScanner:
    """Templates in an automaton, phrases as word tuples, and how much of a template counts."""

    templates: Mapping[str, Sequence[str]] = field(default_factory=lambda: TEMPLATES)
    phrases: Mapping[str, str] = field(default_factory=lambda: PHRASES)
    least: int = 2
    coverage: float = 0.8
    gap: int = 8

    def __post_init__(self) -> None:
        self.automaton, self.labels, self.sizes = SuffixAutomaton(), [], []
        for label, texts in self.templates.items():
            for text in texts:
                words = words_of(text)
                self.automaton.add(len(self.labels), words)
                self.labels.append(label)
                self.sizes.append(len(words))
        self.vocabulary = frozenset(self.automaton.next[0])
        self.phrase_words = [(tuple(words_of(p)), label) for p, label in self.phrases.items()]
        self.phrase_first = frozenset(words[0] for words, _ in self.phrase_words)

    def places(self, words: list[bytes]) -> list[tuple[int, str]]:
        """Start and label of every place of a phrase."""
        found = []
        for first in self.phrase_first.intersection(words):
            kinds = [(p, label) for p, label in self.phrase_words if p[0] == first]
            at = -1
            for _ in range(words.count(first)):
                at = words.index(first, at + 1)
                found += [(at, k) for p, k in kinds if tuple(words[at : at + len(p)]) == p]
        return sorted(found)

    def spans(self, words: list[bytes]) -> list[tuple[int, int, str, float]]:
        """Start, end, label and covered share of every licence span, in order."""
        known, found = self.vocabulary, {}
        run = 0
        flags = [w in known for w in words]
        flags.append(False)
        for i, on in enumerate(flags):
            if on:
                run += 1
                continue
            if run >= self.least:
                base = i - run
                for end, size, state in self.automaton.matches(words[base:i], self.least):
                    for t, stops in self.automaton.ends[state].items():
                        places = found.setdefault(t, [])
                        places += [(base + end - size, base + end, stop - size, stop) for stop in stops]
            run = 0
        out = []
        for t, places in found.items():
            need = self.coverage * self.sizes[t]
            # of a template's chains the longest come first; they do not overlap
            taken: list[tuple[int, int]] = []
            for covered, first, end in sorted(self.chains(places), key=lambda c: (-c[0], c[2], c[1])):
                if covered < need:
                    break
                if all(end <= a or first >= b for a, b in taken):
                    taken.append((first, end))
                    out.append((first, end, self.labels[t], covered / self.sizes[t]))
        return sorted(out)

    def chains(self, places: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
        """(covered words, start, end) of the best chain that ends in each match of a template.

        ``places`` are matches by their end: start and end in the text, begin and stop in the
        template.  A chain rises in both, with at most ``gap`` words of the text between
        matches; what overlaps counts once.  Any number of stray matches may lie between.
        """
        best: list[tuple[int, int, int]] = []
        for k, (start, end, begin, stop) in enumerate(places):
            covered, first = end - start, start
            for j in range(k - 1, -1, -1):
                a, b, c, d = places[j]
                if start - b > self.gap:
                    break
                if a < start and b < end and c < begin and d < stop:
                    joined = best[j][0] + end - start - max(0, d - begin, b - start)
                    if joined > covered:
                        covered, first = joined, best[j][1]
            best.append((covered, first, end))
        return best


SPAN = "array<struct<start:bigint,end:bigint,label:string,covered:double>>"


def scan_licences(docs: DataFrame, scanner: LicenceScanner | None = None) -> DataFrame:
    """Per row: doc_id, n_words, places of phrases and licence spans, in one narrow pass.

    ``places`` has start and label of every phrase, ``spans`` start, end (exclusive, in
    words from 0), label and covered share of its template.  A null text counts as empty
    and has neither.  Equal rows give equal results, an empty table none; texts are read
    whole, and columns beside doc_id and text are not looked at.
    """
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    scanner = scanner or LicenceScanner()

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts, places, spans = [], [], []
            for text in batch["text"]:
                words = words_of(text)
                counts.append(len(words))
                places.append([{"start": a, "label": k} for a, k in scanner.places(words)])
                spans.append(
                    [
                        {"start": a, "end": b, "label": k, "covered": c}
                        for a, b, k, c in scanner.spans(words)
                    ]
                )
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "n_words": counts, "places": places, "spans": spans}
            )

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    places = "array<struct<start:bigint,label:string>>"
    schema = f"doc_id {kind}, n_words bigint, places {places}, spans {SPAN}"
    return rows.mapInPandas(scanned, schema)


def licence_digest(scanned: DataFrame) -> DataFrame:
    """Counts, labels and a score of each scanned row."""

    def joined(*columns: str):
        labels = F.concat(*(F.col(c + ".label") for c in columns))
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    covered = F.greatest(F.lit(0.0), F.array_max(F.col("spans.covered")))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(F.col("places.start")).alias("first_word"),
        F.array_max(F.col("places.start")).alias("last_word"),
        joined("places").alias("base_labels"),
        joined("places", "spans").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), covered)).alias("score"),
    )
