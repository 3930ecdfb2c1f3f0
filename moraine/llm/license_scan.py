"""Licence scan with a generalised suffix automaton of licence texts.

The automaton of all templates is built once and sent to the tasks (its size
is that of the templates, not of the data). A file's words run through it and
give matching statistics: at each word, the length of the longest piece of any
template that ends there, and a template that holds it. Long matches of one
template are chained in order into covered spans, each of a file's copies by
itself; a template that is covered well enough becomes a label, and the best coverage is the score.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraine.llm.words import ALNUM_TABLE, slices

PIECE = 4_000_000
#: Templates of fewer tokens must be covered but for one token.
SHORT = 10

# The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices and opening sentences of public licences, by label.
TEMPLATES = {
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND',
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
}


def tokens(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(ALNUM_TABLE).split()


class SuffixAutomaton:
    """Of several token sequences; each state knows the sequences that hold its strings."""

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.sequences = sequences
        self.owners: list[set[int]] = [set()]
        for s, sequence in enumerate(sequences):
            last = 0
            for token in sequence:
                last = self._extend(last, token)
            state = 0
            for token in sequence:  # every prefix's state, and by links all its suffixes
                state = self.next[state][token]
                up = state
                while up > 0 and s not in self.owners[up]:
                    self.owners[up].add(s)
                    up = self.link[up]

    def _new(self, length: int, edges: dict[bytes, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.owners.append(set())
        return len(self.next) - 1

    def _split(self, p: int, token: bytes, q: int) -> int:
        clone = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, token: bytes) -> int:
        if token in self.next[last]:
            q = self.next[last][token]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, token, q)
        new = self._new(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][token]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, token, q)
        return new

    def state_of(self, sequence: list[bytes]) -> int:
        state = 0
        for token in sequence:
            state = self.next[state][token]
        return state


@dataclass
class Scanner:
    """The automaton over templates and phrases, and what its states stand for."""

    automaton: SuffixAutomaton
    #: Per state, the phrases (length, label) that end wherever one of its strings ends.
    phrases: list[list[tuple[int, str]]]
    labels: list[str]
    #: Tokens that a match needs to be chained, and the covered share that makes a label.
    least: int
    share: float

    def statistics(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(place, state, length) of the longest match ending at each word that has one."""
        step, link, length = self.automaton.next, self.automaton.link, self.automaton.length
        state = have = 0
        root = step[0]
        for i, word in enumerate(words):
            if state == 0:
                if word not in root:
                    continue
                state, have = root[word], 1
            else:
                while state and word not in step[state]:
                    state = link[state]
                    have = length[state]
                state = step[state].get(word, 0)
                have = have + 1 if state else 0
                if not state:
                    continue
            yield i, state, have

    def scan(self, text: str | None) -> tuple[int, int, int | None, int | None, set[str], set[str], float, list[tuple[int, int, str]]]:
        """Words, base places, first and last of them, base labels, all labels, score, covered spans (begin, end, label)."""
        words = tokens(text)
        n_base, first, last, base = 0, None, None, set()
        matches: list[tuple[int, int, int]] = []  # begin, end, state of maximal matches
        before = (-2, 0, 0)
        for i, state, have in self.statistics(words):
            for n, label in self.phrases[state]:
                if n <= have:
                    n_base += 1
                    start = i - n + 1
                    first = start if first is None else min(first, start)
                    last = start if last is None else max(last, start)
                    base.add(label)
            if before[0] >= 0 and not (before[0] == i - 1 and have == before[2] + 1) and before[2] >= self.least:
                matches.append((before[0] - before[2] + 1, before[0] + 1, before[1]))
            before = (i, state, have)
        if before[2] >= self.least:
            matches.append((before[0] - before[2] + 1, before[0] + 1, before[1]))
        best, labels, spans = 0.0, set(base), []
        by_template: dict[int, list[tuple[int, int]]] = {}
        for begin, end, state in matches:
            for t in self.automaton.owners[state]:
                if t < len(self.labels):
                    by_template.setdefault(t, []).append((begin, end))
        for t, found in sorted(by_template.items()):
            covered, chosen = self._chains(words, t, found)
            best = max(best, covered)
            if chosen:
                labels.add(self.labels[t])
                spans += [(*span, self.labels[t]) for span in chosen]
        return len(words), n_base, first, last, base, labels, 1.0 if base else best, spans

    def needed(self, t: int) -> float:
        """The covered share that makes a label. Short templates differ in a word or two, so all their tokens but one must stand."""
        n = len(self.automaton.sequences[t])
        return max(self.share, (n - 1) / n) if n < SHORT else self.share

    def _chains(self, words: list[bytes], t: int, found: list[tuple[int, int]]) -> tuple[float, list[tuple[int, int]]]:
        """The largest share of template ``t`` that matches cover in its own order inside twice its length; and the spans of all chains that cover enough.

        One pass finds the best chain that ends with each match (the shortest
        of equals), looking back no further than the template allows. Chains
        that overlap a better one, or an equal one before them, are left out.
        """
        template = self.automaton.sequences[t]
        size, pieces = len(template), []
        for begin, end in found:
            piece = words[begin:end]
            for at in range(size - len(piece) + 1):
                if template[at : at + len(piece)] == piece:
                    pieces.append((begin, end, at, at + len(piece)))
        chains, ended = [], []
        for begin, end, a, b in sorted(pieces):
            total, start = b - a, begin
            for _, e, y, covered, s in chains[bisect_left(chains, (begin - 2 * size,)) :]:
                if e <= begin and y <= a and end - s <= 2 * size and (covered + b - a, s) > (total, start):
                    total, start = covered + b - a, s
            chains.append((begin, end, b, total, start))
            ended.append((-total, end, start))
        best = max((-total for total, _, _ in ended), default=0) / size
        chosen: list[tuple[int, int]] = []
        for total, end, start in sorted(x for x in ended if -x[0] / size >= self.needed(t)):
            k = bisect_left(chosen, (end,))  # spans before k begin before this one's end
            if not k or chosen[k - 1][1] <= start:
                chosen.insert(k, (start, end))
        return best, chosen


def scanner(templates: dict[str, list[str]] = TEMPLATES, phrases: dict[str, str] = PHRASES, *, least: int = 3, share: float = 0.6) -> Scanner:
    sequences, labels = [], []
    for label, texts in templates.items():
        for t in texts:
            sequences.append(tokens(t))
            labels.append(label)
    known = [(tokens(p), label) for p, label in phrases.items()]
    automaton = SuffixAutomaton(sequences + [p for p, _ in known])
    ends: dict[int, list[tuple[int, str]]] = {}
    for p, label in known:
        ends.setdefault(automaton.state_of(p), []).append((len(p), label))
    reached = []
    for state in range(len(automaton.next)):
        up, here = state, []
        while up > 0:
            here += ends.get(up, [])
            up = automaton.link[up]
        reached.append(here)
    return Scanner(automaton, reached, labels, least, share)


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<begin:int,end:int,label:string>>"


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text", templates: dict[str, list[str]] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """One row for every row of ``docs``, read once and not shuffled.

    Null and wordless texts have no words, no places (first and last null),
    empty labels and a score of 0. Ids are passed on as they are, null and
    repeated ones too; other columns are ignored. The score is 1 where a base
    phrase stands, else the best covered share of any template.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scanner(templates, phrases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            out = [shared.value.scan(t) for t in batch.column("text").to_pylist()]
            long = lambda k: pa.array([x[k] for x in out], pa.int64())
            spans = pa.array([[dict(zip(("begin", "end", "label"), s)) for s in x[7]] for x in out], pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("label", pa.string())])))
            joined = lambda k: pa.array([",".join(sorted(x[k])) for x in out], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), long(0), long(1), long(2), long(3), joined(4), joined(5), pa.array([float(x[6]) for x in out]), spans], names=[f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)


def report(docs: DataFrame, **options) -> DataFrame:
    """``scan`` without the spans."""
    return scan(docs, **options).drop("spans")
