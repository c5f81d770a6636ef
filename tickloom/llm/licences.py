"""Licence scans by a generalised suffix automaton.

The automaton accepts every substring of the licence templates, as word sequences.
A text's words are streamed through it, which gives matching statistics: after
each word, the longest template passage that ends there. Maximal passages of some
length are chained, in the order of the template and with small gaps, into spans
of covered template words. A span's coverage is the share of the template's words that it
covers, or of its own words if these are more, so a missing, a changed and an inserted
word all count against it. Of spans that share most of their words the best covered one
gives its label, so that licences that differ in one word are told apart.

Beside that, fixed phrases are looked for at every place (base labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import ship, text_of

# Phrases and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Passages of public licences and notices, by label.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("cc-by-nc-nd", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("lgpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("agpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("bsd-3", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

LEAST_MATCH = 3
LARGEST_GAP = 8
LEAST_SCORE = 0.8

_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and other characters above 127."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class SuffixAutomaton:
    """Of several sequences of small integers. ``where`` gives, per state, the
    (template, end) places of its substrings."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        places: list[list[tuple[int, int]]] = [[]]
        for number, sequence in enumerate(sequences):
            last = 0
            for end, symbol in enumerate(sequence, 1):
                last = self._extend(last, symbol, places)
                places[last].append((number, end))
        order = sorted(range(len(self.length)), key=self.length.__getitem__, reverse=True)
        for state in order:  # a suffix ends wherever its longer strings end
            if self.link[state] >= 0:
                places[self.link[state]] += places[state]
        self.where = [tuple(dict.fromkeys(x)) for x in places]

    def _new(self, length: int, edges: dict[int, int], link: int, places: list) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        places.append([])
        return len(self.length) - 1

    def _split(self, state: int, symbol: int, places: list) -> int:
        """The state for ``symbol`` after ``state``'s longest string, cut off from
        longer strings if need be."""
        target = self.next[state][symbol]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._new(self.length[state] + 1, dict(self.next[target]), self.link[target], places)
        self.link[target] = copy
        while state >= 0 and self.next[state].get(symbol) == target:
            self.next[state][symbol] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, symbol: int, places: list) -> int:
        if symbol in self.next[last]:
            return self._split(last, symbol, places)
        state = self._new(self.length[last] + 1, {}, 0, places)
        at = last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = state
            at = self.link[at]
        if at >= 0:
            self.link[state] = self._split(at, symbol, places)
        return state

    def statistics(self, sequence: list[int]) -> Iterator[tuple[int, int]]:
        """(state, matched length) after each symbol."""
        state = size = 0
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                size += 1
            else:
                size = 0
            yield state, size


@dataclass(frozen=True)
class Span:
    template: int
    start: int  # first word of the text
    end: int  # past its last word
    covered: int  # template words


class Scanner:
    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.phrases = [(words(p), label) for p, label in phrases]
        self.labels = [label for label, _ in templates]
        sequences = [words(t) for _, t in templates]
        self.sizes = [len(x) for x in sequences]
        self.ids: dict[bytes, int] = {}
        for w in (w for x in [*sequences, *(p for p, _ in self.phrases)] for w in x):
            self.ids.setdefault(w, len(self.ids) + 1)
        self.automaton = SuffixAutomaton([[self.ids[w] for w in x] for x in sequences])
        self.phrase_ids = [[self.ids[w] for w in p] for p, _ in self.phrases]

    def runs(self, ids: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """Start and ids of the runs of known words; no match crosses an unknown one."""
        known = np.flatnonzero(ids)
        if not len(known):
            return
        cut = np.flatnonzero(np.diff(known) > 1) + 1
        for part in np.split(known, cut):
            yield int(part[0]), ids[part[0] : part[-1] + 1].tolist()

    def matches(self, start: int, run: list[int]) -> Iterator[tuple[int, int, int]]:
        """(state, text start, length) of maximal passages of LEAST_MATCH words or
        more: those that the next word does not extend."""
        held = None
        for at, (state, size) in enumerate(self.automaton.statistics(run), start + 1):
            if held and size <= held[2]:
                yield held
            held = (state, at - size, size) if size >= LEAST_MATCH else None
        if held:
            yield held

    def spans(self, ids: np.ndarray) -> list[Span]:
        """Chains of matches, per template: a match continues the open chain if it
        comes after it in template and text and not more than LARGEST_GAP words
        later in the text; else the chain is closed and a new one opened."""
        open_: dict[int, tuple[int, int, int, int]] = {}
        out: list[Span] = []
        for start, run in self.runs(ids):
            for state, at, size in self.matches(start, run):
                by_template: dict[int, list[int]] = {}
                for template, end in self.automaton.where[state]:
                    by_template.setdefault(template, []).append(end)
                for template, ends in by_template.items():
                    now = open_.get(template)
                    fresh = min(ends)
                    if now is not None:
                        first, last, covered, upto = now
                        later = [e for e in ends if e > upto]
                        if at <= last + LARGEST_GAP and later:
                            end = min(later)
                            more = min(size, end - upto)
                            open_[template] = (first, at + size, covered + more, end)
                            continue
                        out.append(Span(template, first, last, covered))
                    open_[template] = (at, at + size, size, fresh)
        out += [Span(t, first, last, covered) for t, (first, last, covered, _) in open_.items()]
        return sorted(out, key=lambda s: (s.start, s.template))

    def coverage(self, span: Span) -> float:
        return span.covered / max(self.sizes[span.template], span.end - span.start)

    def named(self, spans: list[Span], n_words: int) -> set[str]:
        """Labels of the spans that cover enough, best first; one whose words mostly lie
        in spans taken before it gives none. Spans of a template do not overlap, so the
        cost is bounded by the words times the templates."""
        good = [(-self.coverage(s), -s.covered, s.start, s) for s in spans if self.coverage(s) >= LEAST_SCORE]
        taken = np.zeros(n_words, bool)
        labels = set()
        for *_, s in sorted(good, key=lambda x: x[:3]):
            if 2 * int(taken[s.start : s.end].sum()) < s.end - s.start:
                labels.add(self.labels[s.template])
                taken[s.start : s.end] = True
        return labels

    def scan(self, text: str | None) -> dict:
        found = words(text)
        ids = np.fromiter((self.ids.get(w, 0) for w in found), np.int32, len(found))
        starts: list[int] = []
        base = set()
        for phrase, (_, label) in zip(self.phrase_ids, self.phrases, strict=True):
            room = len(ids) - len(phrase) + 1
            if room <= 0:
                continue
            hit = np.ones(room, bool)
            for k, w in enumerate(phrase):
                hit &= ids[k : k + room] == w
            places = np.flatnonzero(hit)
            if len(places):
                starts += places.tolist()
                base.add(label)
        spans = self.spans(ids)
        named = base | self.named(spans, len(ids))
        return {
            "n_words": len(found),
            "n_base": len(starts),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(named)),
            "score": max(map(self.coverage, spans), default=0.0),
            "spans": [
                {
                    "label": self.labels[s.template],
                    "start": s.start,
                    "end": s.end,
                    "coverage": self.coverage(s),
                }
                for s in spans
            ],
        }


_FIELDS = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        (
            "spans",
            pa.list_(
                pa.struct(
                    [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())]
                )
            ),
        ),
    ]
)
_DDL = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, spans array<struct<label:string,start:bigint,end:bigint,coverage:double>>"
)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score and spans (label, start, end, coverage; in words).

    ``score`` is the largest coverage, 0 to 1; from LEAST_SCORE on a span's label is added
    to the base labels, unless a better covered span holds most of its words. Null and wordless texts have no words, no
    labels and score 0. The templates are few and fixed, so the automaton travels
    with the function.
    """
    ship()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = [f.name for f in _FIELDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        for batch in batches:
            found = pa.array([scanner.scan(t.as_py()) for t in batch.column("text")], _FIELDS)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *found.flatten()], ["doc_id", *names])

    return rows.mapInArrow(run, f"doc_id {kind}, {_DDL}")
