"""Licence scan with a generalised suffix automaton.

The automaton holds every run of words of the licence templates. A text's words
stream through it and give matching statistics: at each word, the longest run
ending there that some template has. Long maximal matches are placed in each
template they occur in and chained, in order and without overlap, into covered
template spans. A template counts as present when a chain covers enough of it.

Templates include the base phrases, whose every place is reported as well:
where the words of a phrase stand consecutively.

Defined results: a null text is empty; a text without words has no places and
score 0; repeated rows give a row each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail.llm.common import arrow_rows

#: Fixed phrases and their labels.
BASE_PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

#: Notices of well-known licences: label and public text.
TEMPLATES = (
    ("cc-by-nc", "licensed under cc by nc 4.0"),
    ("cc-by-sa", "licensed under cc by sa 4.0"),
    ("cc-by-4.0", "licensed under cc by 4.0"),
    ("gpl-3.0", "this work is licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "this work is licensed under the GNU General Public License, version 2"),
    ("apache-2.0", "licensed under the Apache License, Version 2.0"),
    ("mit-notice", "released under the MIT License"),
    (
        "mit-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files, to deal in the Software without"
        " restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with"
        " or without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
    ),
    (
        "apache-2.0-notice",
        "you may not use this file except in compliance with the License. You may obtain a copy"
        " of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "gpl-notice",
        "you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation",
    ),
    (
        "lgpl-notice",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain",
    ),
)

#: Words of a match that is chained, unless the whole template is shorter.
LONG_MATCH = 3
#: Words of text between two matches of one chain, at most.
GAP = 64
#: Share of a template that a chain has to cover.
COVERED = 0.8

SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string,"
    " labels string, score double,"
    " spans array<struct<label:string,first:long,end:long,covered:double>>"
)

# A-Z to lower case; all ASCII but digits and letters to a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


@dataclass
class Template:
    label: str
    words: list[int]
    base: bool


class Automaton:
    """Suffix automaton of several templates. State 0 is the empty run."""

    def __init__(self, phrases=BASE_PHRASES, templates=TEMPLATES):
        self.ids: dict[bytes, int] = {}
        self.templates = [
            Template(label, [self.ids.setdefault(w, len(self.ids)) for w in words_of(text)], base)
            for listed, base in ((phrases, True), (templates, False))
            for label, text in listed
        ]
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.size = [0]
        for template in self.templates:
            last = 0
            for word in template.words:
                last = self._extend(last, word)
        #: (template, end) of every place of a state's runs.
        self.places: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for t, template in enumerate(self.templates):
            state = 0
            for end, word in enumerate(template.words, 1):
                state = at = self.next[state][word]
                while at > 0:
                    self.places[at].append((t, end))
                    at = self.link[at]
        #: (template, words) of the base phrases that a state's longest run ends with.
        self.phrases: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for state in sorted(range(1, len(self.link)), key=self.size.__getitem__):
            own = [
                (t, end)
                for t, end in self.places[state]
                if self.templates[t].base
                and end == len(self.templates[t].words) == self.size[state]
            ]
            self.phrases[state] = own + self.phrases[self.link[state]]

    def _add(self, size: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.size.append(size)
        self.link.append(link)
        return len(self.size) - 1

    def _split(self, start: int, word: int) -> int:
        """The state of ``start``'s longest run followed by ``word``."""
        to = self.next[start][word]
        if self.size[to] == self.size[start] + 1:
            return to
        copy = self._add(self.size[start] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = copy
        while start >= 0 and self.next[start].get(word) == to:
            self.next[start][word] = copy
            start = self.link[start]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._add(self.size[last] + 1, {}, 0)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def stream(self, ids: list[int]):
        """(state, length) of the longest run that ends at each word."""
        state = length = 0
        for word in ids:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.size[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            yield state, length


class _PrefixMax:
    """Best (score, start) over all keys up to one."""

    def __init__(self, n: int):
        self.best = [(0, None)] * (n + 1)

    def add(self, key: int, value) -> None:
        while key < len(self.best):
            if value[0] > self.best[key][0]:
                self.best[key] = value
            key += key & -key

    def upto(self, key: int):
        found = (0, None)
        while key > 0:
            if self.best[key][0] > found[0]:
                found = self.best[key]
            key -= key & -key
        return found


def chain(matches: list[tuple[int, int, int]], size: int) -> list[tuple[int, int, int]]:
    """Best chain of each cluster of (text start, template start, length):
    (words covered, first word, end word). In a chain both starts rise and
    neither side overlaps."""
    found = []
    cluster: list[tuple[int, int, int]] = []

    def close():
        tree, waiting, best = _PrefixMax(size + 1), [], (0, 0, 0)
        for at, place, length in cluster:
            while waiting and waiting[0][0] <= at:
                end, to, score, first = heapq.heappop(waiting)
                tree.add(to + 1, (score, first))
            score, first = tree.upto(place + 1)
            score, first = score + length, at if first is None else first
            heapq.heappush(waiting, (at + length, place + length, score, first))
            best = max(best, (score, -first, at + length))
        found.append((best[0], -best[1], best[2]))

    for m in sorted(matches):
        if cluster and m[0] - max(reach, 0) > GAP:
            close()
            cluster = []
        reach = max(reach, m[0] + m[2]) if cluster else m[0] + m[2]
        cluster.append(m)
    if cluster:
        close()
    return found


def scan_text(text: str, automaton: Automaton) -> tuple:
    words = words_of(text)
    get = automaton.ids.get
    ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
    known = np.flatnonzero(ids >= 0)
    starts: list[tuple[int, int]] = []
    matches: dict[int, list[tuple[int, int, int]]] = {}
    # An unknown word brings the automaton back to its first state, so the
    # stretches between unknown words are streamed one by one; a stretch of one
    # word can hold neither a phrase nor a long match.
    cuts = np.flatnonzero(np.diff(known) > 1) + 1
    for run in np.split(known, cuts) if len(known) else ():
        if len(run) < 2:
            continue
        first = int(run[0])
        stats = [*automaton.stream(ids[run].tolist()), (0, 0)]
        for i, (state, length) in enumerate(stats[:-1]):
            for t, n in automaton.phrases[state]:
                if n <= length:
                    starts.append((first + i + 1 - n, t))
            # Maximal to the right: the next word does not go on with it.
            if length >= 2 and stats[i + 1][1] != length + 1:
                for t, end in automaton.places[state]:
                    size = len(automaton.templates[t].words)
                    if length >= min(LONG_MATCH, size) and length <= end:
                        own = (first + i + 1 - length, end - length, length)
                        matches.setdefault(t, []).append(own)
    spans, score = [], 0.0
    for t, placed in matches.items():
        template = automaton.templates[t]
        for covered, begin, end in chain(placed, len(template.words)):
            share = covered / len(template.words)
            score = max(score, share)
            if share >= COVERED:
                spans.append({"label": template.label, "first": begin, "end": end, "covered": share})
    base = {automaton.templates[t].label for _, t in starts}
    labels = base | {s["label"] for s in spans}
    if base:
        score = 1.0
    places = [at for at, _ in starts]
    return (
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        score,
        sorted(spans, key=lambda s: (s["first"], s["end"], s["label"])),
    )


_automaton: list[Automaton] = []


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its base places, labels, score and spans."""
    names = [part.split()[0] for part in SCHEMA.split(", ") if " " in part]
    names = names[: names.index("spans") + 1]

    def work():
        if not _automaton:
            _automaton.append(Automaton())

        def step(batch):
            if batch is None or not batch.num_rows:
                return []
            rows = [scan_text(t.as_py() or "", _automaton[0]) for t in batch.column(1)]
            columns = dict(zip(names, map(list, zip(*rows))))
            return [{"doc_id": batch.column(0).to_pylist(), **columns}]

        return step

    frame = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    return arrow_rows(frame, work, "doc_id long, " + SCHEMA)
