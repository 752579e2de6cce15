"""Licence passages: matching statistics in a generalised suffix automaton, chained into template spans."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.token_ids import array_groups

# Phrases and labels that every scan looks for.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Passages of public licence texts and usual notices, by label.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "Released under the MIT License."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
]

MIN_MATCH = 3
MIN_COVER = 0.6
MAX_GAP = 8

# A-Z in lower case; everything in ASCII that is no letter or digit becomes a blank.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
SCHEMA = (
    "doc_id bigint, n_words bigint, base array<struct<label: string, start: bigint>>, "
    "spans array<struct<label: string, first: bigint, last: bigint, share: double>>"
)


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


class Numbers(dict):
    """Word -> number among the template words."""

    def add(self, word: bytes) -> int:
        return self.setdefault(word, len(self))


class TemplateAutomaton:
    """All factors of all templates and phrases, over word numbers."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str], min_match: int) -> None:
        self.numbers = Numbers()
        self.labels = [label for label, _ in templates]
        texts = [[self.numbers.add(w) for w in split_words(text)] for _, text in templates]
        self.sizes = [len(t) for t in texts]
        searched = [([self.numbers.add(w) for w in split_words(p)], label) for p, label in phrases.items()]
        if any(len(words) < 2 for words, _ in searched):
            raise ValueError("a phrase needs two words at least")
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for words in texts + [words for words, _ in searched]:
            last = 0
            for word in words:
                last = self.extend(last, word)
        self.known = np.zeros((len(self.numbers) + 1, len(self.numbers) + 1), bool)  # the last row: unknown words
        for words in texts + [words for words, _ in searched]:
            self.known[words[:-1], words[1:]] = True
        self.places: list[list[tuple[int, int]]] = [[] for _ in self.step]
        for n, words in enumerate(texts):
            for end, state in enumerate(self.read(words), 1):
                while self.length[state] >= min_match:
                    self.places[state].append((n, end))
                    state = self.link[state]
        own: list[list[tuple[int, str]]] = [[] for _ in self.step]
        for words, label in searched:
            own[list(self.read(words))[-1]].append((len(words), label))
        self.phrases: list[list[tuple[int, str]]] = [[] for _ in self.step]
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            self.phrases[state] = own[state] + self.phrases[self.link[state]]

    def extend(self, last: int, word: int) -> int:
        """One more word behind ``last``; the state of the extended string."""
        known = self.step[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self.divide(last, word, known)
        fresh = self.state({}, self.length[last] + 1, 0)
        at = last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = fresh
            at = self.link[at]
        if at >= 0:
            below = self.step[at][word]
            short = self.length[below] == self.length[at] + 1
            self.link[fresh] = below if short else self.divide(at, word, below)
        return fresh

    def divide(self, at: int, word: int, below: int) -> int:
        """Split off the part of ``below`` that ends the string of ``at`` and ``word``."""
        copy = self.state(dict(self.step[below]), self.length[at] + 1, self.link[below])
        self.link[below] = copy
        while at >= 0 and self.step[at].get(word) == below:
            self.step[at][word] = copy
            at = self.link[at]
        return copy

    def state(self, step: dict[int, int], length: int, link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.step) - 1

    def read(self, words: list[int]) -> Iterator[int]:
        state = 0
        for word in words:
            state = self.step[state][word]
            yield state

    def statistics(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """Matching statistics: after each word, the state and length of the longest factor ending there."""
        state = size = 0
        for word in words:
            while state and word not in self.step[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.step[state]:
                state = self.step[state][word]
                size += 1
            yield state, size

    def scan(self, words: list[bytes], min_match: int) -> tuple[list[tuple[str, int]], list[tuple[int, int, int, int]]]:
        """Phrase places, and maximal matches as (template, start in the text, start in it, words).

        Only stretches in which every two neighbours are neighbours in a template
        are streamed: no longer match can reach over another place.
        """
        missing = len(self.numbers)
        ids = np.fromiter(map(self.numbers.get, words, repeat(missing)), np.int32, len(words))
        edge = np.flatnonzero(np.diff(self.known[ids[:-1], ids[1:]], prepend=False, append=False)) if len(ids) > 1 else []
        base, matches = [], []
        for begin, end in zip(edge[::2], edge[1::2]):
            stretch = ids[begin : end + 1].tolist()
            found = list(self.statistics(stretch))
            for n, (state, size) in enumerate(found):
                stop = int(begin) + n + 1
                base += [(label, stop - k) for k, label in self.phrases[state] if k <= size]
                if size >= min_match and (n + 1 == len(found) or found[n + 1][1] != size + 1):
                    matches += [(t, stop - size, at - size, size) for t, at in self.places[state]]
        return base, matches


def chains(matches: list[tuple[int, int, int, int]], max_gap: int) -> list[tuple[int, int, int, int]]:
    """The best chains of matches in order, as (template, first word, last word, covered words).

    In a chain, matches of one template follow each other in the text and in the
    template with at most ``max_gap`` words between them; what overlaps counts once.
    """
    out = []
    matches = sorted(matches)
    at = 0
    while at < len(matches):
        template, open_, done = matches[at][0], [], []
        while at < len(matches) and matches[at][0] == template:
            _, start, begin, size = matches[at]
            at += 1
            best = (size, start)
            still = []
            for other in open_:
                if other[0] < start - max_gap:
                    done.append(other)
                    continue
                still.append(other)
                stop, end, covered, first = other
                fresh = min(size, start + size - stop, begin + size - end)
                if 0 < fresh and end - begin <= size and begin - end <= max_gap:
                    best = max(best, (covered + fresh, first))
            open_ = still + [(start + size, begin + size, *best)]
        done += open_
        # Of chains that share words of the text, the one that covers most stays.
        taken = -1
        for stop, _, covered, first in sorted(done, key=lambda c: (c[3], -c[2])):
            if first > taken:
                out.append((template, first, stop - 1, covered))
                taken = stop - 1
    return out


def scan(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    templates: list[tuple[str, str]] | None = None,
    phrases: dict[str, str] | None = None,
    min_match: int = MIN_MATCH,
    min_cover: float = MIN_COVER,
    max_gap: int = MAX_GAP,
) -> DataFrame:
    """``(doc_id, n_words, base, spans)``, one row per row of ``docs``.

    ``base`` has every place of a phrase, ``spans`` the template passages of which
    ``min_cover`` of the words or more are covered.  Null and empty texts have no
    words; repeated ids give repeated rows.  Texts are streamed as a whole, and the
    work is linear in their words but for the few words inside passages.
    """
    automaton = TemplateAutomaton(TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases, min_match)
    sent = docs.sparkSession.sparkContext.broadcast(automaton)
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_words", pa.int64()),
            ("base", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))),
            ("spans", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("share", pa.float64())]))),
        ]
    )

    def passages(model: TemplateAutomaton, matches: list[tuple[int, int, int, int]]) -> list[dict]:
        found = []
        for template, first, last, covered in chains(matches, max_gap):
            share = covered / model.sizes[template]
            if share >= min_cover:
                found.append({"label": model.labels[template], "first": first, "last": last, "share": share})
        return found

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            keys = iter(batch.column(0).to_pylist())
            for texts in array_groups(batch.column(1), 1_000_000):
                out = []
                for value, key in zip(texts.to_pylist(), keys):
                    words = split_words(value)
                    base, matches = model.scan(words, min_match)
                    places = [{"label": label, "start": start} for label, start in base]
                    out.append({"doc_id": key, "n_words": len(words), "base": places, "spans": passages(model, matches) if matches else []})
                yield pa.RecordBatch.from_pylist(out, schema)

    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(rows, SCHEMA)
