"""Licence scan: a generalised suffix automaton over the words of licence templates.

The automaton accepts every run of words that stands in some template. A text streams through it: at each
word it knows the longest run ending there that a template holds (the matching statistics). Long runs are
chained per template when they lie in the same order and close together in text and template; a chain that
covers enough of its template is a licence span. Of spans in the same place that would give different labels,
the one that accounts for most words counts, so that a notice is not also one of a licence whose name is a part of
its own. Base phrases are templates too: one stands at every
place where the current run ends with it.

Words that no template holds, and pairs of neighbours that no template holds, break every run, so only
stretches of three and more fitting words are streamed word by word; the others are passed over as arrays.

Defined results: null and empty texts have no words, no places and score 0; a text holding a template n
times has n places; equal rows get equal results; texts of any length are scanned whole.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_left, insort
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgate.llm import words as W
from landgate.llm.batches import measured
from landgate.llm.tables import table

#: Phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: What Creative Commons licences are called, by label, and the words after a version.
CREATIVE_COMMONS = {
    "cc-by": "attribution",
    "cc-by-sa": "attribution sharealike",
    "cc-by-nd": "attribution noderivatives",
    "cc-by-nc": "attribution noncommercial",
    "cc-by-nc-sa": "attribution noncommercial sharealike",
    "cc-by-nc-nd": "attribution noncommercial noderivatives",
}
VERSIONS = ("4 0 international", "3 0 unported", "2 5 generic", "2 0 generic")
#: Notices by label, as their licences word them.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
     "and associated documentation files the software to deal in the software without restriction "
     "including without limitation the rights to use copy modify merge publish distribute sublicense "
     "and or sell copies of the software"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file "
     "except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
     "permitted provided that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of "
     "the gnu general public license as published by the free software foundation"),
    ("gpl-2", "gnu general public license version 2"),
    ("gpl-3", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or "
     "neighboring rights to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not "
     "limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
     "hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the "
     "software and accompanying documentation covered by this license the software to use reproduce display "
     "distribute execute and transmit the software"),
    ("boost", "distributed under the boost software license version 1 0"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors "
     "be held liable for any damages arising from the use of this software"),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied "
     "warranties including but not limited to the implied warranties of merchantability and fitness for a "
     "particular purpose are disclaimed"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu "
     "lesser general public license as published by the free software foundation"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "affero general public license as published by the free software foundation"),
    ("agpl", "gnu affero general public license"),
    ("mpl-2", "mozilla public license version 2 0"),
    ("epl-2", "made available under the terms of the eclipse public license 2 0"),
)


def _creative_commons() -> tuple[tuple[str, str], ...]:
    """The notices of all licences, with and without a version, and their short names."""
    long = [
        (label, f"licensed under a creative commons {name}{version} license")
        for label, name in CREATIVE_COMMONS.items()
        for version in ("", *[f" {v}" for v in VERSIONS])
    ]
    short = [(label, f"{label.replace('-', ' ')} {v[:3]}") for label in CREATIVE_COMMONS for v in VERSIONS]
    return (*long, *short)


TEMPLATES = (*NOTICES, *_creative_commons())
#: Shortest run that is chained, largest step between two runs of a chain in text and template, and the
#: covered part from which on a chain counts, for templates of more than SHORT words; others need all.
MIN_RUN, MAX_GAP, MIN_COVERED, SHORT = 3, 8, 0.75, 8
SCHEMA = (
    "n_words long, base array<struct<label string, start long>>, "
    "spans array<struct<label string, start long, end long, covered double>>"
)


class SuffixAutomaton:
    """All runs of the given sequences; a state knows where in the sequences its runs end."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for k, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].add((k, at))
        by_length = sorted(range(1, len(self.next)), key=lambda s: -self.length[s])
        for state in by_length:
            self.ends[self.link[state]] |= self.ends[state]
        self.ends[0] = set()

    def endings(self, state: int, length: int):
        """(sequence, place, words): for each place of a sequence at which a suffix of the current run of
        ``length`` words ends, the longest such suffix."""
        seen: set[tuple[int, int]] = set()
        while state:
            for end in self.ends[state] - seen:
                yield *end, min(length, end[1] + 1)
            seen |= self.ends[state]
            state = self.link[state]
            length = self.length[state]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, parent: int, word: int) -> int:
        """The state that ``parent`` reaches over ``word``, of length one more exactly."""
        child = self.next[parent][word]
        if self.length[child] == self.length[parent] + 1:
            return child
        copy = self._state(self.length[parent] + 1, self.link[child], dict(self.next[child]))
        self.link[child] = copy
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def statistics(self, words: list[int]):
        """(state, length) of the longest run that ends at each word."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            yield state, length


def split(text: str) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


class Scanner:
    def __init__(self, base=tuple(BASE.items()), templates=TEMPLATES):
        self.base, self.templates = base, templates
        sequences = [split(p) for p, _ in base] + [split(t) for _, t in templates]
        vocabulary = sorted({w for s in sequences for w in s})
        number = {w: i for i, w in enumerate(vocabulary)}
        self.size = len(vocabulary)
        data = np.frombuffer("".join(vocabulary).encode(), np.uint8)
        end = np.cumsum([len(w.encode()) for w in vocabulary])
        start = end - [len(w.encode()) for w in vocabulary]
        hashes = W.span_hashes(data, W.Spans(start, end, np.arange(self.size)))
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.sequences = numbered = [[number[w] for w in s] for s in sequences]
        self.lengths = [len(s) for s in numbered]
        self.automaton = SuffixAutomaton(numbered)
        self.pairs = np.zeros((self.size + 1, self.size + 1), bool)
        for s in numbered:
            self.pairs[s[:-1], s[1:]] = True

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word in the vocabulary; ``size`` for all others."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), self.size - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], self.size)

    def _chains(self, runs: list[tuple[int, int, int]], length: int) -> list[tuple[int, int, int]]:
        """runs (text start, template start, words), by text start: chains (start, end, covered words).

        A run continues the chain with the nearest end before it in text and template, within MAX_GAP. Words
        at its start that the chain has already, in text or template, are left to the chain.
        """
        wanted = MIN_COVERED if length > SHORT else 1
        open_: deque[list[int]] = deque()
        done = []
        for start, at, n in runs:
            while open_ and start - open_[0][1] > MAX_GAP:
                done.append(open_.popleft())
            fits = []
            for chain in open_:
                shared = max(0, chain[1] - start, chain[2] - at)
                gaps = start + shared - chain[1], at + shared - chain[2]
                if shared < n and max(gaps) <= MAX_GAP:
                    fits.append((sum(gaps) + shared, shared, chain))
            if fits:
                _, shared, chain = min(fits, key=lambda f: f[0])
                open_.remove(chain)
                chain[1:] = [start + n, at + n, chain[3] + n - shared]
            else:
                chain = [start, start + n, at + n, n]
            open_.append(chain)
        return [(c[0], c[1], c[3]) for c in [*done, *open_] if c[3] >= wanted * length]

    def scan(self, words: list[int], offset: int = 0) -> tuple[list, list]:
        """Places of base phrases, and covered template spans, in a stretch of fitting words."""
        places, runs = [], {}
        for i, (state, length) in enumerate(self.automaton.statistics(words), 1):
            for k, at, n in self.automaton.endings(state, length) if length >= MIN_RUN else ():
                if k < len(self.base):
                    if n == self.lengths[k]:
                        places.append((self.base[k][1], offset + i - n))
                    continue
                whole = self.sequences[k]
                goes_on = i < len(words) and at + 1 < len(whole) and words[i] == whole[at + 1]
                if n >= MIN_RUN and not goes_on:
                    runs.setdefault(k, []).append((offset + i - n, at + 1 - n, n))
        return places, runs

    def measure(self, column: pa.Array) -> dict:
        out: dict[str, list] = {"n_words": [], "base": [], "spans": []}
        for texts in W.slices(column):
            data = W.LOWER[texts.data]
            found = W.spans(texts, W.ALNUM[data])
            n = len(texts)
            first = np.searchsorted(found.text, np.arange(n + 1))
            number = self.numbers(W.span_hashes(data, found))
            fits = self.pairs[number[:-1], number[1:]] & (found.text[:-1] == found.text[1:])
            edges = np.flatnonzero(np.diff(np.concatenate(([0], fits.view(np.int8), [0]))))
            base = [[] for _ in range(n)]
            runs = [{} for _ in range(n)]
            for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if end - start < MIN_RUN - 1:
                    continue
                text = int(found.text[start])
                places, own = self.scan(number[start : end + 1].tolist(), start - int(first[text]))
                base[text] += [{"label": label, "start": at} for label, at in places]
                for k, some in own.items():
                    runs[text].setdefault(k, []).extend(some)
            out["n_words"] += np.diff(first).tolist()
            out["base"] += base
            out["spans"] += [self.spans(own) for own in runs]
        return out

    def spans(self, runs: dict[int, list]) -> list[dict]:
        found = []
        for k, own in runs.items():
            label, length = self.templates[k - len(self.base)][0], self.lengths[k]
            for start, end, covered in self._chains(sorted(own), length):
                found.append((covered, min(1.0, covered / length), label, start, end))
        found.sort(key=lambda s: (-s[0], -s[1], s[2], s[3]))
        longest = max((end - start for *_, start, end in found), default=0)
        kept: list[tuple[int, int, str, float]] = []
        for _, part, label, start, end in found:
            near = kept[bisect_left(kept, (start - longest,)) : bisect_left(kept, (end,))]
            if not any(l != label and 2 * (min(end, e) - max(start, s)) > end - start for s, e, l, _ in near):
                insort(kept, (start, end, label, part))
        return [{"label": label, "start": start, "end": end, "covered": part} for start, end, label, part in kept]


@functools.lru_cache(maxsize=2)
def scanner() -> Scanner:
    """One for each worker process."""
    return Scanner()


def license_spans(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and (n_words, base, spans): places of base phrases, covered spans of templates."""
    return measured(docs, lambda column: scanner().measure(column), SCHEMA, text, keep)


def op1_suffix_automaton(spark, sf_dir):
    found = license_spans(table(spark, sf_dir, "documents"))
    base, spans = F.col("base.label"), F.col("spans.label")
    starts = F.col("base.start")
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, spans))), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0)
        .otherwise(F.coalesce(F.array_max("spans.covered"), F.lit(0.0)))
        .alias("score"),
    )


QUERIES = {"op1_suffix_automaton": (op1_suffix_automaton, None)}
