"""Rows that every operator on documents must cope with, and brute-force versions."""

import collections
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SENTENCE = "the quick brown fox jumps over the lazy dog and runs away from the old hunter near the river bank"
LONG = " ".join(f"word{i % 977} und{i % 31}" for i in range(30_000))

TEXTS = [
    (1, SENTENCE),
    (2, SENTENCE.upper()),
    (3, SENTENCE + " today"),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (7, LONG),
    (8, "Ünïcödé 😀 \u0301x İ"),
    (9, "same"),
    (9, "same"),
    (10, "same"),
    (None, SENTENCE),
    (None, None),
    (11, "Licensed under the Apache License, Version 2.0.\nunder the MIT license under the mit license"),
    (12, "a  b \x00 c\r\n\r\n d\u00a0e  "),
]
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, n_words long, node long, "
    "window long, shard int, _text string, kept boolean, cluster long, url string"
)


def documents(spark, rows=TEXTS):
    """The rows with columns beside them whose names the operators use themselves."""
    full = [(i, t, "en" if (i or 0) % 2 else None, "src", len(t or ""), 7, 7, 7, 7, "x", True, 7, "u") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def groups(rows):
    """doc_id -> (set size, smallest linked doc_id), by an inverted index over all pairs."""
    parent, sets = {}, {}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def join(i, j):
        i, j = find(i), find(j)
        parent[max(i, j)] = min(i, j)

    holders, size = collections.defaultdict(list), {}
    for i, text in rows:
        if i is None:
            continue
        parent.setdefault(i, i)
        own = shingles(text)
        size[i] = len(own)
        for other in {j for s in own for j in holders[s]}:
            shared = len(own & sets[other])
            if 100 * shared >= 75 * (len(own) + len(sets[other]) - shared):
                join(i, other)
        sets[i] = own
        for s in own:
            holders[s].append(i)
    return {i: (size[i], find(i)) for i in parent}
