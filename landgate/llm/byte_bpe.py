"""Byte-level BPE: ids of whole texts, and the bytes that ids stand for.

A text is cut into pre-tokens by the vocabulary's pattern. Two tiers give a pre-token its ids:

1. A minimal perfect hash over the vocabulary (hash and displace: n keys, n places, one small number per
   bucket) finds whole pre-tokens that are tokens; the place's bytes are compared, so it never errs.
2. For the others a heap holds the adjacent pairs of a linked list of byte runs; the pair whose joined
   bytes have the lowest rank, the leftmost of equal ones, is joined until no pair is a token.

Distinct pieces of text between single spaces are encoded once per worker and remembered up to a bound of bytes.

Defined results: null and empty texts have no ids; every byte is a token, so all bytes of a text come back
from its ids; texts of any length are encoded whole; equal rows get equal results.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from landgate.llm import words as W
from landgate.llm.batches import in_groups, measured
from landgate.llm.memory import Memory
from landgate.llm.tables import table

#: Bytes that a worker remembers for good, and for a while; of pieces, and as much of pre-tokens.
REMEMBERED, RECENT = 120 << 20, 24 << 20
BUCKET = 4
#: Displacements tried at once while the hash is built.
TRIED = 512
SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"
#: White space that is not a single space before a word or a newline, and the mark of a cut.
ODD_SPACE = re.compile(r" (?=\s|$)|[\0\x1c-\x1f]|[^\S \n]")


def key_hashes(keys: list[bytes]) -> np.ndarray:
    length = np.fromiter(map(len, keys), np.int64, len(keys))
    end = np.cumsum(length)
    data = np.frombuffer(b"".join(keys), np.uint8)
    return W.span_hashes(data, W.Spans(end - length, end, np.arange(len(keys))))


class PerfectHash:
    """n places for n keys: place = (h + displacement of h's bucket) scrambled, modulo n."""

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.buckets = max(1, self.n // BUCKET)
        hashes = key_hashes(keys)
        self.displacement = np.zeros(self.buckets, np.uint64)
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        sizes = np.diff(starts)
        free = np.ones(self.n, bool)
        self.key_at = np.zeros(self.n, np.int64)
        for b in np.argsort(-sizes, kind="stable"):
            own = order[starts[b] : starts[b + 1]]
            if not len(own):
                break
            tried = np.uint64(0)
            while True:
                d = tried + np.arange(TRIED, dtype=np.uint64)
                places = self._places(hashes[own][None, :], d[:, None])
                fits = free[places].all(axis=1)
                if len(own) > 1:
                    in_order = np.sort(places, axis=1)
                    fits &= (in_order[:, 1:] != in_order[:, :-1]).all(axis=1)
                if fits.any():
                    k = int(fits.argmax())
                    self.displacement[b] = d[k]
                    free[places[k]] = False
                    self.key_at[places[k]] = own
                    break
                tried += np.uint64(TRIED)

    def _places(self, hashes: np.ndarray, displacement: np.ndarray) -> np.ndarray:
        scrambled = W.mixed(hashes ^ (displacement * W.GRAM + W.BASE))
        return (scrambled % np.uint64(self.n)).astype(np.int64)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """For each of ``keys`` the number of the only key of the hash that it can equal."""
        hashes = key_hashes(keys)
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        return self.key_at[self._places(hashes, self.displacement[bucket])]


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token: join the adjacent runs of lowest rank, leftmost first, until none is a token."""
    n = len(word)
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    rank = ranks.get
    heap = []
    for i in range(n - 1):
        r = rank(word[i : i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, j = heapq.heappop(heap)
        middle = end[i]
        if middle <= i or middle >= n or end[middle] != j:
            continue
        end[i], end[middle] = j, 0
        if j < n:
            before[j] = i
            r = rank(word[i : end[j]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[j]))
        left = before[i]
        if left >= 0:
            r = rank(word[left:j])
            if r is not None:
                heapq.heappush(heap, (r, left, j))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : end[i]]])
        i = end[i]
    return ids


class Codec:
    """The ranks of a vocabulary file, one for each worker process."""

    def __init__(self, path: str, pattern: str):
        lines = map(bytes.split, open(path, "rb"))
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = list(self.ranks)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.whole = PerfectHash(self.tokens)
        self.cut = regex.compile(pattern).findall
        self.known_pieces = Memory(REMEMBERED, RECENT)
        self.known_words = Memory(REMEMBERED, RECENT)

    def _learn_words(self, words: set[str]) -> None:
        self.known_words.forget()
        new = list(words - self.known_words.keys())
        if not new:
            return
        keys = [w.encode() for w in new]
        for word, key, at in zip(new, keys, self.whole.find(keys).tolist(), strict=True):
            token = self.tokens[at]
            ids = [self.ranks[token]] if token == key else merged(key, self.ranks)
            self.known_words.add(word, np.array(ids, "<u4").tobytes())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian 32-bit numbers.

        A text whose only white space is single spaces before words, and newlines, is cut at the spaces
        first: the pattern never joins what lies on both sides of such a space.
        """
        pieces: list[list[str]] = []
        for text in texts:
            if ODD_SPACE.search(text):
                pieces.append(self.cut(text))
            else:
                pieces.append(text.replace(" ", "\0 ").split("\0"))
        self.known_pieces.forget()
        new = set().union(*pieces) - self.known_pieces.keys()
        cut = {piece: self.cut(piece) for piece in new}
        self._learn_words(set().union(*cut.values()))
        word = self.known_words.__getitem__
        for piece, words in cut.items():
            self.known_pieces.add(piece, b"".join(map(word, words)))
        known = self.known_pieces.__getitem__
        return [b"".join(map(known, own)) for own in pieces]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encoded(docs: DataFrame, ranks: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and (ids, decoded): the ids of every text and the text that they give back."""

    def run(column: pa.Array) -> dict:
        own = codec(ranks, pattern)
        ids = [x for some in in_groups(column) for x in own.encode(some)]
        return {
            "ids": [np.frombuffer(x, "<u4").astype(np.int32) for x in ids],
            "decoded": [own.decode(x) for x in ids],
        }

    return measured(docs, run, "ids array<int>, decoded binary", keep=keep)


def digests(docs: DataFrame, ranks: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and (n_tokens, ids_sha256, decoded_sha256) of every text."""

    def run(column: pa.Array) -> dict:
        own, out = codec(ranks, pattern), {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for some in in_groups(column):
            for ids in own.encode(some):
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(own.decode(ids)).hexdigest())
        return out

    return measured(docs, run, SCHEMA, keep=keep)


def op10_two_tier_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


QUERIES = {"op10_two_tier_bpe": (op10_two_tier_bpe, None)}
