"""BPE by a contiguous array of ranks: ids of whole texts under a tokenizer's merges, and texts from ids.

A text is cut at the added tokens, then into pre-tokens by the file's own pre-tokenizer. A short pre-token's
part boundaries, the tokens of its parts and the ranks of adjacent pairs lie in three arrays. The ranks are
scanned for their minimum, the leftmost of equal ones; the boundary inside that pair is deleted and the
ranks of the two pairs that touch the new part are looked up again, until no pair has a rank.

A scan per merge is quadratic, so a pre-token over ``SHORT`` bytes takes all places of the minimum in one
scan: a merge only makes pairs of later merges (checked for the file), so the pairs of one rank can be
merged together, from the left, and there are at most as many scans as different merges.

Pieces of text between single spaces are encoded once per worker and remembered within a bound of bytes. No
pre-token reaches across a space that stands between two characters that are none, so pieces are cut there.

Defined results: null and empty texts have no ids and give back the empty text; an empty table gives no
rows; texts of any length are encoded whole; repeated rows and null ids are rows of their own, and equal
texts get equal results; only the columns asked for are read. The string of an added token in a text is
that token, as in the library's default. Memory beyond the remembered pieces grows with the longest text
and, inside the pre-tokenizer, with its longest stretch without white space.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from landgate.llm.batches import in_groups, measured
from landgate.llm.memory import Memory
from landgate.llm.tables import table

#: Bytes that a worker remembers for good, and for a while; of pieces, and as much of pre-tokens.
REMEMBERED, RECENT = 80 << 20, 16 << 20
#: Pieces given to the pre-tokenizer in one string.
JOINED = 512
#: The longest pre-token that is merged one boundary at a time.
SHORT = 128
SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"
#: What keeps a text from being cut at every space: white space other than a newline or a single space.
ODD_SPACE = re.compile(r" (?=\s|$)|[\0\x1c-\x1f]|[^\S \n]")
BETWEEN = re.compile(r"(?<=\S)(?= \S)")
#: The rank of a pair that never merges.
NONE = 1 << 62
NEVER = itertools.repeat(NONE)


def byte_of_sign() -> dict[str, int]:
    """The byte behind each sign of a byte-level vocabulary: visible Latin-1 stands for itself, the other
    bytes, in order, for the signs from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in visible]
    return {**{chr(b): b for b in visible}, **{chr(256 + k): b for k, b in enumerate(others)}}


class Merges:
    """Ranks of pairs of tokens, and the token that each rank's pair becomes."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.token = vocabulary
        self.base = max(vocabulary.values()) + 1
        made = [vocabulary[a + b] for a, b in pairs]
        self.made = np.array(made, np.int64)
        keys = [vocabulary[a] * self.base + vocabulary[b] for a, b in pairs]
        self.rank_of = {(vocabulary[a], vocabulary[b]): rank for rank, (a, b) in enumerate(pairs)}
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys, self.ranks = np.array(keys, np.int64)[order], order
        self.made_list = made
        first = {}
        for rank, token in enumerate(made):
            first.setdefault(token, rank)
        self.in_order = len(first) == len(made) and all(
            first.get(vocabulary[side], -1) < rank for rank, pair in enumerate(pairs) for side in pair
        )

    def merged(self, word: str) -> list[int]:
        """Tokens of a pre-token, which is given in the signs of the vocabulary."""
        if len(word) <= SHORT or not self.in_order:
            return self.one_at_a_time(word)[0]
        return self.all_of_a_rank(word)

    def one_at_a_time(self, word: str) -> tuple[list[int], list[int]]:
        """The tokens of the parts, and the boundaries at which they start."""
        rank_of, made = self.rank_of.get, self.made_list
        token = list(map(self.token.__getitem__, word))
        boundary = list(range(len(word)))
        rank = list(map(rank_of, itertools.pairwise(token), NEVER))
        while rank and (least := min(rank)) != NONE:
            i = rank.index(least)
            token[i] = made[least]
            del token[i + 1], boundary[i + 1], rank[i]
            if i < len(rank):
                rank[i] = rank_of((token[i], token[i + 1]), NONE)
            if i:
                rank[i - 1] = rank_of((token[i - 1], token[i]), NONE)
        return token, boundary

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        return np.where(self.keys[at] == key, self.ranks[at], NONE) if len(self.keys) else np.full(len(key), NONE)

    def all_of_a_rank(self, word: str) -> list[int]:
        token = np.array([self.token[sign] for sign in word], np.int64)
        rank = self._ranks(token[:-1], token[1:])
        while len(rank) and (least := rank.min()) != NONE:
            at = np.flatnonzero(rank == least)
            # Of pairs that overlap, as in "aaa", every second one from the left of their run.
            run = np.concatenate(([0], np.cumsum(np.diff(at) != 1)))
            at = at[(np.arange(len(at)) - np.flatnonzero(np.r_[True, np.diff(run) > 0])[run]) % 2 == 0]
            token[at] = self.made[least]
            keep = np.ones(len(token), bool)
            keep[at + 1] = False
            token, rank = token[keep], rank[keep[1:]]
            new = at - np.arange(len(at))
            touched = np.unique(np.concatenate((new[new < len(rank)], new[new > 0] - 1)))
            rank[touched] = self._ranks(token[touched], token[touched + 1])
        return token.tolist()


class Codec:
    """A tokenizer file, read once for each worker process."""

    def __init__(self, path: str):
        content = json.load(open(path, encoding="utf-8"))
        model, before = content["model"], content["pre_tokenizer"] or {}
        unusual = [k for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "dropout") if model.get(k)]
        if model["type"] != "BPE" or unusual or model.get("ignore_merges") or content["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level BPE: {unusual or model['type']}")
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex"):
            raise ValueError(f"{path} does not cut texts as byte-level files do: {before}")
        added = content["added_tokens"]
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} has added tokens that take in their surroundings")
        self.merges = Merges(model["vocab"], model["merges"])
        self.added = {t["content"]: t["id"] for t in added}
        strings = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.mark = re.compile(f"({'|'.join(strings)})") if strings else None
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        sign = byte_of_sign()
        self.bytes_of = {i: bytes(map(sign.__getitem__, t)) for t, i in model["vocab"].items() if t not in self.added}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        self.decimal = {i: str(i) for i in self.bytes_of}
        self.known_pieces = Memory(REMEMBERED, RECENT)
        self.known_words = Memory(REMEMBERED, RECENT)

    def _pieces(self, text: str) -> list[str]:
        """Pieces of a text, none of which a pre-token or an added token crosses; added ones alone."""
        if self.mark is not None and any(t in text for t in self.added):
            parts = self.mark.split(text)
            return [p for k, part in enumerate(parts) for p in ([part] if k % 2 else self._spaced(part))]
        return self._spaced(text)

    @staticmethod
    def _spaced(text: str) -> list[str]:
        if ODD_SPACE.search(text):
            return BETWEEN.split(text)
        return text.replace(" ", "\0 ").split("\0")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian 32-bit numbers."""
        pieces = list(map(self._pieces, texts))
        known, words = self.known_pieces, self.known_words
        known.forget()
        words.forget()
        new = set().union(*pieces) - known.keys()
        for piece in new & self.added.keys():
            known.add(piece, array("I", [self.added[piece]]).tobytes())
        # A piece that starts with the space before a word can stand behind any other.
        led = [p for p in new if len(p) > 1 and p[0] == " " and not p[1].isspace()]
        alone = [[p] for p in new.difference(led, self.added)]
        for some in [led[i : i + JOINED] for i in range(0, len(led), JOINED)] + alone:
            cut = iter(self.cut("".join(some)))
            end = 0
            for piece in some:
                end += len(piece)
                ids, at = [], end - len(piece)
                while at < end:
                    word, (_, at) = next(cut)
                    own = words.get(word)
                    if own is None:
                        own = array("I", self.merges.merged(word)).tobytes()
                        words.add(word, own)
                    ids.append(own)
                known.add(piece, b"".join(ids))
        return [b"".join(map(known.__getitem__, own)) for own in pieces]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encoded(docs: DataFrame, tokenizer: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and (ids, decoded): the ids of every text, and the text that they give back."""

    def run(column: pa.Array) -> dict:
        own = codec(tokenizer)
        ids = [np.frombuffer(x, "<u4").astype(np.int32) for some in in_groups(column) for x in own.encode(some)]
        return {"ids": ids, "decoded": [own.decode(x.tolist()) for x in ids]}

    return measured(docs, run, "ids array<int>, decoded string", keep=keep)


def digests(docs: DataFrame, tokenizer: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and (n_tokens, ids_sha256, decoded_sha256) of every text."""

    def run(column: pa.Array) -> dict:
        own, out = codec(tokenizer), {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for packed in itertools.chain.from_iterable(map(own.encode, in_groups(column))):
            ids = np.frombuffer(packed, "<u4").tolist()
            shown = ",".join(map(own.decimal.__getitem__, ids))
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(shown.encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
        return out

    return measured(docs, run, SCHEMA, keep=keep)


def op11_rank_array_bpe(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op11_rank_array_bpe": (op11_rank_array_bpe, None)}
