"""Words of whole Arrow text columns as numpy arrays: where they are, and a 64-bit hash of each.

The bytes of a column are looked at together, in slices of whole texts, so the Python cost is per slice
and not per word. Two different words have the same hash with a chance of 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes, and texts, looked at together; a longer text is a slice of its own.
SLICE, ROWS = 1 << 19, 512
BASE = np.uint64(0x9E3779B97F4A7C15)
GRAM = np.uint64(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Which bytes make words: all but space and 0x09-0x0D; and the word bytes of the licence contract,
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
NOT_NEWLINE = np.ones(256, bool)
NOT_NEWLINE[0x0A] = False


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass
class Texts:
    """Whole texts lying one after the other: text i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def per_text(self, at_byte: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        total = np.concatenate(([0], np.cumsum(at_byte, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


@dataclass
class Spans:
    """Maximal runs of marked bytes, none across two texts."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def per_text(self, n: int) -> np.ndarray:
        return np.bincount(self.text, minlength=n)


def slices(column: pa.Array, size: int = SLICE) -> Iterator[Texts]:
    """The texts of a string column in slices of at most ROWS texts and about ``size`` bytes; null is
    empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    for at in range(0, len(column), ROWS):
        some = pc.fill_null(column.slice(at, ROWS).cast(pa.large_string()), "")
        n = len(some)
        _, offsets, data = some.buffers()
        offsets = np.frombuffer(offsets, np.int64)[some.offset : some.offset + n + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
            yield Texts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            i = j


def spans(texts: Texts, marked: np.ndarray) -> Spans:
    """``marked`` tells for each byte of the texts whether it belongs to a run."""
    edge = np.zeros(len(marked) + 1, bool)
    edge[texts.offsets] = True
    before, after = np.zeros(len(marked), bool), np.zeros(len(marked), bool)
    before[1:] = marked[:-1] & ~edge[1:-1]
    after[:-1] = marked[1:] & ~edge[1:-1]
    start = np.flatnonzero(marked & ~before)
    end = np.flatnonzero(marked & ~after) + 1
    return Spans(start, end, np.searchsorted(texts.offsets, start, "right") - 1)


def span_hashes(data: np.ndarray, found: Spans) -> np.ndarray:
    """A hash of the bytes of each span."""
    if not len(found):
        return np.zeros(0, np.uint64)
    length = found.end - found.start
    power = np.cumprod(np.full(int(length.max()), BASE))
    total = np.concatenate(([0], np.cumsum(length)))
    place = np.arange(total[-1]) - np.repeat(total[:-1], length)
    byte = data[place + np.repeat(found.start, length)].astype(np.uint64) + np.uint64(1)
    sums = np.add.reduceat(byte * power[place], total[:-1])
    return mixed(sums ^ (length.astype(np.uint64) << np.uint64(48)))


def gram_hashes(hashes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n`` consecutive words from each word on that has them in its text, and the
    numbers of these words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :])
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        total = total * GRAM + hashes[k : len(hashes) - n + 1 + k]
    return mixed(total[at]), at


def repeated(keys: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two marks per key: whether its text holds it twice or more, and whether it held it before."""
    again, before = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    if len(keys) > 1:
        own = keys ^ mixed(text.astype(np.uint64) + np.uint64(1))
        order = np.argsort(own, kind="stable")
        same = own[order][1:] == own[order][:-1]
        again[order[1:][same]] = again[order[:-1][same]] = True
        before[order[1:][same]] = True
    return again, before
