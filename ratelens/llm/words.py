"""Words of texts as arrays of hashes, straight from Arrow's buffers.

A word is a run of bytes other than 0x20 and 0x09-0x0D; A-Z count as a-z. Texts are taken in chunks
of about a million bytes, a longer text alone, so memory is bounded by the longest text. Nulls are
texts without words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TRIM = np.zeros(256, bool)
_TRIM[[ord(c) for c in "\"'()[]{}<>.,;:!?*#$%&|"]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
_OF_BYTE = mixed((LOWER.astype(np.uint64) + np.uint64(1)) * _STEP)
_powers: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's step and of its inverse, for at least n places."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 2))
        for name, step in (("up", _STEP), ("down", _BACK)):
            table = np.full(size, step, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


@dataclass
class Words:
    """Words of consecutive rows. ``first[i]:first[i + 1]`` are the words of row ``rows.start + i``."""

    rows: slice
    data: np.ndarray      # the bytes of the texts
    begin: np.ndarray     # of each word, in ``data``
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash for each word; equal words have equal hashes."""
        if not len(self.begin):
            return np.zeros(0, np.uint64)
        up, down = _tables(len(self.data))
        sums = np.cumsum(_OF_BYTE[self.data] * up[:len(self.data)], dtype=np.uint64)
        before = np.where(self.begin > 0, sums[np.maximum(self.begin, 1) - 1], np.uint64(0))
        lengths = (self.end - self.begin).astype(np.uint64)
        return mixed((sums[self.end - 1] - before) * down[self.begin] + lengths)


def trimmed(words: Words) -> Words:
    """Words without punctuation at their ends; of one that is nothing else a character stays."""
    begin, end = words.begin.copy(), words.end.copy()
    for edge, step, at in ((begin, 1, 0), (end, -1, -1)):
        rest = np.arange(len(begin))
        while len(rest):
            rest = rest[(end[rest] - begin[rest] > 1) & _TRIM[words.data[edge[rest] + at]]]
            edge[rest] += step
    return Words(words.rows, words.data, begin, end, words.first)


def words_of(texts: pa.Array, between: np.ndarray = SPACE) -> Iterator[Words]:
    """The words of an Arrow column of strings, chunk by chunk; ``between`` tells which bytes part them."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    every = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        after = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1
        after = min(max(after, row + 1), len(texts))
        data = every[offsets[row]:offsets[after]]
        bounds = offsets[row:after + 1] - offsets[row]
        space = between[data]
        filled = bounds[:-1][np.diff(bounds) > 0]
        opens = np.ones(len(data), bool)
        opens[1:] = space[:-1]
        opens[filled] = True
        closes = np.ones(len(data), bool)
        closes[:-1] = space[1:]
        closes[bounds[1:][np.diff(bounds) > 0] - 1] = True
        begin = np.flatnonzero(opens & ~space)
        end = np.flatnonzero(closes & ~space) + 1
        yield Words(slice(row, after), data, begin, end, np.searchsorted(begin, bounds))
        row = after


def shingles_of(words: Words, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct hashes of its k-word shingles; a shorter text is one shingle."""
    if not len(words.begin):
        for row in range(words.rows.start, words.rows.stop):
            yield row, np.zeros(0, np.uint64)
        return
    hashes = words.hashes()
    whole = np.zeros(max(len(hashes) - k + 1, 0), np.uint64)
    for i in range(k):
        whole = whole * _STEP + hashes[i:i + len(whole)]
    whole = mixed(whole)
    for i, row in enumerate(range(words.rows.start, words.rows.stop)):
        a, b = words.first[i], words.first[i + 1]
        if b - a >= k:
            yield row, np.unique(whole[a:b - k + 1])
        elif b > a:
            one = np.array([b - a], np.uint64)
            for h in hashes[a:b]:
                one = one * _STEP + h
            yield row, mixed(one)
        else:
            yield row, np.zeros(0, np.uint64)
