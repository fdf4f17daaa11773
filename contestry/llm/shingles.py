"""Word and shingle hashes of Arrow text columns, computed with numpy over whole batches.

A word is a run of bytes other than the six ASCII white-space characters; A-Z count as a-z. Its hash is
a polynomial over a random value for each byte, modulo 2^64, read off running sums, then scrambled with
its length. A document's set holds its distinct shingles of k words; fewer words form one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes whose running sums are in memory at a time; a longer word stretches it.
SLAB = 2 << 20
_random = np.random.default_rng(20_240_607)
BYTE = _random.integers(1, 1 << 63, 256, np.uint64, endpoint=True) * np.uint64(2) + np.uint64(1)
BYTE[65:91] = BYTE[97:123]
IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
BASE = np.uint64(0xD1342543DE82EF95)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """The first n powers of BASE and of its inverse."""
    if len(_powers[0]) < n:
        for i, base in enumerate((BASE, INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def word_hashes(data: np.ndarray, starts_of_docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, last byte) of every word of data; a document's start ends a word as white space does."""
    solid = ~IS_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    at = starts_of_docs[(starts_of_docs > 0) & (starts_of_docs < len(data))]
    begins[at] = solid[at]
    first = np.flatnonzero(begins)
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | begins[1:]
    last = np.flatnonzero(ends)
    out = np.empty(len(first), np.uint64)
    done = 0
    while done < len(first):
        start = first[done]
        upto = max(int(np.searchsorted(last, start + SLAB, side="left")), done + 1)
        stop = int(last[upto - 1]) + 1
        power, inverse = powers(stop - start)
        sums = np.cumsum(BYTE[data[start:stop]] * power[: stop - start], dtype=np.uint64)
        a, b = first[done:upto] - start, last[done:upto] - start
        before = np.where(a > 0, sums[a - 1], np.uint64(0))
        out[done:upto] = (sums[b] - before) * inverse[a] + (b - a + 1).astype(np.uint64)
        done = upto
    return scrambled(out), first, last


@dataclass
class Sets:
    """Sorted distinct tokens of documents, one after the other; document i has tokens[offsets[i]:offsets[i+1]]."""

    tokens: np.ndarray
    offsets: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def part(self, a: int, b: int) -> Sets:
        return Sets(self.tokens[self.offsets[a] : self.offsets[b]], self.offsets[a : b + 1] - self.offsets[a])


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of a string column; a null is empty."""
    text = text.cast(pa.large_string())
    if text.null_count:
        text = text.fill_null("")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def shingle_sets(text: pa.Array, words: int = 5) -> Sets:
    data, offsets = text_bytes(text)
    hashes, first, _ = word_hashes(data, offsets[:-1])
    of = np.searchsorted(first, offsets)
    n = np.diff(of)
    odd = scrambled(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    sums = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for i in range(words):
        sums += hashes[i : i + len(sums)] * odd[i]
    sums = scrambled(sums + np.uint64(words))
    room = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    ends = np.cumsum(room)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    for i, (a, k, stop, size) in enumerate(zip(of.tolist(), n.tolist(), ends.tolist(), room.tolist())):
        if k >= words:
            part = out[stop - size : stop]
            part[:] = sums[a : a + size]
            part.sort()
        elif k:
            out[stop - 1] = scrambled((hashes[a : a + k] * odd[:k]).sum(dtype=np.uint64, keepdims=True) + np.uint64(k))[0]
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[(ends - room)[room > 0]] = True
    sizes = np.add.reduceat(fresh, (ends - room)[room > 0], dtype=np.int64) if len(out) else np.empty(0, np.int64)
    found = np.zeros(len(n), np.int64)
    found[room > 0] = sizes
    return Sets(out[fresh], np.concatenate([[0], np.cumsum(found)]))


def slices(column: pa.Array, most: int = SLAB) -> Iterator[tuple[int, int]]:
    """Stretches of rows with about `most` bytes of text; a longer text is one of its own."""
    _, offsets = text_bytes(column)
    at = 0
    while at < len(column):
        stop = max(int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1, at + 1)
        yield at, stop
        at = stop
