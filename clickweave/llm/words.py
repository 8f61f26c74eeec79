"""Words of Arrow text columns as numpy arrays: places, documents and 64-bit hashes.

A word is a run of bytes outside 0x20 and 0x09-0x0D.  Texts are worked on in
slices of about ``SLICE_BYTES`` (a longer text is a slice of its own), so that
temporary arrays stay small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (a bijection)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _constants(seed: int, n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed << 32))


@dataclass
class Words:
    """Words of the texts ``first .. first + n_docs`` of a column."""

    first: int
    n_docs: int
    data: np.ndarray     #: bytes of the slice (lower-cased if asked for)
    start: np.ndarray    #: first byte of each word, in the slice
    end: np.ndarray
    doc: np.ndarray      #: document of each word, from 0 within the slice
    offset: np.ndarray   #: first word of each document, n_docs + 1 entries

    def hashes(self, seed: int) -> np.ndarray:
        """One 64-bit hash per word: per-byte values times odd powers of a seeded base, summed and scrambled."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        longest = int(length.max())
        base = int(_constants(seed, 1)[0]) | 1
        power = np.cumprod(np.full(min(longest, 1 << 16), base, np.uint64))
        if longest > len(power):
            power = np.resize(power, longest)
            power[1 << 16:] += np.arange(longest - (1 << 16), dtype=np.uint64) * _U(2)
        inside = np.concatenate([[0], np.cumsum(length)])
        place = np.arange(inside[-1]) - np.repeat(inside[:-1], length)
        value = _constants(seed + 1, 256)[self.data[~_SEPARATOR[self.data]]] * power[place]
        return mix(np.add.reduceat(value, inside[:-1]) + length.astype(np.uint64) * _U(base))

    def strings(self) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[s:e] for s, e in zip(self.start.tolist(), self.end.tolist(), strict=True)]


def slices(texts: pa.Array, lower: bool = False) -> Iterator[Words]:
    """Words of a string column; null texts have none."""
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        texts, kind = texts.cast(pa.string()), np.int32
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, kind)[texts.offset:texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + SLICE_BYTES, "right")) - 1)
        j = min(j, n)
        part = raw[at[i]:at[j]]
        if lower:
            part = _LOWER[part]
        edge = at[i:j + 1] - at[i]
        word = ~_SEPARATOR[part]
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        inner = edge[1:-1]
        inner = inner[(inner > 0) & (inner < len(part))]
        begins[inner] = word[inner]
        ends[inner - 1] = word[inner - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        offset = np.searchsorted(start, edge)
        yield Words(i, j - i, part, start, end, np.repeat(np.arange(j - i), np.diff(offset)), offset)
        i = j


def windows(hashes: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hash of the k words from each word on (valid where k words follow in the document).

    Ordered sums with powers of an odd constant, built by doubling."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    c = int(_constants(seed, 1)[0]) | 1
    out, covered = np.zeros(n - k + 1, np.uint64), 0
    power, span = hashes, 1  # hash of `span` words from each place
    left = k
    while left:
        if left & 1:
            out = out * _U(pow(c, span, 1 << 64)) + power[covered:covered + n - k + 1]
            covered += span
        left >>= 1
        if left:
            power = power[:-span] * _U(pow(c, span, 1 << 64)) + power[span:]
            span *= 2
    return mix(out + _U(seed * 2 + 1))


def window_starts(words: Words, k: int) -> np.ndarray:
    """Places (word numbers) where k words of one document follow."""
    n = len(words.start)
    if n < k:
        return np.zeros(0, np.int64)
    return np.flatnonzero(words.doc[:n - k + 1] == words.doc[k - 1:])
