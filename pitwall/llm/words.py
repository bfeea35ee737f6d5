"""Words of whole texts as 64-bit hashes, vectorised over Arrow text columns.

A word is a maximal run of word bytes. Two classes exist: ``SPACED`` (all bytes but space and 0x09-0x0D) and
``ALNUM`` (digits, ASCII letters and every byte of 0x80 and above); both are defined on single bytes, so UTF-8
needs no decoding. Lower-casing changes A-Z only. Word identity is a 64-bit polynomial hash over random byte
values: two different words of one corpus of 10^12 distinct words collide with a chance below 10^-19 per pair.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SPACED = np.ones(256, dtype=bool)
SPACED[list(SPACES)] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_rng = np.random.Generator(np.random.PCG64(20240917))
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _VALUES.copy()
_LOWER[0x41:0x5B] = _VALUES[0x61:0x7B]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEGMENT = 1 << 18
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, _SEGMENT), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) <= 4 * _SEGMENT:  # a longer one (a single word of megabytes) is not kept
            _powers[base] = have
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that every bit of a sum counts."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    hash: np.ndarray    # uint64 of each word
    start: np.ndarray   # its first byte in data
    end: np.ndarray     # and the byte after its last
    first: np.ndarray   # of each text, its first word; one more at the end
    data: np.ndarray    # uint8

    def of(self, i: int) -> slice:
        return slice(int(self.first[i]), int(self.first[i + 1]))

    def text(self, k: int) -> bytes:
        return self.data[self.start[k]:self.end[k]].tobytes()

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    body = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, offsets - offsets[0]


def words(column: pa.Array, kind: np.ndarray = SPACED, lower: bool = True) -> Words:
    """The words of every text of ``column``."""
    data, offsets = raw(column)
    inside = kind[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    before[edges] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    value = _LOWER if lower else _VALUES
    out = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):  # segments bound the memory, whatever the text's length
        to = max(at + 1, int(np.searchsorted(end, start[at] + _SEGMENT, side="right")))
        low, high = int(start[at]), int(end[to - 1])
        terms = value[data[low:high]]
        terms *= powers(_BASE, high - low)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
        s, e = start[at:to] - low, end[at:to] - low
        out[at:to] = (sums[e] - sums[s]) * powers(_INVERSE, high - low)[s]
        at = to
    return Words(mixed(out), start, end, np.searchsorted(start, offsets, side="left"), data)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive words; empty when there are fewer."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(size, dtype=np.uint64)
    for k, p in enumerate(powers(_BASE, n)):
        out += hashes[k:k + size] * p
    return mixed(out)


def rows_of(first: np.ndarray) -> np.ndarray:
    """For every word, the index of its text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
