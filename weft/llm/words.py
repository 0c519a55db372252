"""64-bit hashes of all words of many texts at once, without a dictionary.

A word's hash is the polynomial of its bytes' random values, taken as a difference of prefix sums
modulo 2^64 and mixed, so the work is a few passes over the bytes whatever the vocabulary is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are worked on together; cut where a word ends.
CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(29).integers(1, 1 << 63, 256, np.uint64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def byte_set(signs: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(signs)] = True
    return out


#: The six blanks of ASCII; those and the separators that ``str.split`` takes for blanks too.
SIX_BLANKS, ALL_BLANKS = byte_set(b" \t\n\r\x0b\x0c"), byte_set(b" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f")


_WIDE_BLANKS = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def lower_text(text: str | None) -> bytes:
    """Lower case, with ASCII blanks only: split at ``ALL_BLANKS`` it gives the words of ``str.split``."""
    low = (text or "").lower()
    return (low if low.isascii() else _WIDE_BLANKS.sub(" ", low)).encode()


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, kept for a chunk's length."""
    if len(_POWERS[0]) >= n:
        return _POWERS
    with np.errstate(over="ignore"):
        out = [np.multiply.accumulate(np.append(np.uint64(1), np.full(n, b, np.uint64)), dtype=np.uint64) for b in (np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64)))]
    if n <= 2 * CHUNK_BYTES:
        _POWERS[:] = out
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """All bits of the numbers depend on all bits."""
    with np.errstate(over="ignore"):
        for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        return h ^ (h >> np.uint64(32))


def _chunk(data: np.ndarray, blank: np.ndarray, edge: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of the words of one chunk, which ends with a word or a blank."""
    empty = blank[data]
    step = np.flatnonzero(np.diff(np.concatenate([[True], empty, [True]])))
    start, end = step[0::2], step[1::2]
    if not len(start):
        return start, end, np.zeros(0, np.uint64)
    low, high = start, end
    if edge is not None:  # without the signs at both ends, unless the word has no others
        low, high = start.copy(), end.copy()
        at = np.flatnonzero(edge[data[start]] | edge[data[end - 1]])
        for _ in range(16):
            low[at] += edge[data[low[at]]]
            high[at] -= edge[data[high[at] - 1]] & (high[at] > low[at])
            at = at[(low[at] < high[at]) & (edge[data[np.minimum(low[at], len(data) - 1)]] | edge[data[high[at] - 1]])]
            if not len(at):
                break
        if len(at):  # long runs of such signs
            inner = np.flatnonzero(~(edge[data] | empty))
            first, last = np.searchsorted(inner, start[at]), np.searchsorted(inner, end[at]) - 1
            some = last >= first
            low[at[some]], high[at[some]] = inner[first[some]], inner[last[some]] + 1
            low[at[~some]] = high[at[~some]]
        none = low >= high
        low[none], high[none] = start[none], end[none]
    power, inverse = _powers(len(data))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * power[: len(data)], out=sums[1:])
        h = (sums[high] - sums[low]) * inverse[low] + (high - low).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    return start, end, mixed(h)


def find_words(texts: list[bytes], blank: np.ndarray = SIX_BLANKS, edge: np.ndarray | None = None) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one, start, end and hash of its words, and the number of words of each text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    whole = b"\n".join(texts)
    data = np.frombuffer(whole, np.uint8)
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK_BYTES)
        while end < len(data):  # back to the last blank, or on to the next one behind a word longer than a chunk
            gaps = np.flatnonzero(blank[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(len(data), end + CHUNK_BYTES)
        start, stop, h = _chunk(data[at:end], blank, edge)
        parts.append((start + at, stop + at, h))
        at = end
    start, stop, h = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    bounds = np.append(0, np.cumsum(sizes + 1))
    return whole, start, stop, h, np.diff(np.searchsorted(start, bounds))


def hash_words(texts: list[bytes], blank: np.ndarray = SIX_BLANKS, edge: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one after the other, and the number of words of each text."""
    _, _, _, hashes, counts = find_words(texts, blank, edge)
    return hashes, counts


class Places:
    """Numbers of hashes in the order in which they came: two sorted arrays, 16 bytes a hash and no objects."""

    def __init__(self):
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each hash, -1 for those that are new."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], -1)

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of new, distinct hashes."""
        numbers = np.arange(len(self), len(self) + len(hashes))
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes, self.numbers = np.insert(self.hashes, at, hashes[order]), np.insert(self.numbers, at, numbers[order])
        return numbers


def parts_of(column: pa.Array, rows: int = 1000) -> Iterator[list[str | None]]:
    """Texts of a batch, some at a time."""
    for lo in range(0, len(column), rows):
        yield column.slice(lo, rows).to_pylist()


def slices(sizes: list[int], limit: int) -> list[tuple[int, int]]:
    """Neighbouring items of about ``limit`` together; one at least."""
    out, lo = [], 0
    while lo < len(sizes):
        hi, total = lo, 0
        while hi < len(sizes) and (hi == lo or total + sizes[hi] <= limit):
            total += sizes[hi]
            hi += 1
        out.append((lo, hi))
        lo = hi
    return out
