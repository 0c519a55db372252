"""Sorted runs of byte strings: front coding, and a k-way merge that knows common prefixes.

A run is stored front-coded: each string as the length it shares with the one before it and
the bytes after that. The merge is a loser tree whose nodes keep the length that a candidate
shares with the last string put out; two candidates are compared from there on only, so no
byte of a known common prefix is read twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

#: Keys that the driver sorts itself.
FEW_KEYS = 20_000


def cut_keys(keys: DataFrame, parts: int) -> list[bytes]:
    """``parts`` - 1 keys in order that cut the rows of ``keys`` (one binary column) into parts of equal size; a key
    that fills several parts is there several times. A sample beyond ``FEW_KEYS`` is sorted by the executors; the driver gets the cuts only."""
    if parts < 2:
        return []
    n = keys.count()
    if n <= FEW_KEYS:
        rows = sorted(bytes(r[0]) for r in keys.collect())
        found = [rows[n * j // parts] for j in range(1, parts)] if rows else []
    else:
        places = {n * j // parts for j in range(1, parts)}
        found = keys.orderBy(keys.columns[0]).rdd.zipWithIndex().filter(lambda x: x[1] in places).map(lambda x: bytes(x[0][0])).collect()
    return sorted(found)


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix; the first ``known`` bytes are known to agree."""
    n = min(len(a), len(b))
    if n <= known:
        return n
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_code(strings: list[bytes]) -> bytes:
    """One blob for a sorted list: count, shared lengths, own lengths, then the own bytes."""
    shared, own, before = np.zeros(len(strings), "<u4"), [], b""
    for i, s in enumerate(strings):
        shared[i] = k = common_prefix(before, s)
        own.append(s[k:])
        before = s
    sizes = np.fromiter(map(len, own), "<u4", len(own))
    return np.uint32(len(strings)).tobytes() + shared.tobytes() + sizes.tobytes() + b"".join(own)


def front_decode(blob: bytes) -> Iterator[tuple[bytes, int]]:
    """Each string with the length that it shares with the one before it."""
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    shared = np.frombuffer(blob, "<u4", n, 4).tolist()
    sizes = np.frombuffer(blob, "<u4", n, 4 + 4 * n).tolist()
    at, before = 4 + 8 * n, b""
    for k, size in zip(shared, sizes):
        before = before[:k] + blob[at : at + size]
        at += size
        yield before, k


def loser_tree_merge(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[int, bytes, int]]:
    """Merge sorted runs of (string, length shared with the one before it in the run).

    Yields run number, string and the length shared with the string yielded before. Equal
    strings come in the order of their runs."""
    k = 1
    while k < max(1, len(runs)):
        k *= 2
    heads: list[bytes | None] = [None] * k
    lcps = [0] * k
    for r, run in enumerate(runs):
        heads[r] = next(run, (None, 0))[0]

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's length is then relative to the winner."""
        x, y = heads[a], heads[b]
        if x is None:
            return (b, a) if y is not None or b < a else (a, b)
        if y is None:
            return a, b
        p, q = lcps[a], lcps[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        m = common_prefix(x, y, p)
        if len(x) == m and len(y) == m:
            first = a < b
        elif len(x) == m or len(y) == m:
            first = len(x) == m
        else:
            first = x[m] < y[m]
        if first:
            lcps[b] = m
            return a, b
        lcps[a] = m
        return b, a

    losers = [0] * k
    winners = [0] * (2 * k)
    for r in range(k):
        winners[k + r] = r
    for node in range(k - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    top = winners[1] if k > 1 else 0
    while heads[top] is not None:
        yield top, heads[top], lcps[top]
        heads[top], lcps[top] = next(runs[top], (None, 0))
        node = (k + top) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2
