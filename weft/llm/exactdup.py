"""Exact repeats of long byte strings: a distributed merge sort of suffixes.

Each window of ``LENGTH`` bytes has an anchor: the place of its ``GRAM`` bytes with the smallest
hash, the first of equals. Equal windows have their anchors at the same offset, and an anchor serves a
stretch of neighbouring windows, so only the suffixes at anchors (about one in forty) are sorted,
each with the bytes on its left that its windows reach.

1. Tasks sort the suffixes of some megabytes of text. Equal stretches of a run are one from there on,
   the earliest stays. A run is front-coded (length shared with the suffix before, then the rest)
   and cut at splitters, which never part suffixes that share their first ``GRAM`` bytes.
2. Each range merges its pieces of all runs with a loser tree that carries common prefixes and
   starts every comparison behind them; suffixes whose ``GRAM`` bytes come once are left out first.
3. In merged order, the suffixes that share the right part of a window are neighbours, and those that
   share its left part are neighbours in the order of the reversed left sides. So for each offset
   of the anchor in the window, pairs of neighbourhood numbers name the distinct windows; all but
   the earliest of each are repeated.

A range holds about ``RANGE_BYTES`` of text. Suffixes whose ``GRAM`` bytes would fill several ranges (the two ends of
a passage that very many documents quote between different words) take another way: each run gives every one of
their windows once, under a 128-bit hash that deals them over all ranges, and all but the earliest are repeated.

Edge cases. A null text is empty; texts under ``LENGTH`` bytes stay whole. A null id counts as larger
than any other. Rows equal in id and text are one document, given for each row; rows that share only the
id are told apart by their text. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.runs import cut_keys, loser_tree_merge
from weft.llm.words import mixed
from weft.scratch import Scratch

LENGTH, GRAM = 100, 20
RUN_BYTES, RANGE_BYTES, RANGE_SAMPLES, RUN_LEVEL = 6 << 20, 12 << 20, 64, 3
#: Repeats inside a run cross the exchange in pieces of so many rows.
REPEAT_ROWS = 8192
#: Grams that fill more ranges than that are dealt out window by window.
HOT_RANGES = 2
#: Documents longer than this are worked on in overlapping parts.
PART_BYTES = 4 << 20
LEFT = LENGTH - GRAM
_NO_ID = (1 << 63) - 1


def plain_bytes(text: str | None) -> bytes:
    """UTF-8 with byte 0 as 255, which UTF-8 never uses: padding with 0 is then no text."""
    return (text or "").encode().replace(b"\0", b"\xff")


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes at every place, from hashes of 1, 2, 4, ... bytes."""
    factor = np.uint64(0x9E3779B97F4A7C15)
    part, size, out, done, rest = np.random.default_rng(17).integers(1, 1 << 63, 256, np.uint64)[data], 1, None, 0, GRAM
    with np.errstate(over="ignore"):
        while True:
            if rest & 1:
                n = len(data) - done - size + 1
                out, done = part[:n] if out is None else out[:n] * factor + part[done : done + n], done + size
            rest >>= 1
            if not rest:
                break
            part = part[: len(part) - size] * factor + part[size:]
            factor, size = factor * factor, size * 2
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of anchors and the first and last window start that each serves."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    hashes = _gram_hashes(data)
    low = np.uint64((1 << 23) - 1)
    key = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    width, have = LENGTH - GRAM + 1, 1
    while have * 2 <= width:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    if have < width:
        key = np.minimum(key[: len(key) - (width - have)], key[width - have :])
    place = (key & low).astype(np.int64)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    last = np.append(first[1:] - 1, n - 1)
    return place[first], first, last


def _matrix(data: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """Rows of bytes from ``start``, forwards or backwards, zero behind ``size``."""
    at = start[:, None] + step * np.arange(width)
    out = data[np.clip(at, 0, len(data) - 1)]
    out[np.arange(width) >= size[:, None]] = 0
    return out


def _text(matrix: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(matrix).view(f"S{matrix.shape[1]}").ravel()


def _shared(matrix: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Length that each row shares with the one before it."""
    out = np.zeros(len(matrix), np.int64)
    if len(matrix) > 1:
        differ = matrix[1:] != matrix[:-1]
        out[1:] = np.where(differ.any(1), differ.argmax(1), matrix.shape[1])
        out[1:] = np.minimum(out[1:], np.minimum(size[1:], size[:-1]))
    return out


def _pack(right: np.ndarray, right_size: np.ndarray, left: np.ndarray, left_size: np.ndarray, where: np.ndarray) -> bytes:
    """A sorted run, front-coded: shared and own lengths, left lengths, bytes, a table
    of the documents (id, tag), then each suffix's document, place and nearest offset."""
    shared = _shared(right, right_size)
    column = np.arange(right.shape[1])
    own = right[(column >= shared[:, None]) & (column < right_size[:, None])]
    sides = left[np.arange(left.shape[1]) < left_size[:, None]]
    named, number = np.unique(where[:, :2], axis=0, return_inverse=True)
    parts = [np.array([len(right), len(named)], np.uint32), shared.astype(np.uint8), right_size.astype(np.uint8), left_size.astype(np.uint8), where[:, 3].astype(np.uint8), number.astype(np.uint32), where[:, 2].astype(np.uint32), np.ascontiguousarray(named.T), own, sides]
    return zstandard.ZstdCompressor(level=RUN_LEVEL).compress(b"".join(p.tobytes() for p in parts))


def _unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, documents = np.frombuffer(raw, np.uint32, 2).tolist()
    at = 8

    def part(kind, size: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, kind, size, at)
        at += out.nbytes
        return out

    shared, right_size, left_size, nearest = (part(np.uint8, n).astype(np.int64) for _ in range(4))
    number, place = part(np.uint32, n), part(np.uint32, n)
    named = part(np.int64, 2 * documents).reshape(2, documents)
    own, sides = part(np.uint8, int((right_size - shared).sum())), part(np.uint8, int(left_size.sum()))
    where = np.stack([named[0][number], named[1][number], place.astype(np.int64), nearest], 1) if n else np.zeros((0, 4), np.int64)
    right, left = np.zeros((n, LENGTH), np.uint8), np.zeros((n, LEFT), np.uint8)
    column = np.arange(LENGTH)
    right[(column >= shared[:, None]) & (column < right_size[:, None])] = own
    left[np.arange(LEFT) < left_size[:, None]] = sides
    top = int(shared.max(initial=0))  # the bytes shared with the row before, column by column
    source = np.arange(n)
    for c in range(top):
        source = np.maximum.accumulate(np.where(shared > c, 0, np.arange(n)))
        right[:, c] = np.where(column[c] < right_size, right[source, c], 0)
    return right, right_size, left, left_size, where


class _Suffixes:
    """Suffixes at anchors with their left sides; ``where`` holds id, tag, place, nearest offset."""

    def __init__(self, right, right_size, left, left_size, where):
        self.right, self.right_size, self.left, self.left_size, self.where = right, right_size, left, left_size, where

    def __len__(self) -> int:
        return len(self.where)

    def take(self, rows) -> "_Suffixes":
        return _Suffixes(self.right[rows], self.right_size[rows], self.left[rows], self.left_size[rows], self.where[rows])

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """First window start of each, and the end of its last window."""
        return self.where[:, 2] - self.left_size, self.where[:, 2] - self.where[:, 3] + LENGTH

    def pack(self) -> bytes:
        return _pack(self.right, self.right_size, self.left, self.left_size, self.where)


def suffixes(texts: list[tuple[int, int, bytes]]) -> _Suffixes:
    """All suffixes at anchors of (id, tag, bytes)."""
    parts = []
    for i, tag, raw in texts:
        for base in range(0, max(1, len(raw) - LENGTH + 1), PART_BYTES):
            data = np.frombuffer(raw[base : base + PART_BYTES + LENGTH - 1], np.uint8)
            place, first, last = anchors(data)
            if len(place):
                n, right, left = len(place), last + LENGTH - place, place - first
                where = np.stack([np.full(n, i), np.full(n, tag), place + base, place - last], 1).astype(np.int64)
                parts.append((_matrix(data, place, right, LENGTH), right, _matrix(data, place - 1, left, LEFT, -1), left, where))
    if not parts:
        return _Suffixes(np.zeros((0, LENGTH), np.uint8), np.zeros(0, np.int64), np.zeros((0, LEFT), np.uint8), np.zeros(0, np.int64), np.zeros((0, 4), np.int64))
    return _Suffixes(*(np.concatenate(c) for c in zip(*parts)))


def _by_age(where: np.ndarray) -> np.ndarray:
    return np.lexsort((where[:, 1], where[:, 2], where[:, 0]))


def sorted_run(all_: _Suffixes) -> tuple[_Suffixes, np.ndarray]:
    """In order of the right sides, equal stretches once; and rows (id, tag, start, end) of the others."""
    all_ = all_.take(_by_age(all_.where))
    whole = np.ascontiguousarray(np.concatenate([all_.right, all_.left, all_.where[:, 3:4].astype(np.uint8)], 1))
    _, first, group = np.unique(whole.view(f"V{whole.shape[1]}").ravel(), return_index=True, return_inverse=True)
    origin = all_.where[first[group]]
    repeated = (all_.where[:, :3] != origin[:, :3]).any(1)
    start, end = all_.windows()
    found = np.stack([all_.where[:, 0], all_.where[:, 1], start, end], 1)[repeated]
    kept = all_.take(np.sort(first))
    return kept.take(np.argsort(_text(kept.right), kind="stable")), found


def merge_runs(parts: list[_Suffixes]) -> tuple[_Suffixes, np.ndarray]:
    """Merged order of sorted runs and the length that each suffix shares with the one before."""
    everything = [np.ascontiguousarray(p.right[:, :GRAM]).view(f"S{GRAM}").ravel() for p in parts]
    grams, times = np.unique(np.concatenate(everything), return_counts=True)
    often = grams[times > 1]
    parts = [p.take(np.flatnonzero(np.isin(g, often))) for p, g in zip(parts, everything)]
    parts = [p for p in parts if len(p)]
    if not parts:
        return suffixes([]), np.zeros(0, np.int64)

    def read(p: _Suffixes) -> Iterator[tuple[bytes, int]]:
        raw, size = p.right.tobytes(), p.right_size.tolist()
        for k, (n, shared) in enumerate(zip(size, _shared(p.right, p.right_size).tolist())):
            yield raw[k * LENGTH : k * LENGTH + n], shared

    bases = np.cumsum([0, *map(len, parts)]).tolist()
    at, order, shared = bases[:-1], [], []
    for run, _, k in loser_tree_merge([read(p) for p in parts]):
        order.append(at[run])
        at[run] += 1
        shared.append(k)
    merged = _Suffixes(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("right", "right_size", "left", "left_size", "where")))
    return merged.take(np.array(order)), np.array(shared, np.int64)


def repeats(merged: _Suffixes, shared: np.ndarray) -> np.ndarray:
    """Rows (id, tag, start, end) of windows that occur earlier, neighbours joined."""
    n = len(merged)
    if n < 2:
        return np.zeros((0, 4), np.int64)
    side = np.argsort(_text(merged.left), kind="stable")
    side_shared = _shared(merged.left[side], merged.left_size[side])
    age = _by_age(merged.where)
    nearest, furthest = merged.where[:, 3], merged.left_size
    left_class = np.empty(n, np.int64)
    out: list[np.ndarray] = []
    open_from = np.full(n, -1, np.int64)  # offset at which a stretch of repeated windows began
    for offset in range(LEFT + 2):
        active = age[(nearest[age] <= offset) & (offset <= furthest[age])] if offset <= LEFT else age[:0]
        hit = np.zeros(n, bool)
        if len(active) > 1:
            right_class = np.cumsum(shared < LENGTH - offset)
            left_class[side] = np.cumsum(side_shared < offset) if offset else 0
            key = right_class[active] * (n + 1) + left_class[active]
            _, first, group = np.unique(key, return_index=True, return_inverse=True)
            origin = merged.where[active[first[group]], :3]
            hit[active] = (merged.where[active, :3] != origin).any(1)
        ended = np.flatnonzero(~hit & (open_from >= 0))
        if len(ended):
            where = merged.where[ended]
            out.append(np.stack([where[:, 0], where[:, 1], where[:, 2] - (offset - 1), where[:, 2] - open_from[ended] + LENGTH], 1))
            open_from[ended] = -1
        open_from[hit & (open_from < 0)] = offset
    return np.concatenate(out) if out else np.zeros((0, 4), np.int64)


_MARKS = "id long, tag long, start long, end long"
_VALUES = np.random.default_rng(31).integers(1, 1 << 63, (2, 256), np.uint64)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def window_rows(hot: _Suffixes) -> np.ndarray:
    """Two hashes, id, tag and start of every window that the suffixes serve."""
    out = []
    powers = []
    for base in _BASES:
        inverse = pow(base, -1, 1 << 64)
        powers.append([np.array([pow(b, k + shift, 1 << 64) for k in range(LENGTH + 1)], np.uint64) for b, shift in ((base, 0), (inverse, 1))])
    with np.errstate(over="ignore"):
        # sums over the right side forwards and over the left side backwards: a window's hash is their sum, moved to its start
        right = [np.cumsum(_VALUES[i][hot.right] * powers[i][0][:LENGTH], 1, dtype=np.uint64) for i in (0, 1)]
        left = [np.concatenate([np.zeros((len(hot), 1), np.uint64), np.cumsum(_VALUES[i][hot.left] * powers[i][1][:LEFT], 1, dtype=np.uint64)], 1) for i in (0, 1)]
        for offset in range(LEFT + 1):
            at = np.flatnonzero((hot.where[:, 3] <= offset) & (offset <= hot.left_size))
            if len(at):
                hashes = [(right[i][at, LENGTH - offset - 1] + left[i][at, offset]) * powers[i][0][offset] for i in (0, 1)]
                out.append(np.stack([*(mixed(h).view(np.int64) for h in hashes), hot.where[at, 0], hot.where[at, 1], hot.where[at, 2] - offset], 1))
    return np.concatenate(out) if out else np.zeros((0, 5), np.int64)


def first_windows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The earliest row of each window, and (id, tag, start, end) of the others."""
    rows = rows[np.lexsort((rows[:, 3], rows[:, 4], rows[:, 2], rows[:, 1], rows[:, 0]))]
    again = np.zeros(len(rows), bool)
    again[1:] = (rows[1:, :2] == rows[:-1, :2]).all(1)
    # rows equal in id, tag and start are one place
    origin = np.maximum.accumulate(np.where(again, 0, np.arange(len(rows))))
    same = (rows[:, 2:] == rows[origin, 2:]).all(1)
    late = rows[again & ~same]
    return rows[~again], np.stack([late[:, 2], late[:, 3], late[:, 4], late[:, 4] + LENGTH], 1)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    number = F.col(id_col).cast("long")
    return docs.select(number.alias("doc_id"), F.coalesce(number, F.lit(_NO_ID)).alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"))


def _read(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes]]:
    for i, tag, text in zip(*(c.to_pylist() for c in batch.columns)):
        raw = plain_bytes(text)
        if len(raw) >= LENGTH:
            yield i, tag, raw


def splitters(keyed: DataFrame, scratch: Scratch) -> list[bytes]:
    """First ``GRAM`` bytes that cut all suffixes into ranges of about ``RANGE_BYTES`` of text, from a sample
    of about ``RANGE_SAMPLES`` places a range, drawn from whole texts."""
    total = keyed.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = -(-total // RANGE_BYTES)
    if ranges < 2:
        return []
    # places are drawn by a hash of text, suffix and place: not all copies of a passage, but any place
    every = max(1, total // (2 * (LENGTH - GRAM) // 4) // (RANGE_SAMPLES * ranges))
    # few documents are read where a document's share of the sample is small
    texts_every = max(1, every // 64)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = []
            for _, tag, raw in _read(batch):
                for base in range(0, max(1, len(raw) - LENGTH + 1), PART_BYTES):
                    data = np.frombuffer(raw[base : base + PART_BYTES + LENGTH - 1], np.uint8)
                    place = anchors(data)[0]
                    with np.errstate(over="ignore"):
                        h = (place.astype(np.uint64) + np.uint64(base) + np.uint64(tag & (1 << 63) - 1)) * np.uint64(0x9E3779B97F4A7C15)
                    own += [raw[base + p : base + p + GRAM] for p in place[(h >> np.uint64(33)) % np.uint64(max(1, every // texts_every)) == 0].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary())], ["gram"])

    few = keyed.where(F.pmod(F.xxhash64("id", "tag"), F.lit(texts_every)) == 0)
    return cut_keys(scratch.save(few.select("id", "tag", "text").mapInArrow(sample, "gram binary"), "sample"), ranges)


def find_repeats(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, tag, start, end): byte ranges covered by windows that occur earlier; they may overlap."""
    keyed = _keyed(docs, id_col, text_col)
    sampled = splitters(keyed, scratch)
    cuts, times = np.unique(np.array(sampled, f"S{GRAM}"), return_counts=True) if sampled else (np.zeros(0, f"S{GRAM}"), np.zeros(0, int))
    edges, crowded = cuts, cuts[times > HOT_RANGES]

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, size = [], 0

        def run() -> Iterator[pa.RecordBatch]:
            ordered, found = sorted_run(suffixes(texts))
            grams = np.ascontiguousarray(ordered.right[:, :GRAM]).view(f"S{GRAM}").ravel()
            hot, windows = np.isin(grams, crowded) if len(crowded) else np.zeros(len(grams), bool), None
            if hot.any():
                windows, late = first_windows(window_rows(ordered.take(hot)))
                found, ordered, grams = np.concatenate([found, late]), ordered.take(~hot), grams[~hot]
            bounds = [0, *np.searchsorted(grams, edges, "left").tolist(), len(ordered)]
            numbers = [j for j in range(len(bounds) - 1) if bounds[j] < bounds[j + 1]]
            blobs = [ordered.take(slice(bounds[j], bounds[j + 1])).pack() for j in numbers]
            for lo in range(0, len(found), REPEAT_ROWS):  # repeats inside a run pass through any range
                piece = found[lo : lo + REPEAT_ROWS]
                numbers.append(int(piece[0, 1] + piece[0, 2]) % (len(edges) + 1))
                blobs.append(b"R" + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(piece.T).tobytes()))
            if windows is not None:
                target = (windows[:, 0].view(np.uint64) % np.uint64(len(edges) + 1)).astype(np.int64)
                order = np.argsort(target, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(target[order])) + 1):
                    numbers.append(int(target[part[0]]))
                    blobs.append(b"W" + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(windows[part].T).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], ["range_id", "run"])

        for batch in batches:
            for row in _read(batch):
                texts.append(row)
                size += len(row[2])
                if size >= RUN_BYTES:
                    yield from run()
                    texts, size = [], 0
        if texts:
            yield from run()

    def merged(blobs: list[bytes]) -> pa.RecordBatch:
        opener = zstandard.ZstdDecompressor()
        found = [np.frombuffer(opener.decompress(b[1:]), np.int64).reshape(4, -1).T for b in blobs if b[:1] == b"R"]
        windows = [np.frombuffer(opener.decompress(b[1:]), np.int64).reshape(5, -1).T for b in blobs if b[:1] == b"W"]
        if windows:
            found.append(first_windows(np.concatenate(windows))[1])
        parts = [_Suffixes(*_unpack(b)) for b in blobs if b[:1] not in (b"R", b"W")]
        if parts:
            found.append(repeats(*merge_runs(parts)))
        rows = np.concatenate(found)
        return pa.RecordBatch.from_arrays([pa.array(rows[:, k]) for k in range(4)], ["id", "tag", "start", "end"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blobs = None, []
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if number != current and blobs:
                    yield merged(blobs)
                    blobs = []
                current = number
                blobs.append(blob)
        if blobs:
            yield merged(blobs)

    runs = keyed.select("id", "tag", "text").mapInArrow(sort, "range_id int, run binary")
    # a partition for each range, at any number of ranges
    return runs.repartitionById(len(edges) + 1, "range_id").sortWithinPartitions("range_id").mapInArrow(merge, _MARKS)


def joined_ranges(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (array of start and end, bytes, none touching), kept (binary); one row for each of ``docs``."""
    keyed = _keyed(docs, id_col, text_col)
    marks = find_repeats(docs, scratch, id_col, text_col).groupBy("id", "tag").agg(F.collect_list(F.struct("start", "end")).alias("marks"))

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1, write_checksum=False)
        for batch in batches:
            small = [packer.compress(t.as_py().encode()) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(small, pa.binary())], ["doc_id", "id", "tag", "small"])

    # texts cross the exchange compressed: it is the larger of the two
    pressed = keyed.mapInArrow(press, "doc_id long, id long, tag long, small binary")
    both = pressed.join(marks, ["id", "tag"], "left").select("doc_id", "small", F.col("marks.start").alias("starts"), F.col("marks.end").alias("ends"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, starts, ends in zip(*(batch.column(k) for k in (1, 2, 3))):
                raw, at, left = opener.decompress(text.as_py()), 0, []
                ranges = joined_ranges(starts.as_py(), ends.as_py()) if starts.is_valid else []
                for a, b in ranges:
                    left.append(raw[at:a])
                    at = b
                sizes.append(len(raw))
                spans.append([{"start": a, "end": b} for a, b in ranges])
                kept.append(b"".join([*left, raw[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return both.mapInArrow(cut, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
