"""Mixture-controlled packing: deficit round-robin over one queue for each source.

Every window of ``WINDOW`` tokens grants each queue its quantum, the target share of the window, on top of
the deficit that the queue carries: what it is owed so far less what it has got. A queue pays a token at a
time from what it is owed; the next token comes always from the queue whose next token is due first
(token t at time (t + 0.5) / share; ties to the first queue). So a queue is never owed more than a token
or so, and the state before window w, the deficits, is a function of w alone: :class:`Schedule` gives it
for any w. Each task fills its own windows and takes over the deficits exactly where the one before it
leaves off; no task sees more than its part of the documents. A queue that runs dry leaves its share to
the others; a queue of share 0 is served once the others are dry. Documents are cut where a window ends.

A stated mixture gives shares of sources by name. Sources it doesn't name split what it leaves of 1 by
their tokens. The work for a document grows with the number of sources, of which there may be any number.

Edge cases. A null text is empty: its only token is the end mark. A null source is the queue
with the empty name. Repeated rows are packed each. An empty table gives an empty result.
Further columns are ignored. Shares below 0, or of more than 1 together, are an error; names that no row
has are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.llm import tokens
from weft.scratch import Scratch

WINDOW, END_ID = 2048, 1
#: Texts are encoded together up to so many signs.
CHUNK_SIGNS = 2_000_000
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, padded_to long"


def target_shares(names: list[str], totals: np.ndarray, mixture: dict[str, float] | None) -> np.ndarray:
    """Share of every queue: the stated one, else by its tokens what the stated ones leave of 1."""
    mixture = mixture or {}
    if any(x < 0 for x in mixture.values()) or sum(mixture.values()) > 1 + 1e-9:
        raise ValueError("shares of a mixture must not be below 0, nor above 1 together")
    stated = np.array([n in mixture for n in names], bool)
    free = totals * ~stated
    left = max(0.0, 1 - sum(mixture.values()))
    return np.where(stated, [mixture.get(n, 0.0) for n in names], left * free / max(free.sum(), 1))


@dataclass(frozen=True)
class Schedule:
    """Deficit round-robin in closed form. ``totals``: tokens of each queue; ``shares``: target weights, 0 or more."""

    totals: np.ndarray
    shares: np.ndarray
    window: int = WINDOW

    @property
    def all_tokens(self) -> int:
        return int(self.totals.sum())

    @property
    def levels(self) -> list["Schedule"]:
        """Queues with a share, then those that wait until these are dry, by their tokens."""
        late = self.shares <= 0
        now = Schedule(np.where(late, 0, self.totals), np.where(late, 1.0, self.shares), self.window)
        return [now, Schedule(np.where(late, self.totals, 0), np.where(late, np.maximum(self.totals, 1), 1.0), self.window)] if late.any() else [now]

    def _below(self, x: np.ndarray, q: int) -> np.ndarray:
        """Tokens of queue q that are due before x; token t is due at (t + 0.5) / share."""
        g = self.shares[q]
        n = np.ceil(x * g - 0.5)
        n += (n + 0.5) / g < x
        n -= (n - 0.5) / g >= x
        return np.clip(n, 0, self.totals[q]).astype(np.int64)

    def _rank(self, t: np.ndarray, q: np.ndarray) -> np.ndarray:
        x = (t + 0.5) / self.shares[q]
        out = np.zeros(len(t), np.int64)
        for other in np.flatnonzero(self.totals):
            n = self._below(x, other)
            tie = (other < q) & (n < self.totals[other]) & ((n + 0.5) / self.shares[other] == x)
            out += np.where(other == q, t, n + tie)
        return out

    def rank(self, t: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Place of token t of queue q among all tokens."""
        out, before = np.zeros(len(t), np.int64), 0
        for level in self.levels:
            own = level.totals[q] > 0
            out[own] = before + level._rank(t[own], q[own])
            before += level.all_tokens
        return out

    def _taken(self, goal: np.ndarray) -> np.ndarray:
        queues = np.flatnonzero(self.totals)
        low, high = np.zeros(len(goal)), np.full(len(goal), (self.totals / self.shares).max(initial=0) + 1.0)
        for _ in range(1100):
            middle = low + (high - low) / 2
            if not ((middle > low) & (middle < high)).any():
                break
            fits = sum(self._below(middle, q) for q in queues) <= goal
            low, high = np.where(fits, middle, low), np.where(fits, high, middle)
        out = np.zeros((len(goal), len(self.totals)), np.int64)
        for q in queues:
            out[:, q] = self._below(low, q)
        rest = goal - out.sum(1)
        for q in queues:  # tokens that are due exactly there, first queue first
            tie = (rest > 0) & (out[:, q] < self.totals[q]) & ((out[:, q] + 0.5) / self.shares[q] == low)
            out[:, q] += tie
            rest -= tie
        out[goal == self.all_tokens] = self.totals
        return out

    def taken(self, windows: np.ndarray) -> np.ndarray:
        """Tokens that each queue has given before each window: the state that deficits define."""
        goal, out, before = windows.astype(np.int64) * self.window, 0, 0
        for level in self.levels:
            out = out + level._taken(np.clip(goal - before, 0, level.all_tokens))
            before += level.all_tokens
        return out

    def quanta(self, windows: np.ndarray) -> np.ndarray:
        """Tokens that each queue gives to each window: its share of it and the deficit it carried, in whole tokens."""
        return self.taken(windows + 1) - self.taken(windows)

    def deficits(self, windows: np.ndarray) -> np.ndarray:
        """What each queue is still owed before each window, as long as no queue is dry."""
        return windows[:, None] * self.window * self.shares / self.shares.sum() - self.taken(windows)


def tokenize(docs: DataFrame, vocabulary: str, queue, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every document with the end mark, its task, and where it starts in its queue there."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), queue.alias("queue"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, part = tokens.load(vocabulary), TaskContext.get().partitionId()
        end, given = np.array([END_ID], "<u2").tobytes(), {}
        for batch in batches:
            texts = batch.column(2).to_pylist()
            lo = 0
            while lo < len(texts):
                hi, signs = lo, 0
                while hi < len(texts) and (hi == lo or signs + len(texts[hi]) <= CHUNK_SIGNS):
                    signs += len(texts[hi])
                    hi += 1
                ids = [x + end for x in words.encode(texts[lo:hi])]
                queues, starts = batch.column(1)[lo:hi].to_pylist(), []
                for q, x in zip(queues, ids):
                    starts.append(given.get(q, 0))
                    given[q] = starts[-1] + len(x) // 2
                n = hi - lo
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int32()), batch.column(0)[lo:hi], pa.array(queues, pa.string()), pa.array(starts, pa.int64()), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    ["part", "doc_id", "queue", "part_start", "n_tokens", "ids"],
                )
                lo = hi

    return rows.mapInArrow(encode, "part int, doc_id long, queue string, part_start long, n_tokens long, ids binary")


def cut_pieces(schedule: Schedule, queue: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pieces of documents that lie at ``first`` in their queues: document's row, start, length, window, offset."""
    w0, w1 = schedule.rank(first, queue) // schedule.window, schedule.rank(first + size - 1, queue) // schedule.window
    count = w1 - w0 + 1
    row = np.repeat(np.arange(len(queue)), count)
    window = w0[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    needed = np.unique(np.concatenate([window, window + 1]))
    taken = schedule.taken(needed)
    at = np.searchsorted(needed, window)
    now, then, q = taken[at], taken[at + 1], queue[row]
    pick = np.arange(len(row))
    start = np.maximum(now[pick, q], first[row])
    end = np.minimum(then[pick, q], first[row] + size[row])
    before = np.cumsum(then - now, 1)[pick, q] - (then - now)[pick, q]
    offset = before + start - now[pick, q]
    keep = end > start
    return row[keep], (start - first[row])[keep], (end - start)[keep], window[keep], offset[keep]


def pack(spark: SparkSession, docs: DataFrame, scratch: Scratch, vocabulary: str, mixture: dict[str, float] | None = None, source_col: str = "source") -> DataFrame:
    """Rows of ``PIECES``; ``ids`` are little-endian unsigned 32-bit numbers.

    ``mixture``: target shares of the tokens of a window by source; by default every source's share of all tokens."""
    source = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    encoded = scratch.save(tokenize(docs, vocabulary, source), "tokens")
    given = encoded.groupBy("part", "queue").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = scratch.save(given.select("part", "queue", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"), "n"), "bases")
    totals = bases.groupBy("queue").agg(F.sum("n").alias("n")).orderBy("queue").collect()
    names = [r.queue for r in totals]
    sizes = np.array([r.n for r in totals], np.int64)
    schedule, number = Schedule(sizes, target_shares(names, sizes, mixture) if mixture else sizes.astype(float)), {q: i for i, q in enumerate(names)}
    rest = schedule.all_tokens % WINDOW
    last, last_size = schedule.all_tokens // WINDOW, rest if rest & (rest - 1) == 0 else WINDOW

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                size = part.column(3).to_numpy()
                queue = np.array([number[q] for q in part.column(1).to_pylist()])
                row, start, length, window, offset = cut_pieces(schedule, queue, part.column(2).to_numpy(), size)
                ids = [np.frombuffer(x.as_py(), "<u2").astype("<u4").tobytes() for x in part.column(4)]
                own = [ids[r][4 * s : 4 * (s + n)] for r, s, n in zip(row.tolist(), start.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(own, pa.binary()), pa.array(size[row]), pa.array(window), pa.array(offset), pa.array(np.where(window == last, last_size, WINDOW))],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padded_to"],
                )

    placed = encoded.join(bases.drop("n"), ["part", "queue"]).select("doc_id", "queue", (F.col("part_start") + F.col("base")).alias("first"), "n_tokens", "ids")
    return placed.mapInArrow(cut, PIECES)
