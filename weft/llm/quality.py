"""Quality rules: rule statistics of whole texts, and an isolation forest over them.

The statistics are exact and take one pass over the text. The forest isolates points by random
splits; a short mean path marks an anomaly. Each tree is grown on a subsample of its own, ``SUBSAMPLE``
ids drawn by hash from all documents with words; the threshold comes from all labelled rows.

Edge cases. A null or empty text has no words: all counts are 0 and it fails the base rules.
Repeated rows stay, and count as often in the threshold's histogram; rows that share an id are one in a
tree's subsample. Without labelled rows of both kinds that pass the base rules nothing else is rejected.
An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.scratch import Scratch

WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 5, 10, 20
SYMBOLS = "#*$%&|<>"
TREES, SUBSAMPLE, DRAW = 128, 256, 1.5
#: A rejected good row costs as much as so many accepted bad ones.
GOOD_COST = 4.0
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_SPACE = b" \t\n\r\x0b\x0c"


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words which occurs twice or more in the list."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    key, base = ids[:n], max(len(number), 2)
    distinct = base
    for k in range(1, window):
        if distinct * base >= 1 << 62:  # rank the prefixes so far, so that keys stay exact
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            distinct = int(key.max()) + 1
        key = key * base + ids[k : k + n]
        distinct *= base
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    if not twice.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, code points in them, symbols, repeated lines, words in repeated windows."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()  # bytes split at exactly the six signs of the word rule
    blanks = sum(raw.count(bytes([c])) for c in _SPACE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen: set[bytes] = set()
    repeated = 0
    for line in raw.split(b"\n"):
        if line in seen:
            repeated += 1
        elif line and line.strip():
            seen.add(line)
    return len(words), len(text) - blanks, symbols, repeated, repeat_words(words)


def document_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the columns of ``STATS``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*(text_stats(t.as_py()) for t in batch.column(1)))) or [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])

    return rows.mapInArrow(stats, f"doc_id {id_type}, {STATS}")


def features(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) -> np.ndarray:
    """Rule statistics on scales that do not depend on the length, and the length's logarithm."""
    n = np.maximum(n_words, 1.0)
    return np.stack([np.log1p(n_words), word_chars / n, np.sqrt(n_symbols / n), np.sqrt(n_dup_lines / n), np.sqrt(n_repeat_words / n)], 1)


def _depth_left(n: float) -> float:
    """Mean path length of an unsuccessful search among n points."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


class IsolationForest:
    """Trees as flat arrays: feature (-1: leaf), threshold or path length, left child (right: next)."""

    def __init__(self, seed: int = 7):
        self.seed = seed
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, subsamples: list[np.ndarray]) -> "IsolationForest":
        """One tree for each subsample of points; path lengths are kept as shares of its mean search."""
        rng = np.random.default_rng(self.seed)
        for points in subsamples:
            limit, scale = int(np.ceil(np.log2(max(len(points), 2)))), _depth_left(len(points)) or 1.0
            feature, value, child = [], [], []
            todo = [(points, 0, self._slot(feature, value, child))]
            while todo:
                part, depth, at = todo.pop()
                low, high = part.min(0), part.max(0)
                split = np.flatnonzero(high > low)
                if depth >= limit or len(part) < 2 or not len(split):
                    value[at] = (depth + _depth_left(len(part))) / scale
                    continue
                f = rng.choice(split)
                cut = rng.uniform(low[f], high[f])
                feature[at], value[at] = f, cut
                child[at] = self._slot(feature, value, child)
                right = self._slot(feature, value, child)
                left = part[:, f] <= cut  # cut < high: neither side is empty
                todo += [(part[left], depth + 1, child[at]), (part[~left], depth + 1, right)]
            self.nodes.append((np.array(feature), np.array(value), np.array(child)))
        return self

    @staticmethod
    def _slot(feature: list, value: list, child: list) -> int:
        feature.append(-1)
        value.append(0.0)
        child.append(0)
        return len(feature) - 1

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; anomalies near 1."""
        if not self.nodes or not len(x):
            return np.zeros(len(x))
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, value, child in self.nodes:
            at = np.zeros(len(x), np.int64)
            live = rows[feature[at] >= 0]
            while len(live):
                here = at[live]
                at[live] = child[here] + (x[live, feature[here]] > value[here])
                live = live[feature[at[live]] >= 0]
            total += value[at]
        return np.exp2(-total / len(self.nodes))


def subsamples(stats: DataFrame) -> list[np.ndarray]:
    """Points for each tree: the ``SUBSAMPLE`` ids of lowest hash under the tree's own hash, of all documents with words."""
    names = [c for c in stats.columns if c != "doc_id"]
    usable = stats.where("n_words > 0")
    total = usable.count()
    # about DRAW times what a tree takes lies below this bound: what comes back has the same size at any number of documents
    bound = np.uint64(min(2**64 - 1, int(2**64 * DRAW * SUBSAMPLE / max(total, 1))))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
            for tree in range(TREES):
                with np.errstate(over="ignore"):
                    h = base + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
                    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
                    h ^= h >> np.uint64(31)
                at = np.flatnonzero(h <= bound)
                if len(at):
                    rows = pa.array(at)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), tree, np.int32)), pa.array((h[at] >> np.uint64(1)).astype(np.int64)), *(c.take(rows) for c in batch.columns[1:])], ["tree", "chance", *names])

    drawn = usable.select(F.xxhash64("doc_id").alias("h"), *names).mapInArrow(draw, f"tree int, chance long, {STATS}")
    rows = drawn.groupBy("tree", "chance").agg(F.min(F.struct(*names)).alias("r")).select("tree", "chance", "r.*").toPandas().sort_values(["tree", "chance"])
    return [features(*(part[c].to_numpy(float)[:SUBSAMPLE] for c in names)) for _, part in rows.groupby("tree")]


def judge_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id``, the statistics, ``base_failed``, ``kept`` and ``anomaly`` (0 to 1)."""
    stats = scratch.save(document_stats(docs), "stats")
    names = [c for c in stats.columns if c != "doc_id"]
    forest = IsolationForest().fit(subsamples(stats))
    shared = spark.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def anomaly(*columns):
        import pandas as pd

        return pd.Series(shared.value.score(features(*(c.to_numpy(float) for c in columns))))

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = stats.withColumn("base_failed", failed).withColumn("anomaly", anomaly(*names))
    truth = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    bins = scored.where(~F.col("base_failed")).join(truth, "doc_id").groupBy(F.floor(F.col("anomaly") * 1000).alias("bin")).agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad")).collect()
    cut = best_cut([(r.bin, r.good, r.bad) for r in bins]) / 1000
    return scored.select("doc_id", *names, "base_failed", (~F.col("base_failed") & (F.col("anomaly") < cut)).alias("kept"), "anomaly")


def best_cut(bins: list[tuple[int, int, int]]) -> float:
    """Bin from which on rows are rejected: most bad rows less ``GOOD_COST`` times the good ones; none without both kinds."""
    if not sum(good for _, good, _ in bins) or not sum(bad for _, _, bad in bins):
        return float("inf")
    best, cut, value = 0.0, float("inf"), 0.0
    for b, good, bad in sorted(bins, reverse=True):
        value += bad - GOOD_COST * good
        if value > best:
            best, cut = value, b
    return cut
