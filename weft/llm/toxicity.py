"""Toxicity: a linear classifier from confirmed toxic and unlabelled texts.

Training minimises the non-negative positive-unlabelled risk: with class prior p, the loss of
positives as positives times p, plus what unlabelled texts lose as negatives less p times what
positives lose as negatives, that difference never taken below zero. Features are hashed words
and word starts; a text's value for one is its count over the root of its number of words, so
texts of any length compare. The threshold is set on labelled rows of the training folds.

The classifier is fitted on a bounded sample of whole texts: ``MAX_POSITIVE``, ``MAX_UNLABELLED`` and
``MAX_CALIBRATE`` ids of lowest hash, one row an id, in that order as long as ``MAX_SAMPLE_BYTES`` of text
aren't passed. Every whole text is scored. The class prior is the share of toxic rows among the labelled
ones of the training folds, held between ``LEAST_PRIOR`` and ``MOST_PRIOR`` (labels of one kind only give
``MOST_PRIOR``).

Edge cases. A null or empty text has no words and gets the score of the bias. Rows that share a
doc_id are scored each, and one of them, the one of lowest text hash, may be learnt from; the highest of
several labels counts. A null doc_id is never held out. Without confirmed toxic rows that have a text, or
without further documents, every score is 0. An empty table gives an empty result. Further
columns are ignored by :func:`score_toxicity` and kept by :func:`drop_toxic`.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from weft.llm import caches, words

BUCKETS, STARTS = 1 << 18, (4, 5, 6)
MAX_POSITIVE, MAX_UNLABELLED, MAX_CALIBRATE, MAX_SAMPLE_BYTES = 2000, 4000, 3000, 48 << 20
LEAST_PRIOR, MOST_PRIOR = 0.01, 0.5
FOLDS, HELD_OUT, ACCEPT = 4, 2, 0.3
EPOCHS, RATE, DECAY, MIN_TEXTS, LEAST_Z = 60, 0.02, 1e-3, 4, 3.0
CACHE_WORDS = 700_000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def word_buckets(word: str) -> list[int]:
    """Buckets of a word: itself and its starts, without signs at its ends."""
    core = word.strip(".,;:!?|#*$%&<>()[]\"'-_ ")
    parts = {core} | {core[:k] + "^" for k in STARTS if len(core) > k}
    return [zlib.crc32(p.encode()) % BUCKETS for p in parts if p]


def _text_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    count: dict[str, int] = {}
    for w in words:
        count[w] = count.get(w, 0) + 1
    buckets, times = [], []
    for w, n in count.items():
        own = word_buckets(w)
        buckets += own
        times += [n] * len(own)
    slots, inverse = np.unique(np.array(buckets, np.int32), return_inverse=True)
    return slots, (np.bincount(inverse, times) / np.sqrt(len(words))).astype(np.float32)


def nn_risk(z: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, float, np.ndarray]:
    """Non-negative PU risk of the logits: the positives' part, the corrected negatives' part, and the slope of
    what training descends on: their sum, or less the second part where that is below zero."""
    s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    as_negative = np.log1p(np.exp(np.clip(z, -30, 30)))
    n_pos, n_unl = positive.sum(), (~positive).sum()
    confirmed = prior * (as_negative[positive] - z[positive]).mean()
    rest = as_negative[~positive].mean() - prior * as_negative[positive].mean()
    slope = np.empty(len(z))
    if rest >= 0:
        slope[positive] = prior * (s[positive] - 1) / n_pos - prior * s[positive] / n_pos
        slope[~positive] = s[~positive] / n_unl
    else:  # walk back out of the negative part
        slope[positive] = prior * s[positive] / n_pos
        slope[~positive] = -s[~positive] / n_unl
    return float(confirmed), float(rest), slope


class PULearner:
    """Weights over all buckets and a bias; :meth:`fit` is full-batch Adam on the nnPU risk."""

    def __init__(self, prior: float):
        self.prior, self.weights, self.bias = prior, np.zeros(BUCKETS, np.float32), 0.0
        self.slope, self.cut = 1.0, 0.0

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], positive: np.ndarray) -> "PULearner":
        texts = np.bincount(np.concatenate([s for s, _ in rows]), minlength=BUCKETS)  # a text names a bucket once
        used = np.flatnonzero(texts >= MIN_TEXTS)
        place = np.full(BUCKETS, -1, np.int32)
        place[used] = np.arange(len(used))
        column = np.concatenate([place[s] for s, _ in rows])
        value = np.concatenate([v for _, v in rows])
        row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(s) for s, _ in rows])
        keep = column >= 0
        column, value, row = column[keep], value[keep], row[keep]
        scale = self._scale(row, column, positive, len(used))
        value = (value * scale[column]).astype(np.float32)
        w, bias = np.zeros(len(used)), float(np.log(self.prior / (1 - self.prior)))
        m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
        for step in range(1, EPOCHS + 1):
            z = np.bincount(row, value * w[column], len(rows)) + bias
            slope = nn_risk(z, positive, self.prior)[2]
            g = np.bincount(column, value * slope[row], len(used)) + DECAY * w
            gb = slope.sum()
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
            a, b = 1 - 0.9**step, 1 - 0.999**step
            w -= RATE * (m / a) / (np.sqrt(v / b) + 1e-8)
            bias -= RATE * (mb / a) / (np.sqrt(vb / b) + 1e-8)
        self.weights[used], self.bias = w * scale, float(bias)
        return self

    @staticmethod
    def _scale(row: np.ndarray, column: np.ndarray, positive: np.ndarray, n: int) -> np.ndarray:
        """Trust in each feature: by how much its share of positive texts differs from that of
        unlabelled ones, in standard errors beyond ``LEAST_Z``; the others are left out."""
        in_pos = np.bincount(column[positive[row]], minlength=n)
        in_unl = np.bincount(column[~positive[row]], minlength=n)
        n_pos, n_unl = max(positive.sum(), 1), max((~positive).sum(), 1)
        pooled = (in_pos + in_unl) / (n_pos + n_unl)
        z = (in_pos / n_pos - in_unl / n_unl) / np.sqrt(pooled * (1 - pooled) * (1 / n_pos + 1 / n_unl) + 1e-9)
        return np.maximum(np.abs(z) - LEAST_Z, 0.0)

    def calibrate(self, rows: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray) -> "PULearner":
        """Logit that scores ``ACCEPT``: the best F1 on labelled rows."""
        z = np.array([self.weights[s] @ v for s, v in rows]) + self.bias
        order = np.argsort(-z, kind="stable")
        hits = np.cumsum(toxic[order])
        f1 = 2 * hits / (np.arange(1, len(z) + 1) + toxic.sum())
        k = int(np.argmax(f1))
        ranked = z[order]
        self.cut = float((ranked[k] + ranked[k + 1]) / 2) if k + 1 < len(z) else float(ranked[k]) - 1e-6
        self.slope = float(1 / max(np.std(z), 1e-6))
        return self

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """Scores of texts; the weights of words are kept by their hashes, for a bounded number of words."""

    def __init__(self, learner: PULearner):
        self.learner = learner
        self._forget()

    def _forget(self) -> None:
        self.place = words.Places()
        self.values = np.zeros(0)

    def _logits(self, texts: list[bytes]) -> np.ndarray:
        whole, start, end, hashes, counts = words.find_words(texts, words.ALL_BLANKS)
        codes, distinct = pd.factorize(hashes)
        if len(self.place) + len(distinct) > CACHE_WORDS:
            self._forget()
        at = self.place.find(distinct)
        new = np.flatnonzero(at < 0)
        if len(new):
            seen = np.zeros(len(distinct), np.int64)
            seen[codes[::-1]] = np.arange(len(codes))[::-1]  # where each stands first
            weights = self.learner.weights
            own = [float(sum(weights[b] for b in word_buckets(whole[i:j].decode()))) for i, j in zip(start[seen[new]].tolist(), end[seen[new]].tolist())]
            at[new] = self.place.add(distinct[new])
            self.values = np.concatenate([self.values, own])
        sums = np.bincount(np.repeat(np.arange(len(texts)), counts), self.values[at[codes]], len(texts))
        return self.learner.bias + sums / np.sqrt(np.maximum(counts, 1))

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        plain = [words.lower_text(t) for t in texts]
        z = np.concatenate([np.zeros(0), *(self._logits(plain[lo:hi]) for lo, hi in words.slices(list(map(len, plain)), 4 * words.CHUNK_BYTES))])
        shift = float(np.log(ACCEPT / (1 - ACCEPT)))
        return 1 / (1 + np.exp(-np.clip(self.learner.slope * (z - self.learner.cut) + shift, -50, 50)))


def _sampled(docs: DataFrame, ids: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Features by id of the documents that the bounded table ``ids`` (doc_id, place) names, one row an id, in the
    order of ``place`` as far as ``MAX_SAMPLE_BYTES`` of text go."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).join(F.broadcast(ids), "doc_id")
    chosen = rows.groupBy("doc_id", "place").agg(F.min(F.struct(F.xxhash64("text"), F.octet_length("text").alias("size"))).alias("r"))
    fits, left = [], MAX_SAMPLE_BYTES
    for r in sorted(chosen.select("doc_id", "place", "r.*").collect(), key=lambda r: r.place):
        if r.size <= left:
            left -= r.size
            fits.append((r.doc_id, r[2]))
    if not fits:
        return {}
    few = docs.sparkSession.createDataFrame(fits, "doc_id long, hash long")
    one = rows.withColumn("hash", F.xxhash64("text")).join(F.broadcast(few), ["doc_id", "hash"]).select("doc_id", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # rows equal in id and text
        for batch in batches:
            out = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i not in seen:
                    seen.add(i)
                    slots, times = _text_features(text.as_py())
                    out.append((i, slots.tobytes(), times.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary()))], ["doc_id", "slots", "times"])

    got = one.mapInArrow(extract, "doc_id long, slots binary, times binary").dropDuplicates(["doc_id"]).toArrow()
    return {i.as_py(): (np.frombuffer(s.as_buffer(), np.int32), np.frombuffer(t.as_buffer(), np.float32)) for i, s, t in zip(*(got[c] for c in ("doc_id", "slots", "times")))}


def fit_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> PULearner | None:
    """Classifier from labels of the training folds; None if they confirm nothing as toxic."""
    truth = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id")))
    chance = F.xxhash64("doc_id")
    picked = lambda rows, n: rows.orderBy(chance, "doc_id").limit(n).collect()
    positive = [r.doc_id for r in picked(truth.where("toxic = 1"), MAX_POSITIVE)]
    if not positive:
        return None
    known = {r.doc_id: int(r.toxic == 1) for r in picked(truth, MAX_CALIBRATE)}
    free = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").where(~held_out(F.col("doc_id"))).distinct()
    unlabelled = [r.doc_id for r in picked(free, MAX_UNLABELLED)]
    turns = [x for part in itertools.zip_longest(positive, unlabelled, known) for x in part if x is not None]
    ids = spark.createDataFrame(list(enumerate(dict.fromkeys(turns))), "place long, doc_id long")
    found = _sampled(docs.withColumn("doc_id", F.col("doc_id").cast("long")), ids)
    positive, unlabelled, known = [i for i in positive if i in found], [i for i in unlabelled if i in found], {i: t for i, t in known.items() if i in found}
    if not positive or not unlabelled:
        return None
    share = truth.agg(F.avg("toxic")).first()[0]
    learner = PULearner(min(max(float(share), LEAST_PRIOR), MOST_PRIOR))
    learner.fit([found[i] for i in positive + unlabelled], np.arange(len(positive) + len(unlabelled)) < len(positive))
    return learner.calibrate([found[i] for i in known], np.array(list(known.values()))) if any(known.values()) else learner


def _scored(docs: DataFrame, learner: PULearner | None) -> DataFrame:
    """All columns and ``__weft_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(learner)
    position = docs.columns.index("text")
    names = [*docs.columns, "__weft_score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches.use("toxicity")
        scores = shared.value.scorer() if shared.value is not None else lambda texts: np.zeros(len(texts))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.zeros(0), *map(scores, words.parts_of(batch.column(position)))]), pa.float64())], names)

    return docs.mapInArrow(score, StructType([*docs.schema.fields, StructField("__weft_score", DoubleType())]))


def score_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``ACCEPT`` on)."""
    scored = _scored(docs.select("doc_id", "text"), fit_toxicity(spark, docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__weft_score").alias("score"), (F.col("__weft_score") >= ACCEPT).cast("int").alias("predicted"))


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows, all columns, that the classifier doesn't reject."""
    return _scored(docs, fit_toxicity(spark, docs, labels)).where(F.col("__weft_score") < ACCEPT).select(*docs.columns)
