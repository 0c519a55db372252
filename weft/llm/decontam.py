"""Benchmark decontamination by latent semantic retrieval.

1. Texts become 64-bit word hashes and are kept as such; their upper bits are term numbers (``TERMS`` of them, so
   every table below has a fixed size). Document frequencies are counted over all passages.
2. A randomised SVD of the passages' TF-IDF matrix (rows of unit length, a term once a passage).
   One pass adds every passage under random signs to ``SIGNS`` of ``RANK`` columns; sums meet by term and the driver
   makes the ``TERMS`` x ``RANK`` result a basis. A second pass takes the matrix of inner products
   of all passages in that basis, whose eigenvectors give the singular vectors and values.
   Latent coordinates are divided by the values, so that no topic or language drowns the others.
3. Every window of as many words as the largest of ``WIDTHS`` that the item has (one each ``STRIDE``
   words, for shorter ones each ``STEP``) whose cosine with one of the item's overlapping windows
   reaches ``COSINE`` is a candidate: ``ANSWER_SHARE`` of the answer's terms (without an answer
   column: of the item's rarest third) have to be around it, and the longest common subsequence
   of the item's words and the words there has to cover ``LCS_SHARE`` of the item.
4. Items of fewer than ``MIN_WORDS`` words are searched for as they are, word by word.

Items are a stated query set: they are taken in blocks of ``BLOCK_WORDS`` words, and every block meets all windows.

Edge cases. Null or empty texts and items match nothing; items without an id are left out. Repeated rows match
each, also without an id. Empty tables give an empty result. Further columns are ignored by :func:`find_leaks` and
kept by :func:`drop_leaks`, which drops exactly the rows whose text holds an item, whatever their id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import caches, words
from weft.scratch import Scratch

TERM_BITS, RANK, SIGNS, SEED = 14, 40, 8, 11
TERMS = 1 << TERM_BITS
WIDTH, STRIDE, STEP = 24, 8, 4
WIDTHS = (WIDTH, 16, 12, 8)
COSINE, LCS_SHARE, ANSWER_SHARE, MIN_WORDS, BLOCK_WORDS = 0.45, 0.75, 0.6, 8, 1 << 18
BATCH_WORDS, PRODUCTS = 200_000, 1 << 18
LEAKS = "doc_id long, item_id long, cosine double, lcs_share double, answer_share double, first_word long"
FOUND_NAMES = ["doc_id", "tag", "item_id", "cosine", "lcs_share", "answer_share", "first_word"]
FOUND = LEAKS.replace(", item_id", ", tag long, item_id")


EDGES = ".,;:!?|#*$%&<>()[]\"'-_"
_EDGE_SET = words.byte_set(EDGES.encode())


def _core(word: str) -> str:
    return word.strip(EDGES) or word


def hashes_of(texts: list[str | None]) -> list[np.ndarray]:
    """Hashes of the words of each text, without the signs around them."""
    out = []
    plain = [words.lower_text(t) for t in texts]
    for lo, hi in words.slices(list(map(len, plain)), 4 * words.CHUNK_BYTES):
        flat, counts = words.hash_words(plain[lo:hi], words.ALL_BLANKS, _EDGE_SET)
        out += np.split(flat, np.cumsum(counts)[:-1])
    return out


def word_hashes(text: str | None) -> np.ndarray:
    return hashes_of([text])[0]


def term_numbers(hashes: np.ndarray) -> np.ndarray:
    """1 to TERMS - 1; 0 is padding."""
    return np.maximum(hashes >> np.uint64(64 - TERM_BITS), 1).astype(np.uint16)


def _padded(docs: list[np.ndarray], step: int) -> tuple[np.ndarray, np.ndarray]:
    """All documents, each filled up to a multiple of ``step``; rows of ``step`` terms, and each document's first row."""
    rows = np.array([-(-len(d) // step) for d in docs])
    first = np.cumsum(rows) - rows
    flat = np.zeros(int(rows.sum()) * step, np.uint16)
    for d, r in zip(docs, first.tolist()):
        flat[r * step : r * step + len(d)] = term_numbers(d)
    return flat.reshape(-1, step), first


def _groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of batches that hold about ``BATCH_WORDS`` words."""
    for batch in batches:
        docs = [np.frombuffer(x.as_buffer(), "<u8") for x in batch.column(column)]
        lo = 0
        while lo < len(docs):
            hi, words = lo, 0
            while hi < len(docs) and (hi == lo or words + len(docs[hi]) <= BATCH_WORDS):
                words += len(docs[hi])
                hi += 1
            yield batch.slice(lo, hi - lo), docs[lo:hi]
            lo = hi


def encode_words(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, words): hash of the text, little-endian 64-bit hashes of all words."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches.use("decontam")
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([h.tobytes() for part in words.parts_of(batch.column(2)) for h in hashes_of(part)], pa.binary())], ["doc_id", "tag", "words"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"), "text").mapInArrow(encode, "doc_id long, tag long, words binary")


def _passages(docs: list[np.ndarray]) -> np.ndarray:
    return _padded(docs, WIDTH)[0]


def inverse_frequencies(table: DataFrame) -> np.ndarray:
    """log(passages / passages with the term), over all documents; 0 for padding."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(TERMS, np.int64)
        for _, docs in _groups(batches, 0):
            rows = np.sort(_passages(docs), 1)
            fresh = np.ones(rows.shape, bool)
            fresh[:, 1:] = rows[:, 1:] != rows[:, :-1]
            n += np.bincount(rows[fresh], minlength=TERMS)
            n[0] += len(rows) - (fresh & (rows == 0)).sum()  # slot 0: the number of passages
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used])], ["term", "n"])

    found = table.select("words").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(TERMS)
    n[found["term"].to_numpy()] = found["n"].to_numpy()
    idf = np.where(n > 0, np.log1p(n[0]) - np.log(np.maximum(n, 1)), np.log1p(n[0]))
    idf[0] = 0
    return np.maximum(idf, 0).astype(np.float32)


def _weighted(docs: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passages as sorted terms and their TF-IDF weights; a term counts once, a row has length 1."""
    rows = np.sort(_passages(docs), 1)
    weights = idf[rows]
    weights[:, 1:][rows[:, 1:] == rows[:, :-1]] = 0
    weights /= np.maximum(np.sqrt(np.einsum("ij,ij->i", weights, weights)), 1e-6)[:, None]
    return rows, weights


def latent_basis(spark: SparkSession, table: DataFrame, idf: np.ndarray) -> np.ndarray:
    """``TERMS`` x ``RANK``: right singular vectors of the passages' TF-IDF matrix over their singular values, times idf."""
    names = [f"c{k}" for k in range(RANK)]
    columns = ", ".join(f"{n} double" for n in names)

    def summed(step, label: str) -> np.ndarray:
        parts = table.select(F.xxhash64("doc_id", "tag").alias("seed"), "words").mapInArrow(step, f"{label} long, {columns}")
        sums = parts.groupBy(label).agg(*(F.sum(n).alias(n) for n in names)).orderBy(label).toArrow()
        out = np.zeros((TERMS if label == "term" else RANK, RANK))
        out[sums[label].to_numpy()] = np.stack([sums[n].to_numpy() for n in names], 1)
        return out

    def emit(total: np.ndarray, label: str) -> pa.RecordBatch:
        used = np.flatnonzero(total.any(1))
        return pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(total[used, c]) for c in range(RANK))], [label, *names])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TERMS * RANK)
        for part, docs in _groups(batches, 1):
            rows, weights = _weighted(docs, idf)
            if not len(rows):
                continue
            # signs and columns follow from the document and the passage's number: a task run again draws the same,
            # and copies of a passage don't add up as one direction
            size = np.array([-(-len(d) // WIDTH) for d in docs])
            number = np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size)
            seeds = part.column(0).to_numpy().view(np.uint64)
            with np.errstate(over="ignore"):
                key = np.repeat(seeds, size) * np.uint64(0x9E3779B97F4A7C15) + number.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(SEED)
                for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                    key = (key ^ (key >> np.uint64(shift))) * np.uint64(factor)
                key ^= key >> np.uint64(31)
            used = weights.ravel() > 0
            slot, value = rows.ravel()[used].astype(np.int64) * RANK, weights.ravel()[used]
            passage = np.repeat(np.arange(len(rows)), WIDTH)[used]
            # eight bits each: a sign, and a column of this share of the columns
            bits = (key[:, None] >> (np.uint64(8) * np.arange(SIGNS, dtype=np.uint64))) & np.uint64(255)
            column = (np.arange(SIGNS) * (RANK // SIGNS) + (bits >> np.uint64(1)) % np.uint64(RANK // SIGNS)).astype(np.int64)
            sign = (bits & np.uint64(1)).astype(np.float32) * 2 - 1
            total += np.bincount((slot[:, None] + column[passage]).ravel(), (value[:, None] * sign[passage]).ravel(), TERMS * RANK)
        yield emit(total.reshape(TERMS, RANK), "term")

    basis = np.linalg.qr(summed(spread, "term"))[0].astype(np.float32)
    shared = spark.sparkContext.broadcast(basis)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((RANK, RANK))
        for _, docs in _groups(batches, 1):
            rows, weights = _weighted(docs, idf)
            y = np.zeros((len(rows), RANK), np.float32)
            for k in range(WIDTH):
                y += shared.value[rows[:, k]] * weights[:, k : k + 1]
            total += y.T @ y
        yield emit(total, "row")

    values, turn = np.linalg.eigh(summed(products, "row"))
    return (basis @ turn / np.sqrt(np.maximum(values, values.max(initial=0) * 1e-9 + 1e-12)) * idf[:, None]).astype(np.float32)


def _laid_out(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All documents in one row, each filled up to whole strides and by a window of padding; and each one's first place."""
    size = np.array([-(-len(d) // STRIDE) * STRIDE + WIDTH for d in docs])
    first = np.cumsum(size) - size
    flat = np.zeros(int(size.sum()), np.uint16)
    for d, f in zip(docs, first.tolist()):
        flat[f : f + len(d)] = term_numbers(d)
    return flat, first


def _windows(basis: np.ndarray, flat: np.ndarray, widths: list[int]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Width, step and sum of latent vectors of the windows at each step, for each width."""
    rows = flat.reshape(-1, STEP)
    steps = basis[rows[:, 0]]
    for k in range(1, STEP):
        steps += basis[rows[:, k]]
    for width in widths:
        step = STRIDE if width == WIDTH else STEP
        parts = steps if step == STEP else steps[0::2] + steps[1::2]
        sums = parts.copy()
        for k in range(1, width // step):
            sums[:-k] += parts[k:]
        yield width, step, sums


def lcs_length(a: list[int], b: list[int]) -> int:
    """Longest common subsequence, 64 and more cells at once in one big integer."""
    places: dict[int, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        if hit := places.get(x):
            step = row & hit
            row = ((row + step) | (row - step)) & full
    return len(a) - row.bit_count()


class Items:
    """Benchmark items of one block: word hashes, answers as words and as terms, latent windows."""

    def __init__(self, ids: list[int], hashes: list[np.ndarray], answers: list[np.ndarray | None], basis: np.ndarray, idf: np.ndarray):
        self.ids, self.words = ids, [h.tolist() for h in hashes]
        terms = [term_numbers(h) for h in hashes]
        rarest = lambda h, w: h[np.argsort(-idf[w], kind="stable")[: -(-len(w) // 3)]]
        given = [a if a is not None and len(a) else rarest(h, w) for h, w, a in zip(hashes, terms, answers)]
        self.answers, self.answer_terms = [frozenset(a.tolist()) for a in given], [np.unique(term_numbers(a)) for a in given]
        #: by width: unit vectors of windows and their items
        self.windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for width in WIDTHS:
            own = [i for i, w in enumerate(terms) if self._width(len(w)) == width]
            if own:
                vectors = np.stack([basis[terms[i][at : at + width]].sum(0) for i in own for at in self._starts(len(terms[i]), width)])
                vectors /= np.maximum(np.sqrt(np.einsum("ij,ij->i", vectors, vectors)), 1e-12)[:, None]
                self.windows[width] = vectors, np.repeat(own, [len(self._starts(len(terms[i]), width)) for i in own])

    @staticmethod
    def _width(n: int) -> int:
        return next((w for w in WIDTHS if w <= n), WIDTHS[-1])

    @staticmethod
    def _starts(n: int, width: int) -> list[int]:
        return [*range(0, n - width, STRIDE if width == WIDTH else STEP), max(0, n - width)]


def _candidates(flat: np.ndarray, first: np.ndarray, items: Items, basis: np.ndarray) -> tuple[np.ndarray, ...]:
    """Item, document, start, width, cosine of windows near an item, one each start, in this order."""
    found = []
    for width, step, sums in _windows(basis, flat, list(items.windows)):
        vectors, owner = items.windows[width]
        unit = sums / np.maximum(np.sqrt(np.einsum("ij,ij->i", sums, sums)), 1e-12)[:, None]
        rows = max(16, PRODUCTS // len(owner))
        for lo in range(0, len(unit), rows):
            products = unit[lo : lo + rows] @ vectors.T
            near = np.flatnonzero(products.max(1) >= COSINE)
            if len(near):
                products = products[near]
                at, which = np.divmod(np.flatnonzero(products >= COSINE), len(owner))
                found.append((owner[which], (near[at] + lo) * step, np.full(len(at), width), products[at, which].astype(float)))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    item, place, width, cosine = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((-cosine, item * np.int64(len(flat)) + place))
    item, place, width, cosine = item[order], place[order], width[order], cosine[order]
    fresh = np.append(True, (item[1:] != item[:-1]) | (place[1:] != place[:-1]))
    item, place, width, cosine = item[fresh], place[fresh], width[fresh], cosine[fresh]
    doc = np.searchsorted(first, place, "right") - 1
    return item, doc, place - first[doc], width, cosine


def _answered(flat: np.ndarray, first: np.ndarray, sizes: np.ndarray, n: int, terms: np.ndarray, doc: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """Number of the answer's terms among the words around each start."""
    hit = np.zeros(len(doc), np.int64)
    for lo in range(0, len(terms), 64):
        bits = np.zeros(TERMS, np.uint64)
        bits[terms[lo : lo + 64]] = np.uint64(1) << np.arange(len(terms[lo : lo + 64]), dtype=np.uint64)
        for at in range(0, len(doc), 1024):
            d, s = doc[at : at + 1024], start[at : at + 1024]
            low, high = first[d] + np.maximum(0, s - n), first[d] + np.minimum(sizes[d], s + width + n) - 1
            places = np.minimum(low[:, None] + np.arange(width + 2 * n), high[:, None])
            hit[at : at + 1024] += np.bitwise_count(np.bitwise_or.reduce(bits[flat[places]], 1))
    return hit


def search(table: DataFrame, items: Items, basis: np.ndarray) -> DataFrame:
    """Rows of ``FOUND`` for one block of items, from (doc_id, tag, words)."""
    shared = table.sparkSession.sparkContext.broadcast((items, basis))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches.use("search")
        items, basis = shared.value
        for part, docs in _groups(batches, 2):
            flat, first = _laid_out(docs)
            sizes = np.array([len(d) for d in docs])
            item, doc, start, width, cosine = _candidates(flat, first, items, basis)
            best: dict[tuple[int, int], tuple] = {}
            cuts = np.flatnonzero(np.append(True, item[1:] != item[:-1])) if len(item) else item
            for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(item)]):
                i, w = int(item[lo]), int(width[lo])
                own, answer, terms = items.words[i], items.answers[i], items.answer_terms[i]
                # terms may coincide where words don't: they only rule places out
                least = ANSWER_SHARE * len(answer) - (len(answer) - len(terms))
                for k in np.flatnonzero(_answered(flat, first, sizes, len(own), terms, doc[lo:hi], start[lo:hi], w) >= least).tolist():
                    d, s = int(doc[lo + k]), int(start[lo + k])
                    if best.get((d, i), (0, 0.0))[1] >= 1.0:
                        continue
                    span = docs[d][max(0, s - len(own)) : s + w + len(own)].tolist()
                    share = len(answer.intersection(span)) / len(answer)
                    if share < ANSWER_SHARE:
                        continue
                    lcs = lcs_length(own, span) / len(own)
                    if lcs >= LCS_SHARE and lcs > best.get((d, i), (0, 0.0))[1]:
                        best[d, i] = (float(cosine[lo + k]), lcs, share, s)
            if best:
                keys = list(best)
                at = pa.array([d for d, _ in keys])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array([items.ids[i] for _, i in keys], pa.int64()), *(pa.array([best[k][j] for k in keys], pa.float64()) for j in range(3)), pa.array([best[k][3] for k in keys], pa.int64())],
                    FOUND_NAMES,
                )

    return table.select("doc_id", "tag", "words").mapInArrow(find, FOUND)


def search_exact(docs: DataFrame, items: list[tuple[int, list[str]]]) -> DataFrame:
    """Rows of ``FOUND`` for items whose words stand in a text as they are, from (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_word: dict[str, list[tuple[int, list[str]]]] = {}
        for i, words in shared.value:
            by_word.setdefault(words[0], []).append((i, words))
        for batch in batches:
            out = []
            for doc_id, tag, text in zip(*(c.to_pylist() for c in batch.columns)):
                found: dict[int, int] = {}
                words = [_core(w) for w in (text or "").lower().split()]
                for at, word in enumerate(words):
                    for i, own in by_word.get(word, ()):
                        if i not in found and words[at : at + len(own)] == own:
                            found[i] = at
                out += [(doc_id, tag, i, 1.0, 1.0, 1.0, at) for i, at in found.items()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (*[pa.int64()] * 3, *[pa.float64()] * 3, pa.int64()))], FOUND_NAMES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"), "text").mapInArrow(find, FOUND)


def _find(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, scratch: Scratch, answer_col: str | None) -> DataFrame:
    table = scratch.save(encode_words(docs), "words")
    idf = inverse_frequencies(table)
    basis = latent_basis(spark, table, idf)
    rows = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text", (F.col(answer_col) if answer_col else F.lit(None).cast("string")).alias("answer"))
    out, block, short, size = [], [], [], 0

    def flush() -> None:
        if block:
            items = Items([r.item_id for r in block], [word_hashes(r.text) for r in block], [word_hashes(r.answer) if r.answer else None for r in block], basis, idf)
            out.append(search(table, items, basis))
        if short:
            out.append(search_exact(docs, list(short)))

    for r in rows.orderBy("item_id", "text").toLocalIterator():
        own = [_core(w) for w in r.text.lower().split()]
        if len(own) >= MIN_WORDS:
            block.append(r)
        elif own:
            short.append((r.item_id, own))
        size += len(own)
        if size >= BLOCK_WORDS:
            flush()
            block, short, size = [], [], 0
    flush()
    return reduce(DataFrame.unionByName, out, spark.createDataFrame([], FOUND))


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, scratch: Scratch, answer_col: str | None = None) -> DataFrame:
    """Rows of ``LEAKS``: one for each document and benchmark item that it holds."""
    return _find(spark, docs, benchmark, scratch, answer_col).drop("tag")


def drop_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows, all columns, that hold no benchmark item."""
    bad = _find(spark, docs, benchmark, scratch, None).select(F.col("doc_id").alias("__weft_id"), F.col("tag").alias("__weft_tag")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(bad["__weft_id"]) & (F.xxhash64(docs["text"]) == bad["__weft_tag"])
    return docs.join(bad, same, "left_anti")
