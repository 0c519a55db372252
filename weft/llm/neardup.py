"""Near-duplicates: bottom-k sketches of one hash function, inverted lists, exact verification.

1. A document is the set of hashes of its word shingles; its sketch is the ``SKETCH`` smallest.
   Documents with one set are one from here on, under the smallest id.
2. Inverted lists of retained values. A list's key is a run of ``RUN`` values that stand side by side
   among the ``LISTED`` smallest: two sets of similarity 0.75 agree on each value of their union with that
   chance, so they miss every common run once in 10^9, while sets that share a passage or two rarely have one.
   Sets of up to ``SMALL_SET`` shingles are listed by runs of two as well; for sets of at most ``LISTED``
   shingles a common run is certain.
3. Candidates are pairs from the lists. First every member meets its list's centre, the member with the
   longest lists. The estimate from the union's sketch drops pairs that can't reach the threshold (``LEAST``
   of its values in common: below once in 10^8 pairs at the threshold); the others are compared with full sets
   taken from the whole texts. Documents linked to one centre are a part and need no more pairs.
4. Lists whose members are still of several parts give the pairs across them: one by one in lists of
   up to ``SMALL_LIST`` members, longer ones in blocks of bounded size in which members of the largest
   part don't meet each other. Blocks give back one tie a document, never pairs.

Edge cases. A null or empty text has no shingles, links with nothing and is kept; so does and is
a row without an id. Rows of one doc_id are one node. An empty table gives an empty result.
Further columns are ignored by :func:`near_duplicates` and kept by :func:`drop_duplicates`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import caches, words
from weft.llm.graph import components
from weft.scratch import Scratch

SHINGLE, SKETCH, LISTED, RUN, SMALL_SET = 5, 96, 72, 3, 8
#: Of so many values of a union's whole sketch, two sets of similarity 0.75 have fewer than ``LEAST`` in common
#: once in 10^8 pairs; shorter sketches are whole sets, of which three quarters have to be.
LEAST = 45
#: Members that meet a centre in one go; members of lists that give pairs; documents and shingles of a block.
CENTRE_ROWS, SMALL_LIST, BLOCK, BLOCK_SHINGLES = 256, 32, 512, 1 << 20
#: 100 * intersection >= PERCENT * union links two sets.
PERCENT = 75


def _shingle_hashes(one: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` neighbouring words at every place."""
    n = len(one) - size + 1
    with np.errstate(over="ignore"):
        h = np.full(n, size, np.uint64)
        for k in range(size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + one[k : k + n]
    return words.mixed(h)


def sets_of(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the 5-word shingles of each text; of the whole text if it has fewer words."""
    raw = [(t or "").encode().lower() for t in texts]  # bytes: exactly A-Z, exactly the six blanks
    for lo, hi in words.slices(list(map(len, raw)), 2 * words.CHUNK_BYTES):
        flat, counts = words.hash_words(raw[lo:hi])
        whole = _shingle_hashes(flat, SHINGLE) if len(flat) >= SHINGLE else flat[:0]
        at = 0
        for n in counts.tolist():
            if n >= SHINGLE:
                yield np.unique(whole[at : at + n - SHINGLE + 1])
            else:
                yield _shingle_hashes(flat[at : at + n], n) if n else flat[:0]
            at += n


def shingles(text: str | None) -> np.ndarray:
    return next(sets_of([text]))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, digest of the set (null: empty), sketch."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches.use("neardup")
        for batch in batches:
            sizes, digests, own = [], [], []
            for s in (s for part in words.parts_of(batch.column(1)) for s in sets_of(part)):
                sizes.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                own.append(s[:SKETCH].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(own, pa.binary())], ["doc_id", "n_shingles", "digest", "sketch"])

    return rows.mapInArrow(make, "doc_id long, n_shingles long, digest binary, sketch binary")


def run_keys(sketch: np.ndarray) -> np.ndarray:
    """Keys of the runs of a sketch's smallest values."""
    v, out = sketch[:LISTED], []
    with np.errstate(over="ignore"):
        for size in (RUN, 2) if len(sketch) <= SMALL_SET else (RUN,):
            n = len(v) - size + 1
            if n > 0:
                h = np.full(n, size, np.uint64)
                for k in range(size):
                    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + v[k : k + n]
                out.append((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def inverted_lists(reps: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(key, rep, n) of lists of n > 1 members and (key, centre), from (rep, sketch)."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [run_keys(np.frombuffer(s.as_py(), np.uint64)) for s in batch.column(1)]
            if sum(map(len, keys)):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.repeat(batch.column(0).to_numpy(), list(map(len, keys))))], ["key", "rep"])

    postings = reps.select("rep", "sketch").mapInArrow(explode, "key long, rep long")
    sizes = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    listed = scratch.save(postings.join(sizes, "key"), "listed")
    weight = listed.groupBy("rep").agg(F.sum("n").alias("weight"))
    centres = listed.select("key", "rep").join(weight, "rep").groupBy("key").agg(F.max_by("rep", F.struct("weight", -F.col("rep"))).alias("centre"))
    return listed, scratch.save(centres, "centres")


def may_reach(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the union's sketch leaves the threshold possible; sketches under ``SKETCH`` values are whole sets."""
    whole, both = max(len(a), len(b)) < SKETCH, np.union1d(a, b)
    if whole:
        return 100 * (len(a) + len(b) - len(both)) >= PERCENT * len(both)
    both = both[:SKETCH]
    return int((np.isin(both, a, assume_unique=True) & np.isin(both, b, assume_unique=True)).sum()) >= LEAST


def reaches(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact comparison of full sets."""
    if not len(a) or not len(b):
        return False
    at = np.searchsorted(a, b)
    n = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return 100 * n >= PERCENT * (len(a) + len(b) - n)


def compare_pairs(pairs: DataFrame, payloads: DataFrame, read: Callable, judge: Callable, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) that ``judge`` accepts; ``payloads`` is (rep, data).

    Each b stands in front of at most about ``CENTRE_ROWS`` of its partners, which stream past it."""
    crowded = pairs.groupBy("b").agg(F.count("*").alias("n")).where(F.col("n") > CENTRE_ROWS).select("b", F.ceil(F.col("n") / CENTRE_ROWS).alias("salts"))
    crowded = scratch.save(crowded, "crowded")  # one row for each CENTRE_ROWS pairs at most: as a saved table its size is known to the planner
    dealt = pairs.join(crowded, "b", "left").select("a", "b", F.pmod(F.xxhash64("a"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"))
    front = dealt.select(F.col("b").alias("rep"), "b", "salt", F.lit(0).alias("role")).distinct()
    rows = front.unionByName(dealt.select(F.col("a").alias("rep"), "b", "salt", F.lit(1).alias("role"))).join(payloads, "rep")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches.use("neardup")
        key, fronts = None, []
        for batch in batches:
            found = []
            for b, salt, role, rep, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4)):
                if (b, salt) != key:
                    key, fronts = (b, salt), []
                own = read(data.as_py())
                if not role:
                    fronts.append(own)
                elif any(judge(own, f) for f in fronts):
                    found.append((rep, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    ordered = rows.select("b", "salt", "role", "rep", "data").repartition("b", "salt").sortWithinPartitions("b", "salt", "role")
    return ordered.mapInArrow(work, "a long, b long")


class _Union:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, a: int) -> int:
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def tie(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of a bounded block of sets."""
    m = len(sets)
    flat = np.concatenate(sets) if m else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    fresh = np.ones(len(flat), bool)
    fresh[1:] = flat[1:] != flat[:-1]
    column = np.cumsum(fresh) - 1
    count = np.bincount(column) if len(flat) else np.zeros(0, int)
    keep = count[column] > 1 if len(flat) else np.zeros(0, bool)
    row, column = row[keep], column[keep]
    if len(column):
        column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
    out, width = np.zeros((m, m), np.float32), 4096
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        dense = np.zeros((m, width), np.float32)
        dense[row[a:b], column[a:b] - lo] = 1
        out += dense @ dense.T
    return out.astype(np.int64)


def verified(sets: list[np.ndarray], allowed: np.ndarray) -> _Union:
    """Ties of full sets that reach the threshold, among allowed pairs that their sketches don't rule out."""
    union, sketches_ = _Union(len(sets)), [s[:SKETCH] for s in sets]
    sizes = np.array([len(s) for s in sketches_])
    # what a union's whole sketch has in common, both sketches have
    least = np.where(np.maximum(sizes[:, None], sizes[None]) < SKETCH, np.ceil(PERCENT / 100 * np.maximum(sizes[:, None], sizes[None])), LEAST)
    maybe = allowed & (overlaps(sketches_) >= np.maximum(least, 1))
    at = np.flatnonzero(maybe.any(0) | maybe.any(1))
    if not len(at):
        return union
    full = [sets[k] for k in at]
    shared, sizes = overlaps(full), np.array([len(s) for s in full])
    linked = maybe[np.ix_(at, at)] & (100 * shared >= PERCENT * (sizes[:, None] + sizes[None] - shared))
    for a, b in zip(*np.nonzero(np.triu(linked, 1))):
        union.tie(int(at[a]), int(at[b]))
    return union


def compare_blocks(members: DataFrame) -> DataFrame:
    """(a, b): ties of the links inside each group of ``members`` (root, rep, part, size, data: text) between
    members of different ``part``.

    A group is dealt into blocks of about ``BLOCK`` members and ``BLOCK_SHINGLES`` shingles, those of its largest
    part apart from the others; each pair of blocks is a unit of work of bounded size, wherever its rows lie, and
    pairs of blocks of the largest part are none."""
    parts = members.groupBy("root", "part").agg(F.count("*").alias("n"), F.sum("size").alias("total"))
    blocks = lambda n, total: F.ceil(F.greatest(n / BLOCK, total / BLOCK_SHINGLES)).cast("int")
    largest = parts.groupBy("root").agg(F.max_by(F.struct("part", "n", "total"), F.struct("n", "part")).alias("big"), F.sum("n").alias("n_all"), F.sum("total").alias("total_all"))
    rest = largest.where("n_all > big.n").select(
        "root",
        F.col("big.part").alias("big_part"),
        blocks(F.col("big.n"), F.col("big.total")).alias("big_blocks"),
        blocks(F.col("n_all") - F.col("big.n"), F.col("total_all") - F.col("big.total")).alias("rest_blocks"),
    )
    chance = F.xxhash64("rep")
    big = F.col("part") == F.col("big_part")
    block = F.when(big, F.pmod(chance, F.col("big_blocks"))).otherwise(F.col("big_blocks") + F.pmod(chance, F.col("rest_blocks"))).cast("int")
    dealt = members.join(rest, "root").withColumn("block", block)
    others = F.sequence(F.when(big, F.col("big_blocks")).otherwise(F.lit(0)), F.col("big_blocks") + F.col("rest_blocks") - 1)
    units = dealt.select("root", "rep", "part", "block", "data", F.explode(others).alias("other"))
    units = units.select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep", "part", "block", "data")

    def unit(rows: list[tuple], same: bool) -> tuple[list, list]:
        """Rows of a unit: block, rep, part, payload; ties of one block are found where it meets itself."""
        rows = sorted(rows, key=lambda r: r[1])
        blocks, part = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
        allowed = part[:, None] != part[None]
        if not same:
            allowed &= blocks[:, None] != blocks[None]
        union = verified(list(sets_of([r[3] for r in rows])), allowed)
        ties = [(rows[k][1], rows[union.find(k)][1]) for k in range(len(rows)) if union.find(k) != k]
        return [a for a, _ in ties], [b for _, b in ties]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches.use("neardup")
        key, rows = None, []

        def close() -> Iterator[pa.RecordBatch]:
            if len(rows) > 1:
                a, b = unit(rows, key[1] == key[2])
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for root, i, j, rep, part, block, data in zip(*(c.to_pylist() for c in batch.columns)):
                if (root, i, j) != key:
                    yield from close()
                    key, rows = (root, i, j), []
                rows.append((block, rep, part, data))
        yield from close()

    return units.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(work, "a long, b long")


def links(reps: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): links that join all sets of one component, from (rep, sketch, size) and (doc_id, text)."""
    listed, centres = inverted_lists(reps, scratch)
    # members of lists are of no bounded size: what belongs to them is dealt out once, at any size in the same way
    ids = scratch.save(listed.select("rep").distinct(), "members").hint("merge")
    sketch = lambda raw: np.frombuffer(raw, np.uint64)
    sketches_ = scratch.save(reps.join(ids, "rep", "left_semi").select("rep", F.col("sketch").alias("data"), "size"), "member-sketches")
    whole = texts.select(F.col("doc_id").alias("rep"), F.col("text").alias("data")).join(ids, "rep", "left_semi")
    whole = scratch.save(whole.dropDuplicates(["rep", "data"]), "member-texts")

    def verified_pairs(pairs: DataFrame, name: str) -> DataFrame:
        close = scratch.save(compare_pairs(pairs, sketches_.drop("size"), sketch, may_reach, scratch).distinct(), f"{name}-close")
        return scratch.save(compare_pairs(close, whole, shingles, reaches, scratch), f"{name}-links")

    stars = scratch.save(listed.join(centres, "key").where("rep <> centre").select(F.col("rep").alias("a"), F.col("centre").alias("b")).distinct(), "stars")
    first = verified_pairs(stars, "stars")
    # documents linked to one centre are one part; a coarser division would be as right and spare more pairs
    joined = first.groupBy(F.col("a").alias("rep")).agg(F.min("b").alias("root"))
    named = listed.join(joined, "rep", "left").select("key", "rep", "n", F.coalesce("root", "rep").alias("part"))
    several = named.groupBy("key").agg(F.min("part").alias("least"), F.max("part").alias("most")).where("least <> most").select("key")
    # a list of two is its star
    still_open = scratch.save(named.where("n > 2").join(several, "key"), "open")
    short = still_open.where(F.col("n") <= SMALL_LIST).select("key", "rep", "part")
    across = short.toDF("key", "a", "part_a").join(short.toDF("key", "b", "part_b"), "key").where("a < b and part_a <> part_b").select("a", "b").distinct()
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    second = verified_pairs(across.join(tried, ["a", "b"], "left_anti"), "across")
    out = first.unionByName(second)

    long = still_open.where(F.col("n") > SMALL_LIST)
    if long.isEmpty():
        return out
    # documents that hang together by long lists meet once, whatever number of lists they share
    ties = long.join(centres, "key").where("rep <> centre").select(F.col("rep").alias("a"), F.col("centre").alias("b"))
    group = components(ties, scratch).withColumnRenamed("node", "rep")
    sizes = sketches_.groupBy("rep").agg(F.max("size").alias("size"))
    members = group.join(long.select("rep", "part").distinct(), "rep").join(sizes, "rep").join(whole, "rep")
    return out.unionByName(compare_blocks(members))


def near_duplicates(spark: SparkSession, docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row for each row of ``docs``."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marks = scratch.save(sketches(texts), "sketches")
    known = marks.where("digest is not null and doc_id is not null")
    one_set = known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("size"))
    groups = scratch.save(one_set, "groups")
    # rows that share an id are one node even if their texts differ
    same_id = known.groupBy("doc_id").agg(F.count_distinct("digest").alias("n")).where("n > 1").select("doc_id")
    several = known.join(same_id, "doc_id").join(groups.select("digest", "rep"), "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = links(groups.select("rep", "sketch", "size"), texts, scratch)
    roots = scratch.save(components(found.unionByName(several), scratch), "roots")
    copies = groups.where("copies > 1").select("digest", F.col("rep").alias("first_id"))
    named = marks.select("doc_id", "n_shingles", "digest").join(copies, "digest", "left").withColumn("node", F.coalesce("first_id", "doc_id"))
    out = named.join(roots, "node", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "node")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_duplicates(spark: SparkSession, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows, all columns, of the smallest id of each component."""
    gone = near_duplicates(spark, docs, scratch).where(~F.col("kept")).select(F.col("doc_id").alias("__weft_id")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["__weft_id"], "left_anti")
