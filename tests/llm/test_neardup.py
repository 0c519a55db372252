import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weft.llm import neardup
from weft.llm.graph import components
from weft.scratch import Scratch


def brute(rows):
    def grams(t):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = [grams(t) for _, t in rows]
    up = {i: i for i, _ in rows}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for x in range(len(rows)):
        for y in range(x):
            n = len(sets[x] & sets[y])
            if n and 100 * n >= 75 * len(sets[x] | sets[y]):
                a, b = sorted((find(rows[x][0]), find(rows[y][0])))
                up[b] = a
    return sorted((i, len(s), find(i)) for (i, _), s in zip(rows, sets))


def corpus(seed, block=None):
    rng = random.Random(seed)
    word = lambda: "w" + str(rng.randrange(3000))
    passage = [word() for _ in range(30)]
    texts = [None, "", "  \n", "one", "ONE", "a b c", "a b  c", "a b c d e", "\x1c a b c d e", " ".join(passage)]
    for _ in range(25):
        base = [word() for _ in range(rng.randrange(5, 300))]
        texts += [" ".join(base), " ".join(base)]
        for _ in range(rng.randrange(6)):
            edit = list(base)
            for _ in range(rng.randrange(1, 2 + len(base) // 25)):
                edit[rng.randrange(len(edit))] = word()
            texts.append(" ".join(edit))
        texts.append(" ".join([word() for _ in range(40)] + passage))
    base = [word() for _ in range(120)]
    for _ in range(60):  # a large group at about the threshold
        edit = list(base)
        for _ in range(rng.randrange(1, 5)):
            edit[rng.randrange(len(edit))] = word()
        texts.append(" ".join(edit))
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


def run(spark, rows):
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, rep int").repartition(3)
    return neardup.near_duplicates(spark, docs, Scratch(spark, "test"))


@pytest.mark.parametrize("small_list,centre_rows,block", [(32, 7, 512), (2, 256, 16)])
def test_components_equal_brute_force(spark, monkeypatch, small_list, centre_rows, block):
    for name, value in (("SMALL_LIST", small_list), ("CENTRE_ROWS", centre_rows), ("BLOCK", block)):
        monkeypatch.setattr(neardup, name, value)
    rows = corpus(5 + block)
    got = run(spark, rows).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_null_ids_repeated_ids_and_empty(spark):
    long = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(None, long), (7, long), (7, long), (9, long), (9, "other text entirely with nine words in it now"), (12, "other text entirely with nine words in it now")]
    got = run(spark, rows).collect()
    assert len(got) == 6
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(None, None, True), (7, 7, True), (9, 7, False), (12, 7, False)}
    assert run(spark, []).count() == 0


def test_components_of_a_path(spark):
    edges = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    got = components(edges, Scratch(spark, "test"))
    assert got.where("root = 0").count() == 200 == got.count()


def test_drop_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (3, None, "z"), (None, "a b c d e f", "n")], "doc_id long, text string, root string")
    out = neardup.drop_duplicates(spark, docs, Scratch(spark, "test"))
    assert out.columns == docs.columns and {r.root for r in out.collect()} == {"x", "z", "n"}


def test_long_and_repeated_texts(spark):
    rng = random.Random(8)
    base = ["w%d" % rng.randrange(10**6) for _ in range(60_000)]
    near = list(base)
    for at in rng.sample(range(len(near)), 1500):
        near[at] = "x"
    far = list(base)
    for at in rng.sample(range(len(far)), 6000):
        far[at] = "y%d" % at
    rows = [(5, " ".join(base)), (4, " ".join(near)), (3, " ".join(far)), *[(2, " ".join(base))] * 3, (1, "a b c d e f")]
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in run(spark, rows).collect()) == sorted(brute(rows))


def pair_at(rng, size, least, most):
    """Two sets of random values whose similarity lies between the bounds."""
    while True:
        union = rng.integers(1, 2**63, size, np.uint64)
        common = int(np.ceil(size * rng.uniform(least, most)))
        side = rng.random(size - common) < rng.choice([0.0, 0.5, 1.0])
        if size and 100 * common >= neardup.PERCENT * size:
            return np.sort(np.append(union[:common], union[common:][side])), np.sort(np.append(union[:common], union[common:][~side]))


def test_every_pair_at_the_threshold_is_a_candidate():
    rng = np.random.default_rng(9)
    sizes = [*range(1, 140), 200, 500, 3000]
    for k in range(20_000):
        a, b = (np.unique(x) for x in pair_at(rng, sizes[k % len(sizes)], 0.75, 0.80))
        if len(a) == len(b) and (a == b).all():
            continue  # one set: one document
        assert neardup.reaches(a, b)
        a, b = a[: neardup.SKETCH], b[: neardup.SKETCH]
        assert np.intersect1d(neardup.run_keys(a), neardup.run_keys(b)).size and neardup.may_reach(a, b)


def test_shared_passages_make_no_group(spark):
    """Documents put together from passages that others share: few pairs although all documents hang together."""
    rng = random.Random(3)
    passages = [" ".join("w%d" % rng.randrange(10**5) for _ in range(30)) for _ in range(400)]
    docs = spark.createDataFrame([(i, " ".join(rng.sample(passages, 10))) for i in range(1500)], "doc_id long, text string")
    marks = neardup.sketches(docs).select(F.col("doc_id").alias("rep"), "sketch")
    listed, _ = neardup.inverted_lists(marks, Scratch(spark, "test"))
    pairs = listed.groupBy("key").agg(F.first("n").alias("n")).agg(F.sum(F.expr("n * (n - 1) / 2"))).first()[0] or 0
    assert pairs < 10 * 1500
