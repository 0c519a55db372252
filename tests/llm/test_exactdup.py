import hashlib
import random

import numpy as np
import pytest

from weft.llm import exactdup
from weft.llm.queries import op6_repeated_bytes
from weft.scratch import Scratch


def brute(rows, length=exactdup.LENGTH):
    seen, out = {}, []
    for i, text in sorted(rows, key=lambda r: r[0]):
        raw, gone = (text or "").encode(), None
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            w = raw[k : k + length]
            if w in seen:
                gone[k : k + length] = b"\1" * length
            else:
                seen[w] = i
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(raw)))
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "é", "ing%d" % rng.randrange(50), "w%d" % rng.randrange(900)])
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randrange(14, 60)) for _ in range(6)]
    texts = [None, "", "short", "a" * 99, "a" * 100, "a" * 101, "ab" * 300, "\0" * 150 + "x", "\0" * 149, prose(3000)]
    for _ in range(60):
        own = prose(rng.randrange(5, 150))
        texts.append(own)
        if rng.random() < 0.4:
            texts.append(own)
        if rng.random() < 0.5:
            words = own.split()
            words[rng.randrange(len(words))] = word()
            texts.append(" ".join(words))
        if rng.random() < 0.6:
            texts.append(prose(rng.randrange(40)) + rng.choice(["", " "]) + rng.choice(passages) + prose(rng.randrange(40)))
    rng.shuffle(texts)
    return [(i * 2, t) for i, t in enumerate(texts)]


def test_grams_hash_their_own_bytes_only():
    data = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz" * 5 + b"?" + b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    h = exactdup._gram_hashes(data)
    assert len(h) == len(data) - exactdup.GRAM + 1 and h[0] == h[26] == h[131] and len(set(h.tolist())) > 26


def quoted(seed):
    """One passage between different words in most documents."""
    rng = random.Random(seed)
    prose = lambda n: " ".join("w%d" % rng.randrange(900) for _ in range(n))
    passage = prose(40)
    return [(i, prose(rng.randrange(1, 25)) + rng.choice(["", " "]) + passage + prose(rng.randrange(1, 25))) for i in range(250)]


@pytest.mark.parametrize("seed,small,hot", [(1, False, False), (2, True, False), (3, True, True)])
def test_equals_brute_force(spark, tmp_path, monkeypatch, seed, small, hot):
    rows = corpus(seed)
    if small:  # many runs, ranges and parts
        for name, value in (("RUN_BYTES", 9000), ("RANGE_BYTES", 15000), ("PART_BYTES", 700)):
            monkeypatch.setattr(exactdup, name, value)
    if hot:  # grams that fill ranges of their own
        for name, value in (("RANGE_BYTES", 2000), ("RANGE_SAMPLES", 100), ("HOT_RANGES", 1)):
            monkeypatch.setattr(exactdup, name, value)
        rows = quoted(seed)
        keyed = exactdup._keyed(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
        cuts = exactdup.splitters(keyed, Scratch(spark, "test"))
        assert max(map(cuts.count, cuts)) > 1
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = op6_repeated_bytes(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_repeated_rows_and_null_ids(spark, tmp_path):
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(None, long), (5, long), (5, long), (8, long), (5, "other " * 60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r.doc_id, r.n_bytes, r.n_removed) for r in op6_repeated_bytes(spark, str(tmp_path)).collect()]
    n = len(long)
    assert sorted(got, key=str) == sorted([(None, n, n), (5, n, 0), (5, n, 0), (8, n, n), (5, 360, 354)], key=str)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert op6_repeated_bytes(spark, str(tmp_path)).count() == 0


def test_pack_round_trip():
    run, _ = exactdup.sorted_run(exactdup.suffixes([(i, 3, exactdup.plain_bytes(t)) for i, t in corpus(4) if t and len(t) > 120]))
    back = exactdup._unpack(run.pack())
    for a, b in zip(back, (run.right, run.right_size, run.left, run.left_size, run.where)):
        assert np.array_equal(a, b)


def test_windows_of_hot_suffixes():
    rng = random.Random(5)
    texts = [(i, 1, bytes(rng.choice(b"ab") for _ in range(rng.randrange(90, 260)))) for i in range(40)] + [(50, 1, b"x" * 300), (51, 1, b"x" * 120)]
    rows = exactdup.window_rows(exactdup.suffixes(texts))
    by_hash, by_bytes = {}, {}
    raw = {i: t for i, _, t in texts}
    assert len(rows) == sum(max(0, len(t) - 99) for t in raw.values())
    for a, b, i, _, start in rows.tolist():
        by_hash.setdefault((a, b), set()).add((i, start))
        by_bytes.setdefault(raw[i][start : start + 100], set()).add((i, start))
    assert sorted(map(sorted, by_hash.values())) == sorted(map(sorted, by_bytes.values()))
    first, late = exactdup.first_windows(rows)
    assert {(i, s) for _, _, i, _, s in first.tolist()} == {min(v) for v in by_bytes.values()} and len(late) == len(rows) - len(by_bytes)
