import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from weft.llm import packing, tokens
from weft.llm.queries import op3_packing

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", "Hello, World's 3,14 ÉCOLE x\x1cy İstanbul <|endoftext|> é", "a" * 5000 + "   don't | ||", "ünï " * 900, "tail\n\n\nlines\tπΣ ΑΣ ,.;"] + [f"Wort{i} the of, erthly " * (i % 7) for i in range(60)]


def test_words_equal_the_tokenizer():
    plain, words = Tokenizer.from_file(VOCABULARY), tokens.WordTokens(VOCABULARY)
    texts = [t or "" for t in TEXTS]
    for got, text in zip(words.encode(texts), texts):
        assert np.frombuffer(got, "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids, text[:40]


def stepwise(totals, shares):
    """Queue of each token in turn: the one whose next token is due first; those without a share when the others are dry."""
    given, out = [0] * len(totals), []
    for late in (False, True):
        own = [q for q in range(len(totals)) if (shares[q] <= 0) == late]
        while live := [q for q in own if given[q] < totals[q]]:
            due = [(given[q] + 0.5) / (totals[q] if late else shares[q]) for q in live]
            q = live[due.index(min(due))]
            out.append((q, given[q]))
            given[q] += 1
    return out


SCHEDULES = [([5000, 3, 7000, 1], None), ([900, 900, 100], [1.0, 3.0, 1.0]), ([1], None), ([300, 500, 200, 64], [0.0, 0.7, 0.3, 0.0]), ([200, 100], [0.0, 0.0]), ([0, 50, 70], [0.5, 0.5, 0.0])]


@pytest.mark.parametrize("totals,shares", SCHEDULES)
def test_schedule_equals_a_stepwise_round_robin(totals, shares):
    totals = np.array(totals)
    s = packing.Schedule(totals, np.array(shares) if shares else totals.astype(float), window=64)
    t = np.concatenate([np.arange(n) for n in totals])
    q = np.repeat(np.arange(len(totals)), totals)
    place = {x: k for k, x in enumerate(stepwise(totals.tolist(), s.shares.tolist()))}
    rank = np.array([place[x] for x in zip(q.tolist(), t.tolist())])
    assert (s.rank(t, q) == rank).all()
    windows = np.arange(len(t) // 64 + 2)
    taken = s.taken(windows)
    for w in windows:
        assert taken[w].tolist() == [int(((rank < 64 * w) & (q == k)).sum()) for k in range(len(totals))]
    assert (s.quanta(windows).sum(1)[:-2] == 64).all() and (s.quanta(windows).sum(0) == totals).all()
    if not shares and len(windows) > 2:  # no queue is ever owed or ahead by more than a token or so
        assert abs(s.deficits(windows[:-2])).max() <= 2


def test_shares_of_a_mixture():
    totals = np.array([100, 100, 300, 0])
    share = lambda m: packing.target_shares(["a", "b", "c", "d"], totals, m).round(3).tolist()
    assert share({"a": 0.8}) == [0.8, 0.05, 0.15, 0.0]
    assert share({"a": 0.0, "b": 1.0}) == [0.0, 1.0, 0.0, 0.0]
    assert share({"x": 0.5}) == [0.1, 0.1, 0.3, 0.0]
    for bad in ({"a": -0.1}, {"a": 0.7, "b": 0.7}):
        with pytest.raises(ValueError):
            share(bad)


@pytest.mark.parametrize("mixture", [{"a": 0.8}, {"a": 0.0, "b": 1.0}, {"nobody": 0.5, "b": 0.25}])
def test_windows_hold_the_mixture(spark, mixture):
    from weft.scratch import Scratch

    docs = spark.createDataFrame([(i, f"Wort{i} the of, erthly " * (i % 97), "ab"[i % 2]) for i in range(400)], "doc_id long, text string, source string").repartition(4)
    pieces = packing.pack(spark, docs, Scratch(spark, "test"), VOCABULARY, mixture).select("doc_id", "length", "sequence_id", "offset").toPandas()
    plain = Tokenizer.from_file(VOCABULARY)
    tokens_ = {r.doc_id: len(plain.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect()}
    assert pieces.groupby("doc_id").length.sum().to_dict() == tokens_  # nothing is lost
    pieces["source"] = pieces.doc_id % 2
    given = pieces.groupby(["sequence_id", "source"]).length.sum().unstack(fill_value=0)
    totals = np.array([sum(n for i, n in tokens_.items() if i % 2 == q) for q in (0, 1)])
    target = packing.target_shares(["a", "b"], totals, mixture)
    target = target / target.sum()
    full = given[(given.cumsum() < totals).all(axis=1)]  # until a queue is dry
    assert len(full) > 3 or 0.0 in target
    assert abs(full.to_numpy() - 2048 * target).max(initial=0) <= 2


def test_many_sources(spark):
    from weft.scratch import Scratch

    docs = spark.createDataFrame([(i, "the of erthly", f"s{i}") for i in range(5000)], "doc_id long, text string, source string")
    pieces = packing.pack(spark, docs, Scratch(spark, "test"), VOCABULARY, {"s7": 1.0}).select("doc_id", "length", "sequence_id", "offset").collect()
    assert len({r.doc_id for r in pieces}) == 5000 and {r.sequence_id for r in pieces if r.doc_id == 7} == {0}


def test_every_id_lies_in_one_piece(spark, tmp_path):
    plain = Tokenizer.from_file(VOCABULARY)
    rows = [(i, t, [None, "a", "b"][i % 3], "clash") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "a", "")]
    spark.createDataFrame(rows, "doc_id long, text string, source string, ids string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = op3_packing(spark, str(tmp_path)).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(range(len(TEXTS)))
    for i, pieces in by_doc.items():
        ids = np.array(plain.encode(TEXTS[i] or "", add_special_tokens=False).ids + [1], "<u4")
        copies = 2 if i == 3 else 1
        assert sum(p.length for p in pieces) == copies * len(ids)
        for p in pieces:
            assert p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    for k, pieces in by_sequence.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 2048 or k == max(by_sequence)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert op3_packing(spark, str(tmp_path)).count() == 0
