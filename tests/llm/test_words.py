"""Words found and hashed in bulk against plain splitting."""

import random

import numpy as np
import pytest

from weft.llm import decontam, words

TEXTS = ["", " ", "a", "A  b\tc\n", "\x1cx\x1f y", "é\x85ü\xa0z w　v", "..a.. --- (b,c) !?", "#" * 40 + "x" + "$" * 40, "." * 50, "  tail ", "one\x0btwo\x0cthree", "İstanbul ΑΣ"]


def corpus():
    rng = random.Random(4)
    signs = "abcÀéß,.!#-_ \t\n\x1d\x85 "
    return TEXTS + ["".join(rng.choice(signs) for _ in range(rng.randrange(200))) for _ in range(300)]


@pytest.mark.parametrize("chunk", [1 << 20, 64])
def test_words_of_texts(monkeypatch, chunk):
    monkeypatch.setattr(words, "CHUNK_BYTES", chunk)
    texts = [t.encode() for t in corpus()] + [b"y" * 500 + b" z"]
    whole, start, end, hashes, counts = words.find_words(texts)
    found = [whole[a:b] for a, b in zip(start, end)]
    assert found == [w for t in texts for w in t.split()] and counts.tolist() == [len(t.split()) for t in texts]
    by_word = {}
    for w, h in zip(found, hashes.tolist()):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    assert words.find_words([])[4].tolist() == [] and words.hash_words([b"", b" "])[1].tolist() == [0, 0]


def test_lower_case_words_without_edges():
    texts = corpus()
    expected = [[decontam._core(w) for w in t.lower().split()] for t in texts]
    got = decontam.hashes_of(texts)
    assert [len(h) for h in got] == [len(w) for w in expected]
    by_word = {}
    for ws, hs in zip(expected, got):
        for w, h in zip(ws, hs.tolist()):
            assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_hashes_use_all_bits():
    flat, _ = words.hash_words([" ".join(f"w{k}" for k in range(50_000)).encode()])
    assert len(np.unique(flat)) == 50_000
    for shift in (0, 20, 50):
        seen = np.bincount(((flat >> np.uint64(shift)) & np.uint64(15)).astype(int), minlength=16)
        assert abs(seen - 50_000 / 16).max() < 400
