"""Token ids of whole texts with a word-end BPE vocabulary, remembered word by word.

The tokenizer never joins signs across white space and marks the last token of every word, so
words can be encoded once, many in one call, and cut apart at those marks. That call uses the
same merges without the normaliser, which keeps places in the text that nobody asks for. Only
printable ASCII and Latin-1 letters take that way; any other piece of text is encoded as it stands.

The pieces of many texts are told apart by 64-bit hashes, counted off in one go, and their ids are put
together from one flat array, so a piece costs no look-up of its own.
"""

from __future__ import annotations

import gc
import json
import os
import re

import numpy as np
import pandas as pd
import regex

from weft.llm import caches, words

PLAIN_LINES = re.compile("[!-~À-ÖØ-öø-ÿ\n]+")
CACHE_WORDS = 900_000
#: Words whose ids are kept as objects, for new pieces made of them.
KNOWN_WORDS = 300_000


def _byte_signs() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable Latin-1 as itself, the others from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) if b in own else chr(256 + others.index(b)) for b in range(256)}


#: Line ends stay: they separate the words of one call.
_SHOWN = _byte_signs() | {10: "\n"}


class WordTokens:
    """Ids of the vocabulary file at ``path`` as little-endian 16-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if max(spec["model"]["vocab"].values(), default=0) >= 1 << 16:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.words = regex.compile(split["pattern"]["Regex"])
        self.end = spec["model"]["end_of_word_suffix"]
        self.is_end = np.zeros(1 << 16, bool)
        self.is_end[[i for t, i in spec["model"]["vocab"].items() if t.endswith(self.end)]] = True
        self.merger = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "WhitespaceSplit"}}))
        self.tails = {c: self._ids(c).tobytes() for c in ".,;:!?|"}
        self.known: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        """Ids of all pieces seen: place by hash, first and number of ids by place, all ids."""
        self.place = words.Places()
        self.first, self.count, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u2")

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2")

    def _word_ids(self, words: list[str]) -> np.ndarray:
        """Ids of lower-case words, one after the other."""
        shown = "\n".join(words).encode().decode("latin-1").translate(_SHOWN)
        return np.array(self.merger.encode_batch_fast([shown], add_special_tokens=False)[0].ids, "<u2")

    def _learn(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct pieces."""
        out: dict[bytes, bytes] = {}
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        joined = b"\n".join(pieces).decode()
        if pieces and not PLAIN_LINES.fullmatch(joined):
            odd = [p for p in pieces if not PLAIN_LINES.fullmatch(p.decode())]
            for piece in odd:
                out[piece] = self._ids(piece.decode()).tobytes()
            pieces = list(set(pieces).difference(odd))
            joined = b"\n".join(pieces).decode()
        cores, tails, mixed = [], [], []
        for piece, text in zip(pieces, joined.lower().split("\n")):
            if text.isalpha():
                cores.append((piece, text))
            elif text[-1] in self.tails and text[:-1].isalpha():
                tails.append((piece, text[:-1], self.tails[text[-1]]))
            else:
                mixed.append((piece, self.words.findall(text)))
        new = {w for _, w in cores}
        new.update([w for _, w, _ in tails], *[ws for _, ws in mixed])
        new = list(new.difference(self.known))
        if new:
            ids = self._word_ids(new)
            ends = np.flatnonzero(self.is_end[ids]) * 2 + 2
            if len(ends) != len(new):
                raise ValueError("the vocabulary doesn't mark word ends")
            raw, start = ids.tobytes(), 0
            for word, end in zip(new, ends.tolist()):
                self.known[word] = raw[start:end]
                start = end
        known = self.known
        out.update([(piece, known[w]) for piece, w in cores])
        out.update([(piece, known[w] + tail) for piece, w, tail in tails])
        out.update([(piece, b"".join([known[w] for w in ws])) for piece, ws in mixed])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; pieces not seen before are learnt in one call."""
        gc.disable()  # a million small objects and no cycle among them
        try:
            return self._encode(texts)
        finally:
            gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        odd = {k for k, t in enumerate(texts) if "<|" in t}
        whole, start, end, hashes, counts = words.find_words([b"" if k in odd else t.encode() for k, t in enumerate(texts)])
        codes, distinct = pd.factorize(hashes)
        if len(self.place) + len(distinct) > CACHE_WORDS:
            self._forget()
        at = self.place.find(distinct)
        new = np.flatnonzero(at < 0)
        if len(new):
            seen = np.zeros(len(distinct), np.int64)
            seen[codes[::-1]] = np.arange(len(codes))[::-1]  # where each stands first
            pieces = [whole[a:b] for a, b in zip(start[seen[new]].tolist(), end[seen[new]].tolist())]
            ids = self._learn(pieces)
            own = [ids[p] for p in pieces]
            size = np.fromiter(map(len, own), np.int64, len(own)) // 2
            at[new] = self.place.add(distinct[new])
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
            self.count = np.concatenate([self.count, size])
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(own), "<u2")])
        at = at[codes]
        size = self.count[at]
        total = np.append(0, np.cumsum(size))
        flat = self.flat[np.repeat(self.first[at] - total[:-1], size) + np.arange(total[-1])]
        bounds = total[np.append(0, np.cumsum(counts))].tolist()
        return [self._ids(t).tobytes() if k in odd else flat[bounds[k] : bounds[k + 1]].tobytes() for k, t in enumerate(texts)]


_LOADED: dict[str, WordTokens] = {}
caches.register("tokens", lambda: _LOADED.clear())


def load(path: str) -> WordTokens:
    """One for each Python worker and file."""
    caches.use("tokens")
    if path not in _LOADED:
        _LOADED[path] = WordTokens(path)
    return _LOADED[path]
