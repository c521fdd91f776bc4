"""Token ids of whole texts by a public tokenizer file, word by word.

A text's ids are the ids of its words between ASCII white space, one after
another: no match of the tokenizer's pattern holds white space, and neither
composing accents nor lower-casing reaches across it.  So a worker encodes each
distinct word once and looks up the rest.  The store of words is bounded; it is
emptied when full.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np

from .common import STORES

#: Distinct words that a worker keeps at most.
WORDS_KEPT = 600_000
_ENDS = b".,;:!?"
_WORD_END = "</w>"


#: Small letters whose lower-casing depends on what stands around them.
_UNLIKE = set("\u03c3\u03c2\u0307")


class _Numbered(dict):
    """Words numbered as they first come; ``new`` has those without ids as yet."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = i = len(self)
        self.new.append(word)
        return i


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one run after another."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(int(ends[-1]) if len(ends) else 0)


class WordEncoder:
    """Encodes texts by the tokenizers library; equal words are encoded once."""

    def __init__(self, path: str, kept: int = WORDS_KEPT):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.kept = kept
        self.full = Tokenizer.from_file(path)
        self.full.no_padding()
        self.full.no_truncation()
        # The same model for words that are lower-case letters already: no pattern and no normalizer are needed.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.full.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.closes[i] = token.endswith(_WORD_END)
        self.ends = {bytes([c]): int(self._encode_full([chr(c)])[0][0]) for c in _ENDS}
        self.clear()

    def clear(self) -> None:
        self.words = _Numbered()
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _encode_full(self, texts: list[str]) -> list[np.ndarray]:
        done = self.full.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.int32) for x in done]

    def _encode_plain(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Words of lower-case letters: each is one match of the pattern, so it ends where a token closes a word."""
        flat, counts = [], []
        for i in range(0, len(words), 500):
            part = words[i : i + 500]
            ids = np.array(self.plain.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.int32)
            n = np.diff(np.flatnonzero(self.closes[ids]), prepend=-1)
            if len(n) != len(part) or n.sum() != len(ids):
                each = self._encode_full(part)
                ids, n = np.concatenate(each), np.array([len(x) for x in each], np.int64)
            flat.append(ids)
            counts.append(n)
        return flat, counts

    def learn(self, new: list[bytes]) -> None:
        """Adds the ids of words that were numbered, in the order of their numbers."""
        stems: dict[str, int] = {}
        stem, end, rest = np.full(len(new), -1), np.full(len(new), -1, np.int32), []
        for k, word in enumerate(new):
            if word.isalpha():
                stem[k] = stems.setdefault(word.decode(), len(stems))
                continue
            s = word
            if word[-1:] in self.ends and len(word) > 1:
                s, end[k] = word[:-1], self.ends[word[-1:]]
            s = s.decode()
            if s.isalpha() and (s.isascii() or (unicodedata.is_normalized("NFC", s) and (s := s.lower()).isalpha() and not _UNLIKE & set(s))):
                stem[k] = stems.setdefault(s, len(stems))
            else:
                end[k] = -1
                rest.append(k)
        flat, counts = self._encode_plain(list(stems))
        if rest:
            stem[rest] = np.arange(len(stems), len(stems) + len(rest))
            each = self._encode_full([new[k].decode() for k in rest])
            flat += each
            counts.append(np.array([len(x) for x in each], np.int64))
        flat, counts = np.concatenate(flat), np.concatenate(counts)
        n = counts[stem] + (end >= 0)
        ids = np.empty(int(n.sum()), np.int32)
        starts = np.cumsum(n) - n
        ids[(starts + n - 1)[end >= 0]] = end[end >= 0]
        ids[_runs(starts, counts[stem])] = flat[_runs((np.cumsum(counts) - counts)[stem], counts[stem])]
        self.start = np.concatenate([self.start, len(self.flat) + starts])
        self.flat = np.concatenate([self.flat, ids])
        self.count = np.concatenate([self.count, n])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and each text's count.  A null text has none."""
        if len(self.words) > self.kept:
            self.clear()
        split = [self._split(t) for t in texts]
        lens = np.array([len(x) for x in split], np.int64)
        at = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), np.int64, int(lens.sum()))
        if self.words.new:
            self.learn(self.words.new)
            self.words.new = []
        count = self.count[at]
        flat = self.flat[_runs(self.start[at], count)]
        upto = np.concatenate([[0], np.cumsum(count)])
        return flat, np.diff(upto[np.concatenate([[0], np.cumsum(lens)])])

    @staticmethod
    def _split(text: str | None) -> list[bytes]:
        if not text:
            return []
        data = text.encode()
        return (data if b"<|" in data else data.lower()).split()  # the names of special tokens keep their case


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and file."""
    return WordEncoder(path)


STORES["tokens"] = encoder.cache_clear
