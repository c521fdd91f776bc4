"""Byte-level BPE by merge replay over the words of a whole batch of texts.

The distinct words of a batch are laid out one after another as tokens.  An
inverted index leads from each mergeable pair's rank to the positions where it
stands.  The ranks are replayed once, in order, each at all its positions at
the same time; only the pairs beside a merge are looked up again.  A bounded
store keeps the ids of words met before.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import STORES, docs_of, list_array, text_parts
from .tokens import _Numbered, _runs

#: Distinct words that a worker keeps at most.
WORDS_KEPT = 250_000
#: Bytes of text whose words are replayed together.
REPLAY_BYTES = 1 << 22
_NONE = np.int32(2**31 - 1)


class MergeReplay:
    """Encodes and decodes by a rank file (base64 token and rank a line)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, kept: int = WORDS_KEPT):
        import regex

        self.find = regex.compile(pattern).findall
        self.ranks, self.kept = ranks, kept
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.token_bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.token_count, self.token_start = lengths, np.cumsum(lengths) - lengths
        self.clear()

    @classmethod
    def from_file(cls, path: str, pattern: str) -> MergeReplay:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}, pattern)

    def clear(self) -> None:
        self.words = _Numbered()
        self.start, self.count, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that merges each pair, or _NONE."""
        if not len(self.keys):
            return np.full(len(left), _NONE)
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], _NONE)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words, one after another, and each word's count."""
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        size = int(ends[-1]) if len(ends) else 0
        token = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        if (token < 0).any():
            raise ValueError("the rank file lacks a byte")
        after, ahead = np.arange(1, size + 1), np.arange(-1, size - 1)
        after[(ends - 1)[sizes > 0]] = -1
        ahead[(ends - sizes)[sizes > 0]] = -1
        for k, w in enumerate(words):  # a word that is a token as it stands needs no merges
            if (whole := self.ranks.get(w)) is not None and len(w) > 1:
                b = int(ends[k])
                token[b - len(w)], token[b - len(w) + 1 : b] = whole, -1
                after[b - len(w)] = -1
        rank = np.full(size, _NONE, np.int32)
        live = np.flatnonzero((after >= 0) & (token >= 0))
        rank[live] = self.rank_of(token[live], token[after[live]])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(at: np.ndarray) -> None:
            r = rank[at]
            some = r != _NONE
            at, r = at[some], r[some]
            if not len(at):
                return
            order = np.argsort(r, kind="stable")
            at, r = at[order], r[order]
            cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
            starts = [0, *cuts.tolist()]
            for x, a, b in zip(r[starts].tolist(), starts, [*starts[1:], len(r)], strict=True):
                if x in index:
                    index[x].append(at[a:b])
                else:
                    index[x] = [at[a:b]]
                    heapq.heappush(heap, x)

        add(live)
        while heap:
            r = heapq.heappop(heap)
            parts = index.pop(r)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[rank[at] == r]
            if not len(at):
                continue
            right = after[at]
            if len(at) > 1 and (touch := right[:-1] == at[1:]).any():  # runs such as aaa: every other one, from the left
                first = np.flatnonzero(np.concatenate([[True], ~touch]))
                place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
                at = at[place % 2 == 0]
                right = after[at]
            beyond = after[right]
            token[at], token[right], rank[right] = r, -1, _NONE
            after[at] = beyond
            more = beyond >= 0
            ahead[beyond[more]] = at[more]
            left = ahead[at]
            near = np.concatenate([at[more], left[left >= 0]])
            rank[at[~more]] = _NONE
            if len(near):
                if len(near) > 1:
                    near = np.unique(near)
                rank[near] = self.rank_of(token[near], token[after[near]])
                add(near)
        kept = token >= 0
        upto = np.concatenate([[0], np.cumsum(kept)])
        return token[kept], upto[ends] - upto[ends - sizes]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and each text's count.  A null text has none."""
        if len(self.words) > self.kept:
            self.clear()
        split = [self.find(t) if t else [] for t in texts]
        lens = np.array([len(x) for x in split], np.int64)
        at = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), np.int64, int(lens.sum()))
        if self.words.new:
            flat, counts = self.replay([w.encode() for w in self.words.new])
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(counts) - counts])
            self.flat, self.count = np.concatenate([self.flat, flat]), np.concatenate([self.count, counts])
            self.words.new = []
        count = self.count[at]
        upto = np.concatenate([[0], np.cumsum(count)])
        return self.flat[_runs(self.start[at], count)], np.diff(upto[np.concatenate([[0], np.cumsum(lens)])])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The bytes of each list of ids, as a binary column."""
        n = self.token_count[ids]
        data = self.token_bytes[_runs(self.token_start[ids], n)]
        upto = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(counts)])]
        return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(data)])


@lru_cache(maxsize=2)
def replayer(path: str, pattern: str) -> MergeReplay:
    """One for each worker process and file."""
    return MergeReplay.from_file(path, pattern)


STORES["bytebpe"] = replayer.cache_clear


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every whole text; a null or empty text has an empty list.

    Each match of the pattern is encoded by itself; characters outside all
    matches are left out, as the pattern says.  Repeated rows stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = replayer(path, pattern)
        for part, texts in text_parts(batches, REPLAY_BYTES, "bytebpe"):
            ids, counts = tool.encode(texts)
            yield pa.record_batch([part.column(0), list_array(ids, counts, pa.int32())], ["doc_id", "ids"])

    return docs_of(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows of ``encoded`` (doc_id, ids) with ``decoded``, the bytes that the ids stand for; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = replayer(path, pattern)
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                part = batch.slice(a, 2000)
                counts = pc.list_value_length(part.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
                ids = part.column(1).flatten().to_numpy(zero_copy_only=False)
                yield pa.record_batch([part.column(0), part.column(1), tool.decode(ids, counts)], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
