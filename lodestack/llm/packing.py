"""Best-fit packing by exact complements: token pieces into as few sequences as possible.

Only the histogram of piece lengths, at most ``limit`` numbers, is planned on
the driver.  An index holds the sums of one, two and three lengths that are to be
had.  From the longest length down, the gap beside it is filled exactly by a
combination that the index has; where it has none the longest that fits goes in,
and the rest of the gap is tried again.  Each pattern found is applied as often as
its scarcest length allows.  The sequences that stay short of the limit are the
residue: their pieces are packed once more, from the longest down, each into the
open sequence with the smallest gap that it fits, and that is kept if it needs
fewer sequences.  So a plan has a few thousand patterns at any size of the corpus.
The pieces then find their places by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import docs_of, stored, text_parts
from .tokens import encoder

#: Pieces of one length that are numbered together, about; a common length is dealt into groups.
GROUP_ROWS = 1 << 9


def token_pieces(docs: DataFrame, tokenizer: str, limit: int = 2048, end_id: int = 0) -> DataFrame:
    """Each document's ids and an end id, cut into pieces of ``limit`` ids; the last piece may be shorter.

    A null or empty text gives one piece, the end id.  A null doc_id is kept as
    null.  Repeated rows give their pieces again.  Other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for part, texts in text_parts(batches, store="tokens"):
            ids, counts = enc.encode(texts)
            flat = np.full(len(ids) + len(counts), end_id, "<u4")
            ends = np.cumsum(counts + 1)
            keep = np.ones(len(flat), bool)
            keep[ends - 1] = False
            flat[keep] = ids
            n = counts + 1
            pieces = -(-n // limit)
            row = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * limit
            length = np.minimum(limit, n[row] - start)
            at = (ends - n)[row] + start
            data = memoryview(flat).cast("B")
            crc = np.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)], np.int64)
            yield pa.record_batch([part.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs_of(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Sums:
    """Index of the sums of one, two and three lengths with left[n] > 0, as bits of whole numbers.

    Lengths only run out, so an old index has sums too many at most; it is built
    anew when it was wrong.
    """

    def __init__(self, left: np.ndarray):
        self.left = left
        self.build()

    def build(self) -> None:
        some = np.flatnonzero(self.left).tolist()
        every = (1 << len(self.left)) - 1
        one = sum(1 << n for n in some)
        two = three = 0
        for n in some:
            two |= one << n & every
        for n in some:
            three |= two << n & every
        self.sums = (one, two, three)

    def exactly(self, gap: int) -> list[int]:
        """One, two or three lengths still to be had whose sum is the gap, few and large ones first; empty if there are none."""
        for k in range(3):
            if self.sums[k] >> gap & 1:
                if found := self._search(k + 1, gap):
                    return found
                self.build()
        return []

    def _search(self, k: int, gap: int) -> list[int]:
        left = self.left
        if k == 1:
            return [gap] if left[gap] else []
        if k == 2:
            high = np.arange(gap - 1, (gap - 1) // 2, -1)
            ok = (left[high] > 0) & (left[gap - high] > 0)
            if gap % 2 == 0 and left[gap // 2] < 2:
                ok[-1:] = False
            at = int(ok.argmax()) if ok.size else 0
            return [int(high[at]), int(gap - high[at])] if ok.size and ok[at] else []
        for n in np.flatnonzero(left[: gap - 1])[::-1].tolist():
            if 3 * n < gap:
                break
            if self.sums[1] >> (gap - n) & 1:
                left[n] -= 1
                pair = self._search(2, gap - n)
                left[n] += 1
                if pair:
                    return [n, *pair]
        return []


def plan(counts: np.ndarray, limit: int) -> list[tuple[list[int], int]]:
    """Patterns of lengths with the number of sequences made by each; counts[n] is the number of pieces of length n."""
    left = np.zeros(limit + 1, np.int64)
    left[: len(counts)] = counts
    sums = Sums(left)
    full, short = [], []
    for longest in range(limit, 0, -1):
        while left[longest]:
            pattern, gap = [longest], limit - longest
            left[longest] -= 1
            while gap:
                found = sums.exactly(gap)
                if not found:
                    below = np.flatnonzero(left[: gap + 1])
                    if not below.size:
                        break
                    found = [int(below[-1])]
                for n in found:
                    left[n] -= 1
                pattern += found
                gap -= sum(found)
            uses = Counter(pattern)
            more = min(int(left[n]) // k for n, k in uses.items())
            for n, k in uses.items():
                left[n] -= more * k
            (short if gap else full).append((pattern, 1 + more))
    residue = np.zeros(limit + 1, np.int64)
    for pattern, times in short:
        np.add.at(residue, pattern, times)
    return full + min(short, best_fit(residue, limit), key=lambda some: sum(times for _, times in some))


def best_fit(counts: np.ndarray, limit: int) -> list[tuple[list[int], int]]:
    """Patterns by best fit decreasing; sequences that look alike are handled together."""
    opened: dict[int, list[tuple[list[int], int]]] = {}  # by gap: patterns and how many sequences have them
    gaps: list[int] = []  # ascending

    def put(pattern: list[int], times: int) -> None:
        gap = limit - sum(pattern)
        if times:
            if gap not in opened:
                insort(gaps, gap)
            opened.setdefault(gap, []).append((pattern, times))

    for n in np.flatnonzero(counts)[::-1].tolist():
        k = int(counts[n])
        while k and (at := bisect_left(gaps, n)) < len(gaps):
            gap = gaps[at]
            pattern, times = opened[gap].pop()
            if not opened[gap]:
                del opened[gap]
                gaps.pop(at)
            done = min(k, times)
            put(pattern, times - done)
            put([*pattern, n], done)
            k -= done
        whole, rest = divmod(k, limit // n)
        put([n] * (limit // n), whole)
        put([n] * rest, int(rest > 0))
    return [x for group in opened.values() for x in group]


def pack(pieces: DataFrame, limit: int = 2048) -> DataFrame:
    """The pieces with sequence_id and offset; within a sequence they lie one after another from 0.

    ``pieces`` has a column ``length`` from 1 to ``limit``, and doc_id and piece
    to tell rows apart (rows that agree in all columns get places of their own).
    It is read twice, so pass a stored table.  An empty table gives no row.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # limit rows at most
    counts = np.zeros(limit + 1, np.int64)
    for n, k in histogram.items():
        counts[n] = k
    runs, sequence = [], 0
    used = np.zeros(limit + 1, np.int64)
    for pattern, times in plan(counts, limit):
        at = 0
        for n, k in sorted(Counter(pattern).items(), reverse=True):
            runs.append((n, used[n], k, sequence, at))
            used[n] += times * k
            at += n * k
        sequence += times
    table = np.array(sorted(runs) or [(0, 0, 1, 0, 0)], np.int64)  # a few rows for each pattern
    first = table[:, 0] * (1 << 48) + table[:, 1]

    groups = F.element_at(F.array(*(F.lit(1 + int(k) // GROUP_ROWS) for k in counts)), F.col("length").cast("int") + 1)
    salted = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece"), groups).cast("int"))
    before = salted.groupBy("length", "_group").agg(F.count("*").alias("_n"))
    before = before.select("length", "_group", (F.sum("_n").over(Window.partitionBy("length").orderBy("_group")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("length", "_group").orderBy("doc_id", "piece")) - 1
    ranked = salted.withColumn("_inside", inside).join(before, ["length", "_group"])
    ranked = ranked.select(*pieces.columns, (F.col("_before") + F.col("_inside")).alias("_rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            run = table[np.searchsorted(first, length * (1 << 48) + rank, "right") - 1]
            turn, slot = np.divmod(rank - run[:, 1], run[:, 2])
            cols = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.record_batch([*cols, pa.array(run[:, 3] + turn), pa.array(run[:, 4] + slot * length)], [*batch.schema.names[:-1], "sequence_id", "offset"])

    return ranked.mapInArrow(place, ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes) + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, limit: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces of all documents with their places in the sequences."""
    return pack(stored(token_pieces(docs, tokenizer, limit, end_id), "pieces"), limit)
