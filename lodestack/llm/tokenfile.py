"""Token ids in fixed-width bit packing, in blocks that can be read at random.

A block holds whole documents: a header, the documents' ids and token counts,
then every token id in the fewest bits that the vocabulary needs, one after
another, and a checksum.  Token k of a block starts at bit k * width of its
payload, so any range is unpacked by one gather.  Blocks are the rows of a
Parquet table in ascending document order, by shard and block, with their first
and last doc_id, so that a reader of some documents skips the other blocks; writes
are committed whole, by any store that Spark writes to, and a lost task's half
written blocks are never seen.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import docs_of, text_parts
from .tokens import encoder

MAGIC = b"LSTK"
_HEAD = struct.Struct("<4sHBxIQ")  # magic, version, bits of an id, documents, tokens
VERSION = 1
#: A block is closed when it has so many tokens; a longer document is a block of its own.
BLOCK_TOKENS = 1 << 16
#: Ids whose bits are spread out at a time, a multiple of eight.
PACKED_AT_ONCE = 1 << 15


def width_of(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """The ids' low ``width`` bits (1 to 32), least significant first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    out, places = [], np.arange(width, dtype=np.uint32)
    for a in range(0, len(ids), PACKED_AT_ONCE):
        bits = (ids[a : a + PACKED_AT_ONCE].astype(np.uint32)[:, None] >> places & 1).astype(np.uint8)
        out.append(np.packbits(bits.ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack_bits(data: bytes | memoryview, width: int, start: int, count: int) -> np.ndarray:
    """Ids start to start + count - 1."""
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count, start * width // 8).astype(np.uint32)
    first = start * width
    raw = np.frombuffer(data, np.uint8)[first // 8 : (first + count * width + 7) // 8]
    raw = np.concatenate([raw, np.zeros(8, np.uint8)]).astype(np.uint64)
    at = first % 8 + np.arange(count, dtype=np.int64) * width
    byte, shift = at >> 3, (at & 7).astype(np.uint64)
    word = np.zeros(count, np.uint64)
    for k in range(5):
        word |= raw[byte + k] << np.uint64(8 * k)
    return ((word >> shift) & np.uint64((1 << width) - 1)).astype(np.uint32)


def make_block(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    known = np.array([i is not None for i in doc_ids], np.uint8)
    numbers = np.array([i or 0 for i in doc_ids], "<i8")
    body = _HEAD.pack(MAGIC, VERSION, width, len(doc_ids), len(ids)) + known.tobytes() + numbers.tobytes() + counts.astype("<u8").tobytes() + pack_bits(ids, width)
    return body + struct.pack("<I", zlib.crc32(body))


class Block:
    """One block, read back; ``ids(k)`` unpacks the k-th document alone."""

    def __init__(self, data: bytes):
        magic, version, self.width, docs, tokens = _HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION or zlib.crc32(memoryview(data)[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("damaged token block")
        at = _HEAD.size
        known = np.frombuffer(data, np.uint8, docs, at)
        numbers = np.frombuffer(data, "<i8", docs, at + docs)
        self.doc_ids = [int(x) if k else None for x, k in zip(numbers, known, strict=True)]
        self.counts = np.frombuffer(data, "<u8", docs, at + 9 * docs).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.tokens = tokens
        self.payload = memoryview(data)[at + 17 * docs : -4]

    def ids(self, k: int) -> np.ndarray:
        return unpack_bits(self.payload, self.width, int(self.starts[k]), int(self.counts[k]))

    def all_ids(self) -> np.ndarray:
        return unpack_bits(self.payload, self.width, 0, self.tokens)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, block_tokens: int = BLOCK_TOKENS) -> None:
    """Writes the blocks of all documents, ids and an end id each, in ascending doc_id order.

    Null texts count as empty; null doc_ids come first; rows of one doc_id are
    ordered by the text's hash.  An empty table gives a file without blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        width = width_of(enc.full.get_vocab_size(with_added_tokens=True))
        shard, number, before = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        held: list[np.ndarray] = []
        sizes: list[int] = []

        def close() -> pa.RecordBatch:
            nonlocal number, before, names, held, sizes
            ids, counts, known = np.concatenate(held), np.array(sizes, np.int64), [i for i in names if i is not None]
            row = pa.record_batch([pa.array([shard], pa.int32()), pa.array([number], pa.int64()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([min(known, default=None)], pa.int64()), pa.array([max(known, default=None)], pa.int64()), pa.array([make_block(names, counts, ids, width)], pa.binary())], ["shard", "block", "before", "tokens", "first_id", "last_id", "data"])
            number, before, names, held, sizes = number + 1, before + len(ids), [], [], []
            return row

        full = 0
        for part, texts in text_parts(batches, store="tokens"):
            ids, counts = enc.encode(texts)
            at = 0
            for doc_id, n in zip(part.column(0).to_pylist(), counts.tolist(), strict=True):
                if names and n + 1 >= block_tokens:
                    yield close()
                    full = 0
                names.append(doc_id)
                held.append(np.append(ids[at : at + n], np.int32(end_id)))
                sizes.append(n + 1)
                at, full = at + n, full + n + 1
                if full >= block_tokens:
                    yield close()
                    full = 0
        if names:
            yield close()

    turn = F.xxhash64("text")  # so that the rows of one doc_id need not go to one task
    ordered = docs_of(docs).repartitionByRange("doc_id", turn).sortWithinPartitions("doc_id", turn, "text")
    ordered.mapInArrow(run, "shard int, block long, before long, tokens long, first_id long, last_id long, data binary").write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True, between: tuple[int, int] | None = None) -> DataFrame:
    """Per document, from the blocks: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids.

    ``between``: the documents with these doc_ids and those between alone; other blocks are not read.
    """
    blocks = spark.read.parquet(path)
    totals = {r["shard"]: r["n"] for r in blocks.groupBy("shard").agg(F.sum("tokens").alias("n")).collect()}  # one number a shard file
    before, at = {}, 0
    for shard in sorted(totals):
        before[shard], at = at, at + totals[shard]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, inside, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                block = Block(data)
                flat = block.all_ids().astype("<u4")
                raw = memoryview(flat).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(block.starts.tolist(), block.counts.tolist(), strict=True)]
                cols = [pa.array(block.doc_ids, pa.int64()), pa.array(before[shard] + inside + block.starts), pa.array(block.counts), pa.array(crc, pa.int64())]
                if with_ids:
                    offsets = pa.array(np.append(block.starts, block.tokens).astype(np.int32))
                    cols.append(pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32))))
                yield pa.record_batch(cols, ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    if between:
        blocks = blocks.where((F.col("last_id") >= between[0]) & (F.col("first_id") <= between[1]))
    out = blocks.select("shard", "before", "data").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
    return out.where(F.col("doc_id").between(*between)) if between else out
