"""Helpers shared by the training-data operators: shared storage, tables, text batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..sources.shared import release, scratch, stored  # noqa: F401  for the operators

#: The white space that separates words: the blank and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"

#: Bytes of text that one numpy pass takes at a time.
CHUNK_BYTES = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that a stored table of a few numbers a row may have to be broadcast.
BROADCAST_ROWS = 1 << 18


def bounded(table: DataFrame) -> DataFrame:
    """A stored table, to be broadcast if it has at most BROADCAST_ROWS rows; a larger one is left to a sorted join, in which Spark splits large keys."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def docs_of(df: DataFrame, text: bool = True) -> DataFrame:
    """doc_id and text alone, so that further columns, however named, can't clash."""
    cols = [F.col("doc_id").cast("long").alias("doc_id")]
    return df.select(*cols, F.col("text").cast("string").alias("text")) if text else df.select(*cols)


def _quoted(name: str) -> F.Column:
    return F.col(f"`{name.replace('`', '``')}`")


def folded(docs: DataFrame) -> DataFrame:
    """doc_id, text, and ``rest``: all columns but the text as one, under names of its own, so that none can clash."""
    rest = F.struct(F.lit(0).alias("c"), *(_quoted(c).alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), rest.alias("rest"))


def unfolded(rows: DataFrame, columns: list[str], **new: F.Column) -> DataFrame:
    """The columns that were folded, in their order; ``new`` has those with other values."""
    return rows.select(*(new.get(c, F.col("text") if c == "text" else F.col("rest")[f"c{i}"]).alias(c) for i, c in enumerate(columns)))


def row_ranges(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes of text each, one row at least."""
    start, size = 0, 0
    for i, n in enumerate(pc.binary_length(column).fill_null(0).to_pylist()):
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(column):
        yield start, len(column)


#: What a worker process keeps from task to task, by name, with what empties it.
STORES: dict[str, Callable[[], object]] = {}


def text_parts(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES, store: str | None = None) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of the batches with the values of their column ``text``.

    Worker processes serve one operator after another, so whatever they keep for
    others than ``store`` is let go first.
    """
    for name, empty in STORES.items():
        if name != store:
            empty()
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text"))
        for a, b in row_ranges(column, limit):
            yield batch.slice(a, b - a), column.slice(a, b - a).to_pylist()


def with_scores(docs: DataFrame, score, name: str = "score") -> DataFrame:
    """``docs`` with all its columns and ``name`` (double): score(texts) of its column ``text``, without a shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(score)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_parts(batches):
            yield pa.record_batch([*part.columns, pa.array(sent.value(texts), pa.float64())], [*columns, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def list_array(values, counts, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and each row's count."""
    import numpy as np

    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def fold(n: int) -> F.Column:
    """crc32 of doc_id as text, modulo n: the split into learned and held-out rows; null for a null doc_id, which is neither."""
    return F.crc32(F.col("doc_id").cast("string")) % n
