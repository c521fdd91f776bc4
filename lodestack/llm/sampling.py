"""Bounded samples of labelled rows, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bound(share: float) -> int:
    """The bound within which 63 bits of a hash lie for this share of all rows; fine enough for a few rows of any table."""
    return min((1 << 63) - 1, int(share * (1 << 63)))


def within(column: str, most: F.Column) -> F.Column:
    """Whether the hash of the column is within the bound: the same rows at every run and in every partitioning."""
    return F.shiftrightunsigned(F.xxhash64(column), 1) <= most


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> tuple[DataFrame, tuple[float, float]]:
    """doc_id, text and label (0 or 1) of about ``rows`` documents of each class, by a hash of doc_id; and the share of class 0 and 1 that was taken.

    Rows with a null text or label are left out.  If doc_id repeats in the
    labels, the larger label holds.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    per = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two numbers
    share = [min(1.0, rows / max(1, per.get(k, 0))) for k in (0, 1)]
    chosen = known.where(within("doc_id", F.when(F.col("label") == 1, bound(share[1])).otherwise(bound(share[0]))))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    return text.join(F.broadcast(chosen), "doc_id"), (share[0], share[1])  # 2 * rows numbers at most
