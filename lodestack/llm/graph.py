"""Connected components by hooking and contraction, in DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, release, stored

#: Edges that one task joins at once; more are contracted in rounds.
TASK_EDGES = 1 << 14


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            low, high = sorted((root(x), root(y)))
            up[high] = low
    yield pa.record_batch([pa.array(list(up), pa.int64()), pa.array([root(x) for x in list(up)], pa.int64())], ["id", "component"])


def components(edges: DataFrame) -> DataFrame:
    """id and component, the smallest id reachable, of every id in ``edges`` (a, b: long).

    In each round every id takes the smallest neighbour's name below its own and
    follows that twice; edges are then contracted to the new names.  A round
    shortens paths at least fourfold and merges any star at once.  Up to
    TASK_EDGES edges are joined in one task instead.  Loops, repeated edges and
    nulls do no harm; an id that is only met in a loop has no row.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL")
    left = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    if left.count() <= TASK_EDGES:
        label = stored(left.coalesce(1).mapInArrow(_in_one_task, "id long, component long"), "labels")
        release(left)
        return label
    label = stored(left.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("component", F.col("id")), "labels")
    while not left.isEmpty():
        near = stored(left.groupBy(F.col("b").alias("from")).agg(F.min("a").alias("to")), "hooks")
        hook, beyond = near, bounded(near).select(F.col("from").alias("to"), F.col("to").alias("beyond"))
        for _ in range(2):
            hook = hook.join(beyond, "to", "left").select("from", F.coalesce("beyond", "to").alias("to"))
        hook = stored(hook, "hooks")
        named, was = bounded(hook), (left, label, near)
        label = stored(label.join(named, F.col("component") == F.col("from"), "left").select("id", F.coalesce("to", "component").alias("component")), "labels")
        for end in ("a", "b"):
            left = left.join(named.withColumnRenamed("from", end), end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
        left = stored(left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
        release(*was, hook)
    release(left)
    return label
