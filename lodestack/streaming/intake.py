"""Incremental intake: only new items, each once, rerun without effect (STR-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.shared import scratch


def take_in(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, key: str) -> None:
    """Reads the files that are new since the last call and appends items whose key isn't in the target yet.

    A batch is written under its own folder ``batch=<n>``, so one that is repeated
    after a failure replaces itself; its own folder is left out of the comparison.
    """

    def add(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        fresh = batch.dropDuplicates([key])
        hadoop = session.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        if hadoop.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
            seen = session.read.schema(schema.add("batch", "long") if "batch" not in schema.names else schema).parquet(target).where(F.col("batch") != number)
            fresh = fresh.join(seen.select(key), key, "left_anti").select(batch.columns)
        fresh.write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(StructType(schema.fields)).parquet(source)
    schema = StructType(list(schema.fields))
    stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def demo_two_batches(spark: SparkSession, rows: DataFrame, key: str) -> DataFrame:
    """The target after three calls: the even keys, all rows, and nothing new."""
    at = scratch(spark, "intake")
    source, target, checkpoint = f"{at}/source", f"{at}/target", f"{at}/checkpoint"
    half = F.pmod(F.col(key), F.lit(2)) == 0
    for part in (rows.where(half), rows, None):
        if part is not None:
            part.write.mode("append").parquet(source)
        take_in(spark, source, rows.schema, target, checkpoint, key)
    return spark.read.parquet(target).groupBy("batch").agg(F.count("*").alias("items"), F.count_distinct(key).alias("distinct_items")).select(F.col("batch").cast("long").alias("batch"), "items", "distinct_items")


def replayed(parts: list[DataFrame], at: str, transform) -> DataFrame:
    """What ``transform`` of a stream gives over all, when the parts arrive one after another, each in a micro-batch of its own; with the number of the micro-batch."""
    spark, schema = parts[0].sparkSession, parts[0].schema
    for number, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{at}/in/{number}")
        stream = spark.readStream.schema(schema).parquet(f"{at}/in/*")
        put = lambda df, n, number=number: df.withColumn("batch", F.lit(number)).write.mode("append").parquet(f"{at}/out")
        transform(stream).writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{at}/out")


def daily_counts(events: DataFrame, at: str, delay: str = "1 day") -> DataFrame:
    """Daily counts by type with a watermark; a zone-less time is taken as UTC first, as watermarks need TIMESTAMP."""
    e = events.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", delay)
    return e.groupBy(F.window("_at", "1 day").alias("day"), "event_type").agg(F.count("*").alias("n"))
