"""Catalogue of folders: allow-lists, missing members, line filters, consistency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def allowed_only(df: DataFrame, name: str, wanted: DataFrame) -> DataFrame:
    """Rows whose name is on the list, in any case (FIL-11, JOIN-4)."""
    keys = wanted.select(F.lower(wanted.columns[0]).alias("_k")).distinct()
    return df.join(keys, F.lower(df[name]) == F.col("_k"), "left_semi")


def split_missing(wanted: DataFrame, there: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``wanted`` that are there, and those to warn of (FIL-12, JOIN-5)."""
    return wanted.join(there, key, "left_semi"), wanted.join(there, key, "left_anti")


def without_folders(df: DataFrame, path: str, names: tuple[str, ...] = ("__pycache__", "node_modules")) -> DataFrame:
    """Drops paths inside the named folders (FIL-13)."""
    return df.where(~F.concat(F.lit("/"), path).rlike("/(" + "|".join(names) + ")/"))


def without_line(text: F.Column, line: str, only: F.Column) -> F.Column:
    """The text without lines equal to ``line`` where the condition ``only`` holds (FIL-14)."""
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda x: x != line), "\n")
    return F.when(only, kept).otherwise(text)


def consistency(listed: DataFrame, there: DataFrame, key: str) -> DataFrame:
    """Each key and whether it is listed, there, or both (JOIN-21, JOIN-6)."""
    a = listed.select(key).distinct().withColumn("_a", F.lit(True))
    b = there.select(key).distinct().withColumn("_b", F.lit(True))
    return a.join(b, key, "full_outer").select(key, F.when(F.col("_b").isNull(), "only_listed").when(F.col("_a").isNull(), "only_there").otherwise("both").alias("state"))


def sessions_with_fallback(wanted: DataFrame, cached: DataFrame, key: str, value: str, fallback: F.Column) -> DataFrame:
    """A lookup with attach on miss: the cached value, else the fallback; ``hit`` tells which (JOIN-3)."""
    c = cached.select(key, F.col(value).alias("_v"))
    return wanted.join(c, key, "left").withColumn("hit", F.col("_v").isNotNull()).withColumn(value, F.coalesce("_v", fallback)).drop("_v")
