"""Line dedup: lines found in many documents stay in one of them.

Normalised lines are hashed and counted over distinct documents; the lines over
the threshold are dropped everywhere but in the largest doc_id, and each text is
put together again by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: F.Column) -> F.Column:
    """The line without blanks and U+0009 to U+000D at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), _UPPER, _LOWER)


def dedup_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped and kept_text.

    Lines are split at \\n only.  A key of at least ``least_chars`` code points
    found in at least ``least_docs`` distinct doc_ids loses all its lines except
    those in the largest doc_id holding it.  A null or empty text is one empty
    line.  Repeated rows count as one document.  A null doc_id is no document:
    it isn't counted, but loses lines like the others.  Of the other columns those in
    ``carry`` stay, the rest are left out.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.struct(F.lit(0).alias("c"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(carry))).alias("carried"))
    rows = rows.withColumn("lines", F.split("text", "\n", -1)).select("doc_id", "carried", "lines", F.xxhash64("text").alias("form"))  # form tells texts of one doc_id apart
    placed = rows.select("doc_id", "form", F.posexplode("lines").alias("place", "line"))
    placed = placed.select("doc_id", "form", "place", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= least_chars)
    found = stored(placed.select("doc_id", "form", "place", F.xxhash64("key").alias("x"), F.xxhash64(F.lit(1), "key").alias("y")), "lines")
    keys = found.where("doc_id IS NOT NULL").groupBy("x", "y", "doc_id").agg(F.lit(1).alias("one")).groupBy("x", "y").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= least_docs).drop("n")
    keys = stored(keys, "common-lines")  # so its size is known, and a line that many documents hold is a join side that Spark can split
    drop = found.join(keys, ["x", "y"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    drop = drop.groupBy("doc_id", "form").agg(F.collect_set("place").alias("drop"))  # a document's own lines at most
    drop = drop.select(F.col("doc_id").alias("_id"), F.col("form").alias("_form"), "drop")
    joined = rows.join(drop, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("form") == F.col("_form")), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drop")
    kept = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(F.transform(left, lambda i: F.get("lines", i)))
    joined = joined.select("doc_id", "carried", "lines", kept.alias("kept"))
    return joined.select("doc_id", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("kept_text"), *(F.col("carried")[f"c{i}"].alias(c) for i, c in enumerate(carry)))
