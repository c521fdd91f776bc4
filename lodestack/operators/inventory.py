"""Source inventories: completeness, duplicates, gates, reports, new items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases that belong to the workshop, not to a published note.
BACKSTAGE = ["the transcript says", "the material mentions", "we should do next", "this video is about", "可沉淀内容", "后台"]
#: What must not be published, the patterns are our choice; and what a text must hold, in lower case, for each to be tried.
PRIVATE = [
    (("/home/", "/root/", "/users/", "/tmp/", "/var/"), r"(^|[\s\"'(])/(home|root|Users|tmp|var)/[\w.-]+"),
    ((":\\",), r"[A-Za-z]:\\[\w.-]+"),
    (("passw", "api", "secret", "token", "cookie"), r"(?i)\b(password|passwd|api[_-]?key|secret|token|cookie)\s*[:=]\s*\S+"),
    (("@",), r"[\w.+-]+@[\w-]+\.[\w.]+"),
    (("transid",), r"(?i)\btransid[s]?\b"),
    ((".mp3", ".mp4", ".wav", ".m4a", ".mov", ".log"), r"(?i)\.(mp3|mp4|wav|m4a|mov|log)\b"),
]


def completeness(expected: DataFrame, local: DataFrame, key: str) -> DataFrame:
    """Each key with its state on either side and how often it is there locally (JOIN-6, JOIN-8, AGG-2)."""
    a = expected.groupBy(key).agg(F.count("*").alias("expected"))
    b = local.groupBy(key).agg(F.count("*").alias("found"))
    both = a.join(b, key, "full_outer").select(key, F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("found", F.lit(0)).alias("found"))
    return both.withColumn("state", F.when(F.col("found") == 0, "missing").when(F.col("expected") == 0, "extra").when(F.col("found") > F.col("expected"), "duplicate").otherwise("complete"))


def unprocessed(sources: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Sources without a result (JOIN-7); also what is new (JOIN-9)."""
    return sources.join(done.select(key).distinct(), key, "left_anti")


def create_or_update(items: DataFrame, notes: DataFrame, key: str) -> DataFrame:
    """Each item and what to do with its note (JOIN-10)."""
    known = notes.select(key).distinct().withColumn("_k", F.lit(True))
    return items.join(known, key, "left").withColumn("action", F.when(F.col("_k").isNull(), "create").otherwise("update")).drop("_k")


def duplicates(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Keys that occur more than once, with their count (AGG-2)."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def lacks(*columns: str) -> Column:
    """The first of the columns that is null or blank, else null (FIL-18)."""
    return F.coalesce(*(F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), c) for c in columns))


def gone(status: Column) -> Column:
    return F.lower(status).isin("private", "deleted")


def blocked(text: Column, patterns: list[tuple[tuple[str, ...], str]] = PRIVATE, phrases: list[str] = BACKSTAGE) -> Column:
    """Whether a text must not be published (FIL-16, FIL-17).  A pattern is only tried on texts that hold what it needs."""
    hit = backstage(text, phrases)
    for needs, p in patterns:
        there = F.lit(False)
        for x in needs:
            there = there | F.lower(text).contains(x)
        hit = hit | (there & text.rlike(p))
    return hit


def backstage(text: Column, phrases: list[str] = BACKSTAGE) -> Column:
    hit = F.lit(False)
    for p in phrases:
        hit = hit | F.lower(text).contains(p)
    return hit


def transcript_fault(title: Column, expected_title: Column, duration: Column, expected: Column, text: Column, tolerance: float = 0.1, boilerplate: float = 0.5) -> Column:
    """The first fault of a transcript, else ok (FIL-19).  Tolerance and boilerplate share (repeated lines) are our choice."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    repeated = 1 - F.try_divide(F.size(F.array_distinct(lines)), F.size(lines))
    return (
        F.when(~title.eqNullSafe(expected_title), "title")
        .when(F.abs(F.try_divide(duration - expected, expected)) > tolerance, "duration")
        .when(F.coalesce(F.trim(text), F.lit("")) == "", "empty")
        .when(repeated > boilerplate, "boilerplate")
        .when(~text.rlike("[.,;:!?。，；：！？]"), "punctuation")
        .otherwise("ok")
    )


def one_inventory(*sources: DataFrame) -> DataFrame:
    """Several sources as one (SET-3)."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def completion_report(sources: DataFrame, done: DataFrame, key: str, by: str, content: str) -> DataFrame:
    """Per group: sources, processed, unprocessed, duplicates of the content and its size (AGG-1, AGG-3, AGG-14)."""
    marked = sources.join(done.select(key).distinct().withColumn("_done", F.lit(True)), key, "left")
    per_content = marked.groupBy(by, F.xxhash64(content).alias("_c"), F.md5(content).alias("_m")).agg(F.count("*").alias("n"), F.count("_done").alias("done"), F.sum(F.char_length(content)).alias("size"))
    return per_content.groupBy(by).agg(
        F.sum("n").alias("sources"), F.sum("done").alias("processed"), (F.sum("n") - F.sum("done")).alias("unprocessed"), (F.sum("n") - F.count("*")).alias("duplicates"), F.sum("size").alias("size")
    )


#: Acquisition paths, the lightest reliable one first (fixed order).
ACQUISITION = ["local transcript", "platform metadata", "audio only", "browser"]


def best_path(df: DataFrame, key: str, path: str, order: list[str] = ACQUISITION) -> DataFrame:
    """The preferred path that each item offers (SORT-5)."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(path))
    return df.withColumn("_r", rank).where("_r > 0").groupBy(key).agg(F.min_by(path, "_r").alias(path))
