"""Comparison of paired runs, and the pattern library."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def paired(runs: DataFrame, by: list[str], agent: str, a: str, b: str, *measures: str) -> DataFrame:
    """Per key both agents' means and the relative change from a to b (JOIN-16, JOIN-18, AGG-7, AGG-9).

    One conditional aggregation; no self-join.
    """
    cols = []
    for m in measures:
        for who, to in ((a, "a"), (b, "b")):
            cols.append(F.avg(F.when(F.col(agent) == who, F.col(m))).alias(f"{m}_{to}"))
    out = runs.groupBy(*by).agg(*cols)
    for m in measures:
        out = out.withColumn(f"{m}_change", F.try_divide(F.col(f"{m}_b") - F.col(f"{m}_a"), F.col(f"{m}_a"))).withColumn(f"{m}_gap", F.col(f"{m}_b") - F.col(f"{m}_a"))
    return out


def variance(runs: DataFrame, by: str, measure: str) -> DataFrame:
    """AGG-8."""
    return runs.groupBy(by).agg(F.count(measure).alias("n"), F.avg(measure).alias("mean"), F.stddev_samp(measure).alias("sd"), F.var_samp(measure).alias("variance"))


def tool_use(events: DataFrame, run: str, tool: str, at: str) -> DataFrame:
    """Per run the tools in order and how many distinct (AGG-11)."""
    return events.groupBy(run).agg(F.transform(F.sort_array(F.collect_list(F.struct(at, tool))), lambda x: x[tool]).alias("sequence"), F.count_distinct(tool).alias("distinct_tools"))


def success_rate(success: F.Column, failure: F.Column) -> F.Column:
    """AGG-5; null without any try."""
    return F.try_divide(success, success + F.coalesce(failure, F.lit(0)))


def library_meta(patterns: DataFrame) -> DataFrame:
    """Total evolutions and the most effective category, by the sum of successes, ties by name (AGG-4); one row even if empty."""
    per = patterns.groupBy("category").agg(F.sum("success_count").alias("s"))
    return per.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("total_evolutions"), F.min_by("category", F.struct((-F.col("s")).alias("s"), F.col("category").alias("c"))).alias("most_effective_category"))


def apply_feedback(patterns: DataFrame, feedback: DataFrame, demote_after: int = 3) -> DataFrame:
    """Counters raised by feedback (id, success: boolean); patterns that fail too often are demoted (AGG-6)."""
    delta = feedback.groupBy("id").agg(F.count_if("success").alias("_s"), F.count_if(~F.col("success")).alias("_f"))
    out = patterns.join(delta, "id", "left")
    for c, d in (("success_count", "_s"), ("failure_count", "_f")):
        out = out.withColumn(c, (F.coalesce(c, F.lit(0)) + F.coalesce(d, F.lit(0))).cast("int"))
    return out.drop("_s", "_f").withColumn("demoted", (F.col("failure_count") >= demote_after) & (F.col("failure_count") > F.col("success_count")))


def known_patterns(findings: DataFrame, patterns: DataFrame) -> DataFrame:
    """Findings (category, condition) with the patterns of their category whose condition they meet, null if new (JOIN-17)."""
    p = patterns.select(F.col("id").alias("pattern"), "category", "when_to_apply")
    return findings.join(p, (findings["category"] == p["category"]) & F.coalesce(F.instr(findings["condition"], p["when_to_apply"]) > 0, F.lit(False)), "left").drop(p["category"])


def top_k(df: DataFrame, score: F.Column, k: int = 2, ties: str | None = None) -> DataFrame:
    """The best k rows (SORT-2, SORT-3)."""
    return df.orderBy(score.desc(), *([ties] if ties else [])).limit(k)


def top_k_each(df: DataFrame, by: str, order: list[F.Column], k: int = 3) -> DataFrame:
    """The best k rows of each group (SORT-4); Spark keeps k rows a group on each side of the shuffle."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("place") <= k)


def capability_matrix(scored: DataFrame, agents: list[str]) -> DataFrame:
    """Dimension by agent with the gap of the last to the first (D15)."""
    wide = scored.groupBy("dimension").pivot("agent", agents).agg(F.max("score"))
    return wide.withColumn("gap", F.col(agents[-1]) - F.col(agents[0]))
