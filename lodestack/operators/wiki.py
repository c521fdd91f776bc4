"""Wiki lint over pages (page_id, type, updated, body) and edges (src, dst, kind)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def orphans(pages: DataFrame, edges: DataFrame, page: str = "page_id", to: str = "dst") -> DataFrame:
    """Pages without an inbound edge (JOIN-11)."""
    return pages.join(edges.select(F.col(to).alias(page)).distinct(), page, "left_anti")


def dead_links(edges: DataFrame, pages: DataFrame, to: str = "dst", page: str = "page_id") -> DataFrame:
    """Link targets that aren't there, with the number of links (JOIN-15)."""
    return edges.join(pages.select(F.col(page).alias(to)).distinct(), to, "left_anti").groupBy(to).agg(F.count("*").alias("links"))


def unpromoted(pages: DataFrame, edges: DataFrame, kind: str = "promote") -> DataFrame:
    """Source pages that nothing was promoted from (JOIN-13)."""
    return pages.where("type = 'sources'").join(edges.where(F.col("kind") == kind).select(F.col("src").alias("page_id")).distinct(), "page_id", "left_anti")


def undocumented(scripts: DataFrame, documented: DataFrame, key: str) -> DataFrame:
    """Scripts without a page, or outputs without a source (JOIN-14)."""
    return scripts.join(documented.select(key).distinct(), key, "left_anti")


def missing_links(mentions: DataFrame, edges: DataFrame, group: str, node: str) -> DataFrame:
    """Pairs mentioned together without an edge either way (JOIN-12, SET-2; co-mention is our definition).

    ``mentions`` has a few nodes a group: pairs are made within groups of pages, not over all nodes.
    """
    a, b = mentions.select(group, F.col(node).alias("src")), mentions.select(group, F.col(node).alias("dst"))
    pairs = a.join(b, group).where("src < dst").select("src", "dst").distinct()
    there = edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    return pairs.exceptAll(there)


def stale(pages: DataFrame, evidence: DataFrame) -> DataFrame:
    """Pages older than their newest evidence (page_id, updated), in days (FN-D2)."""
    newest = evidence.groupBy("page_id").agg(F.max("updated").alias("newest"))
    return pages.join(newest, "page_id").select("page_id", F.datediff("newest", "updated").alias("days")).where("days > 0")


def minimum_pages(questions: DataFrame, pages: DataFrame, most: int = 2) -> DataFrame:
    """For each question (id, tokens) the pages (page_id, tokens) that share the most distinct tokens (SORT-6; overlap is our measure)."""
    q = questions.select("id", F.explode(F.array_distinct("tokens")).alias("token"))
    p = pages.select("page_id", F.explode(F.array_distinct("tokens")).alias("token"))
    shared = q.join(p, "token").groupBy("id", "page_id").agg(F.count("*").alias("overlap"))
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("overlap"), "page_id"))
    return shared.select("id", place.alias("place"), "page_id", "overlap").where(F.col("place") <= most)


def lint_report(pages: DataFrame, edges: DataFrame) -> DataFrame:
    """One row for each fault: kind and page."""
    return (
        orphans(pages, edges).select(F.lit("orphan").alias("fault"), "page_id")
        .unionByName(dead_links(edges, pages).select(F.lit("dead link").alias("fault"), F.col("dst").alias("page_id")))
        .unionByName(unpromoted(pages, edges).select(F.lit("unpromoted").alias("fault"), "page_id"))
    )


def semantic_graph(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of file → role → evidence (D13) from (path, role, evidence)."""
    nodes = files.select(F.explode(F.array("path", "role", "evidence")).alias("node")).where("node IS NOT NULL").distinct()
    edges = files.select(F.col("path").alias("src"), F.col("role").alias("dst"), F.lit("has role").alias("kind")).unionByName(files.select(F.col("role").alias("src"), F.col("evidence").alias("dst"), F.lit("shown by").alias("kind"))).where("src IS NOT NULL AND dst IS NOT NULL").distinct()
    return nodes, edges
