"""Queries over web pages: titles, links, parameters, matching, roles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query, sql_rows
from ..functions import strings
from ..operators import classify, pages as ops, wiki
from ..session import table


@query("SRC-13", "SELECT page_id, nullif(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '') AS title, url, contains(html, '</html>') AS ready FROM pages")
def page_titles(spark, sf):
    return ops.page_info(table(spark, sf, "pages"))


@query("SRC-18", """SELECT page_id, href, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages) GROUP BY 1, 2""")
def page_links(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.explode(ops.links(F.col("html"))).alias("href")).groupBy("page_id", "href").agg(F.count("*").alias("n"))


@query("SRC-18", """SELECT count(*) AS links, count(DISTINCT href) AS distinct_links FROM (SELECT unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)""")
def link_totals(spark, sf):
    return table(spark, sf, "pages").select(F.explode(ops.links(F.col("html"))).alias("href")).agg(F.count("*").alias("links"), F.count_distinct("href").alias("distinct_links"))


@query("SRC-14 UDF-1", "SELECT page_id, CAST(len(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS error FROM pages")
def page_evaluate(spark, sf):
    return ops.evaluate(table(spark, sf, "pages"), "links").select("page_id", "result.value", "result.error")


@query("JOIN-1 FN-S6", r"SELECT url, p.domain FROM pages JOIN (VALUES ('example.net', '(?i)example.net'), ('en', '(?i)en|/en/'), ('spam-farm', '(?i)spam-farm')) AS p(domain, pattern) ON regexp_matches(url, p.pattern)")
def site_match(spark, sf):
    notes = spark.createDataFrame([("example.net", None, "a"), ("en", "/en/", "b"), ("spam-farm", None, "c")], "domain string, aliases string, body string")
    return ops.site_match(table(spark, sf, "pages").select("url"), "url", notes).select("url", "domain")


@query("FN-S12 FN-S13", r"SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref FROM pages")
def url_params(spark, sf):
    u = F.col("url")
    params = strings.query_map(u)
    return table(spark, sf, "pages").select("page_id", strings.host_of(u).alias("host"), strings.path_of(u).alias("path"), F.nullif(F.try_element_at(params, F.lit("page")), F.lit("")).alias("page"), F.nullif(F.try_element_at(params, F.lit("ref")), F.lit("")).alias("ref"))


def _paths_and_edges(spark, sf):
    p = table(spark, sf, "pages")
    paths = p.select(strings.path_of(F.col("url")).alias("page_id")).distinct()
    edges = p.select(strings.path_of(F.col("url")).alias("src"), F.explode(ops.links(F.col("html"))).alias("dst"))
    return paths, edges


_PATHS = r"""p AS (SELECT DISTINCT regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS page_id FROM pages), e AS (SELECT regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS src, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS dst FROM pages)"""


@query("JOIN-11", f"WITH {_PATHS} SELECT page_id FROM p WHERE page_id NOT IN (SELECT dst FROM e)")
def orphan_pages(spark, sf):
    paths, edges = _paths_and_edges(spark, sf)
    return wiki.orphans(paths, edges)


@query("JOIN-15", f"WITH {_PATHS} SELECT dst, count(*) AS links FROM e WHERE dst NOT IN (SELECT page_id FROM p) GROUP BY 1")
def dead_links(spark, sf):
    paths, edges = _paths_and_edges(spark, sf)
    return wiki.dead_links(edges, paths)


@query("FIL-20", r"SELECT page_id, CASE WHEN regexp_matches(lower(url), '(^|/)(\.git|__pycache__|node_modules|\.cache)/|(^|/)\.[^/]+$') THEN 'noise' WHEN regexp_matches(lower(url), '(^|/)(tmp|temp)/') THEN 'temporary' WHEN regexp_matches(lower(url), '(^|/)(wiki|notes)/.*\.md$') THEN 'knowledge' WHEN regexp_matches(lower(url), '\.(py|sh|ps1|mjs|js|ts)$') THEN 'script' WHEN regexp_matches(lower(url), '(^|/)(outputs?|dist|build)/') THEN 'output' ELSE 'raw' END AS role FROM pages")
def file_roles(spark, sf):
    return table(spark, sf, "pages").select("page_id", classify.file_role(F.col("url")).alias("role"))


@query("PRJ-2 PRJ-4 FN-S5 FN-S14", r"SELECT page_id, regexp_extract(url, '([^/]+)\.html', 1) AS base, regexp_replace(regexp_replace(url, '[^\p{L}\p{N}.-]+', '_', 'g'), '^_+|_+$', '', 'g') || '__' || page_id AS file FROM pages")
def page_files(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("url", r"([^/]+)\.html", 1).alias("base"), strings.safe_filename(F.col("url"), F.col("page_id").cast("string")).alias("file"))


@query("CLS-19", "SELECT page_id, CASE WHEN contains(url, 'spam') THEN 'browser' WHEN contains(html, '<script') THEN 'curl' ELSE 'fetch' END AS tool FROM pages WHERE starts_with(url, 'https')")
def web_tool(spark, sf):
    kind = F.when(F.contains("url", F.lit("spam")), "blocked or private").when(F.contains("html", F.lit("<script")), "raw html").otherwise("extract")
    p = table(spark, sf, "pages").withColumn("type", F.when(F.startswith("url", F.lit("https")), "page").otherwise("worker"))
    return ops.only_pages(p).select("page_id", strings.lookup(classify.WEB_TOOLS, kind).alias("tool"))


@query("SRC-17", r"""SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'raw html' WHEN 1 THEN 'links' ELSE 'text' END AS wanted, md5(CASE page_id % 3 WHEN 0 THEN html
 WHEN 1 THEN concat_ws(chr(10), nullif(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), ''), array_to_string(regexp_extract_all(html, '<a href="([^"]*)"', 1), chr(10)))
 ELSE trim(regexp_replace(regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) END) AS content_md5 FROM pages""".replace("\\\\", "\\"))
def page_fetch(spark, sf):
    """A page as raw HTML, as title and links, or as visible text, by what is wanted of it."""
    kind = F.when(F.col("page_id") % 3 == 0, "raw html").when(F.col("page_id") % 3 == 1, "links").otherwise("text")
    return ops.fetched(table(spark, sf, "pages"), kind).select("page_id", "wanted", F.md5("content").alias("content_md5"))


#: Browser targets as they are listed.
_TARGETS = [("page", "https://a.example/"), ("service_worker", "https://a.example/sw.js"), ("iframe", "https://b.example/"), ("page", "about:blank"), ("background_page", "chrome-extension://x")]


@query("SRC-12", f"SELECT n_nationkey, url FROM nation, (VALUES {sql_rows(_TARGETS)}) AS t(type, url) WHERE type = 'page'")
def page_targets(spark, sf):
    """The pages among the targets of a browser in each nation."""
    targets = F.array(*(F.struct(F.lit(t).alias("type"), F.lit(u).alias("url")) for t, u in _TARGETS))
    return ops.only_pages(table(spark, sf, "nation").select("n_nationkey", F.explode(targets).alias("t")).select("n_nationkey", "t.*")).select("n_nationkey", "url")
