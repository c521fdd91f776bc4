"""Web pages as data, and matching of texts against site notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import head
from .classify import bounded_rows


def title(html: Column) -> Column:
    """SRC-13."""
    return F.nullif(F.regexp_extract(html, "(?s)<title>(.*?)</title>", 1), F.lit(""))


def links(html: Column) -> Column:
    """All link targets in order (SRC-18)."""
    return F.regexp_extract_all(html, F.lit('<a href="([^"]*)"'), F.lit(1))


def media(html: Column) -> Column:
    """Sources of images, audio and video (SRC-18)."""
    return F.regexp_extract_all(html, F.lit('<(?:img|audio|video|source)[^>]* src="([^"]*)"'), F.lit(1))


def visible_text(html: Column) -> Column:
    """Text without scripts, styles, comments and tags; a rough Markdown-less view (SRC-17)."""
    bare = F.regexp_replace(html, r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>", " ")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def page_info(pages: DataFrame) -> DataFrame:
    """Title, URL and whether the document is closed (SRC-13)."""
    return pages.select("page_id", title(F.col("html")).alias("title"), "url", F.col("html").contains("</html>").alias("ready"))


def only_pages(targets: DataFrame) -> DataFrame:
    """Browser targets that are pages (SRC-12)."""
    return targets.where("type = 'page'")


def evaluate(pages: DataFrame, name: str) -> DataFrame:
    """One of a fixed set of extractions per page as struct (value, error) (SRC-14, UDF-1); no free code runs."""
    known = {"title": title(F.col("html")), "links": F.size(links(F.col("html"))).cast("string"), "text": head(visible_text(F.col("html")))}
    value = known.get(name, F.lit(None).cast("string"))
    error = F.when(value.isNull(), F.lit(f"no value for {name}" if name in known else f"unknown extraction {name}"))
    return pages.select("page_id", F.struct(value.alias("value"), error.alias("error")).alias("result"))


def paginate(rows: DataFrame, order: str, size: int = 5) -> DataFrame:
    """Page numbers and totals of a listing with fixed page size (SRC-16); one window over the listing of one key."""
    from pyspark.sql import Window

    w = Window.partitionBy("key").orderBy(order)
    return rows.withColumn("rn", F.row_number().over(w) - 1).withColumn("page", F.floor(F.col("rn") / size).cast("long")).withColumn("total", F.count("*").over(Window.partitionBy("key"))).drop("rn")


def listing_items(responses: DataFrame, schema: str) -> DataFrame:
    """Items of nested listing responses (FN-J3): column ``body`` holds JSON with app_msg_list."""
    return responses.select("page", F.from_json("body", schema).alias("b")).select("page", F.col("b.total").alias("total"), F.explode("b.app_msg_list").alias("i")).select("page", "total", "i.*")


def note_from_file(files: DataFrame) -> DataFrame:
    """domain, aliases and body of site notes from (path, text) (PRJ-2, PRJ-3, FN-S5).

    Aliases come from the first line that starts ``aliases:`` anywhere; the body
    is what follows the second fence, without any later line that is a fence.
    """
    lines = F.split("text", "\n")
    raw = F.regexp_extract("text", r"(?m)^aliases:[ \t]*(.*)$", 1)
    aliases = F.rtrim(F.regexp_replace(F.regexp_replace(raw, r"[\[\]]", ""), ", *", "|"))
    fences = F.aggregate(lines, F.struct(F.lit(0).alias("n"), F.array().cast("array<string>").alias("out")), lambda acc, x: F.when(x == "---", F.struct((acc["n"] + 1).alias("n"), acc["out"].alias("out"))).otherwise(F.struct(acc["n"].alias("n"), F.when(acc["n"] >= 2, F.concat(acc["out"], F.array(x))).otherwise(acc["out"]).alias("out"))))
    return files.select(F.regexp_extract("path", r"([^/]+)\.md\z", 1).alias("domain"), F.nullif(aliases, F.lit("")).alias("aliases"), F.array_join(fences["out"], "\n").alias("body"))


def site_match(inputs: DataFrame, text: str, notes: DataFrame) -> DataFrame:
    """All notes whose ``domain|alias…`` is in the text, in any case, as an unescaped regular expression (JOIN-1).

    The notes are a rule table of bounded size, so each is one expression and no
    row is moved; empty texts match nothing.
    """
    found = [(r["domain"], r["body"], "|".join(x for x in (r["domain"], r["aliases"]) if x is not None)) for r in bounded_rows(notes)]
    hits = F.array(*(F.when(F.col(text).rlike(f"(?iu){p}"), F.struct(F.lit(d).alias("domain"), F.lit(b).cast("string").alias("body"))) for d, b, p in found)) if found else F.array().cast("array<struct<domain: string, body: string>>")
    rows = inputs.where(F.coalesce(F.col(text), F.lit("")) != "")
    return rows.select("*", F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("_note")).select(*inputs.columns, "_note.domain", "_note.body")


def fetched(pages: DataFrame, wanted: Column) -> DataFrame:
    """page_id and content by what is wanted (SRC-17): raw HTML, the title and links alone, or the visible text."""
    html = F.col("html")
    brief = F.concat_ws("\n", title(html), F.array_join(links(html), "\n"))
    return pages.select("page_id", wanted.alias("wanted"), F.when(wanted == "raw html", html).when(wanted == "links", brief).otherwise(visible_text(html)).alias("content"))
