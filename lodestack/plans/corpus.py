"""Queries over documents and labels: inventory, gates, style, intake."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..operators import classify, inventory, textstyle
from ..operators.rules import count_true
from ..session import table


@query("JOIN-6 AGG-1", "SELECT count(*) AS sources, count(l.doc_id) AS processed, count(*) - count(l.doc_id) AS missing FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)")
def inventory_completeness(spark, sf):
    state = inventory.completeness(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id"), "doc_id")
    return state.where("expected > 0").agg(F.count("*").alias("sources"), F.count_if(F.col("found") > 0).alias("processed"), F.count_if(F.col("found") == 0).alias("missing"))


@query("JOIN-6 JOIN-8", "SELECT CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'extra' WHEN l.n > d.n THEN 'duplicate' ELSE 'complete' END AS state, count(*) AS n FROM (SELECT doc_id, count(*) AS n FROM documents GROUP BY 1) d FULL JOIN (SELECT doc_id, count(*) AS n FROM labels GROUP BY 1) l ON d.doc_id = l.doc_id GROUP BY 1")
def inventory_states(spark, sf):
    state = inventory.completeness(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id"), "doc_id")
    return state.groupBy("state").agg(F.count("*").alias("n"))


@query("JOIN-7 JOIN-9", "SELECT doc_id, source FROM documents ANTI JOIN labels USING (doc_id)")
def unprocessed_items(spark, sf):
    return inventory.unprocessed(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels"), "doc_id")


@query("JOIN-10", "SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'create' ELSE 'update' END AS action FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id")
def note_actions(spark, sf):
    return inventory.create_or_update(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id")


@query("AGG-2", "SELECT md5(text) AS digest, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_items(spark, sf):
    return inventory.duplicates(table(spark, sf, "documents"), F.md5("text").alias("digest"))


@query("FIL-18", "SELECT doc_id, CASE WHEN text IS NULL OR trim(text) = '' THEN 'text' WHEN lang IS NULL OR trim(lang) = '' THEN 'lang' WHEN source IS NULL OR trim(source) = '' THEN 'source' ELSE 'none' END AS lacking FROM documents")
def missing_fields(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.coalesce(inventory.lacks("text", "lang", "source"), F.lit("none")).alias("lacking"))


@query("PRJ-1", "SELECT doc_id, lang, source, n_chars FROM documents")
def public_index(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")


@query("FIL-16 FIL-17", r"""SELECT doc_id, regexp_matches(text, '(^|[\s"''(])/(home|root|Users|tmp|var)/[\w.-]+') OR regexp_matches(text, '[A-Za-z]:\\[\w.-]+')
 OR regexp_matches(text, '(?i)\b(password|passwd|api[_-]?key|secret|token|cookie)\s*[:=]\s*\S+') OR regexp_matches(text, '[\w.+-]+@[\w-]+\.[\w.]+') OR regexp_matches(text, '(?i)\btransid[s]?\b')
 OR regexp_matches(text, '(?i)\.(mp3|mp4|wav|m4a|mov|log)\b') OR regexp_matches(lower(text), 'the transcript says|the material mentions|we should do next|this video is about|可沉淀内容|后台') AS blocked FROM documents""")
def publish_gate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", inventory.blocked(F.col("text")).alias("blocked"))


@query("FIL-17", "SELECT conv_id, turn, regexp_matches(lower(text), 'the transcript says|the material mentions|we should do next|this video is about|可沉淀内容|后台') AS backstage FROM conversations")
def backstage_phrases(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", inventory.backstage(F.col("text")).alias("backstage"))


@query("FIL-16 JOIN-9", """WITH w AS (SELECT item_id, text, len(string_split(text, ' ')) AS n FROM benchmark) SELECT DISTINCT d.doc_id, w.item_id FROM documents d JOIN w ON contains(d.text, w.text)""")
def benchmark_leak(spark, sf):
    """Documents that hold a whole benchmark passage."""
    items = table(spark, sf, "benchmark").where("text IS NOT NULL AND text != ''").select("item_id", F.col("text").alias("passage"))
    docs = table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", "text")
    return textstyle.holding(docs, "doc_id", "text", items, "item_id", "passage")


@query("AGG-1 AGG-3 AGG-14", "SELECT source, count(*) AS sources, count(l.doc_id) AS processed, count(*) - count(l.doc_id) AS unprocessed, count(*) - count(DISTINCT text) AS duplicates, CAST(sum(length(text)) AS BIGINT) AS size FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY source")
def completion_report(spark, sf):
    return inventory.completion_report(table(spark, sf, "documents").select("doc_id", "source", "text"), table(spark, sf, "labels"), "doc_id", "source", "text")


@query("AGG-3 CLS-12", "SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2")
def series_counts(spark, sf):
    return table(spark, sf, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))


@query("FIL-19", "SELECT doc_id, CASE WHEN abs((length(text) - n_chars) * 1.0 / nullif(n_chars, 0)) > 0.1 THEN 'duration' WHEN trim(coalesce(text, '')) = '' THEN 'empty' WHEN 1 - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> ''))) * 1.0 / nullif(len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')), 0) > 0.5 THEN 'boilerplate' WHEN NOT regexp_matches(text, '[.,;:!?。，；：！？]') THEN 'punctuation' ELSE 'ok' END AS fault FROM documents")
def transcript_faults(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", inventory.transcript_fault(F.col("source"), F.col("source"), F.char_length("text"), F.col("n_chars"), F.col("text")).alias("fault"))


@query("SORT-5", "SELECT doc_id, min_by(path, r) AS path FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN 'local transcript' WHEN n_chars > 2000 THEN 'audio only' ELSE 'browser' END AS path, CASE WHEN lang = 'en' THEN 1 WHEN n_chars > 2000 THEN 3 ELSE 4 END AS r FROM documents UNION ALL SELECT doc_id, 'platform metadata', 2 FROM labels) GROUP BY doc_id")
def acquisition_path(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.when(F.col("lang") == "en", "local transcript").when(F.col("n_chars") > 2000, "audio only").otherwise("browser").alias("path"))
    return inventory.best_path(inventory.one_inventory(d, table(spark, sf, "labels").select("doc_id", F.lit("platform metadata").alias("path"))), "doc_id", "path")


@query("AGG-12 SET-4", "SELECT d.doc_id, (coalesce(quality, 0) = 1)::INT + (n_chars > 1000)::INT + (lang = 'en')::INT AS criteria FROM documents d LEFT JOIN labels USING (doc_id) WHERE (coalesce(quality, 0) = 1)::INT + (n_chars > 1000)::INT + (lang = 'en')::INT >= 2")
def topic_two_of_three(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return d.select("doc_id", count_true(F.col("quality") == 1, F.col("n_chars") > 1000, F.col("lang") == "en").alias("criteria")).where("criteria >= 2")


@query("AGG-13", "SELECT doc_id, CASE (n_chars > 500)::INT + (lang = 'en')::INT + contains(text, '?')::INT WHEN 3 THEN 'write' WHEN 2 THEN 'add a case' WHEN 1 THEN 'add a case' ELSE 'change angle' END AS verdict FROM documents")
def hook_knowledge_resonance(spark, sf):
    d = table(spark, sf, "documents")
    n = count_true(F.col("n_chars") > 500, F.col("lang") == "en", F.contains("text", F.lit("?")))
    return d.select("doc_id", F.when(n == 3, "write").when(n >= 1, "add a case").otherwise("change angle").alias("verdict"))


@query("AGG-21", "SELECT doc_id, count(*) AS paragraphs, round(stddev_samp(length(p)) / nullif(avg(length(p)), 0), 6) AS variation FROM (SELECT doc_id, unnest(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS p FROM documents) GROUP BY doc_id")
def style_uniformity(spark, sf):
    return textstyle.uniformity(table(spark, sf, "documents"), "doc_id", "text").withColumn("variation", F.round("variation", 6))


@query("AGG-21", "SELECT round(stddev_samp(n_chars) / avg(n_chars), 8) AS variation FROM documents")
def length_variation(spark, sf):
    return table(spark, sf, "documents").agg(F.round(F.stddev_samp("n_chars") / F.avg("n_chars"), 8).alias("variation"))


@query("FN-S16", "SELECT doc_id, len(regexp_extract_all(text, '[,.;:!?]')) AS marks, round(len(regexp_extract_all(text, '[,.;:!?]')) / nullif(length(text), 0), 6) AS density FROM documents")
def punctuation_density(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.regexp_count("text", F.lit("[,.;:!?]")).cast("long").alias("marks"), F.round(textstyle.density(F.col("text"), "[,.;:!?]"), 6).alias("density"))


@query("AGG-20", "SELECT doc_id, round(1 - len(list_distinct(string_split(text, chr(10)))) / len(string_split(text, chr(10))), 6) AS repetition FROM documents")
def repetition_ratio(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.round(textstyle.repetition(F.split("text", "\n")), 6).alias("repetition"))


@query("FN-S20", "SELECT doc_id, round(-sum(n / t * log2(n / t)), 6) AS entropy FROM (SELECT doc_id, n, sum(n) OVER (PARTITION BY doc_id) AS t FROM (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(list_filter(string_split(text, ' '), lambda x: x <> '')) AS w FROM documents) GROUP BY 1, 2)) GROUP BY doc_id")
def token_entropy(spark, sf):
    return textstyle.entropy(table(spark, sf, "documents"), "doc_id", "text").withColumn("entropy", F.round("entropy", 6))


@query("SRC-15 FN-S10", "SELECT doc_id, substring(text, 1, 100) AS head FROM documents")
def prefix_slice(spark, sf):
    from ..functions.strings import head

    return table(spark, sf, "documents").select("doc_id", head(F.col("text")).alias("head"))


@query("CLS-12", "SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)general public') THEN 'gpl' WHEN regexp_matches(text, '(?i)licen[sc]e') THEN 'licence' END AS label FROM documents")
def theme_join(spark, sf):
    themes = spark.createDataFrame([("gpl", 1, "general public"), ("licence", 2, "licen[sc]e")], "label string, priority int, pattern string")
    return classify.route_join(table(spark, sf, "documents").select("doc_id", "text"), "text", themes).select("doc_id", "label")


@query("CLS-12 AGG-3", "SELECT lang AS series, source AS subseries, CASE WHEN regexp_matches(text, '(?i)licen[sc]e|copyright') THEN 'licence' ELSE 'prose' END AS theme, CASE WHEN n_chars > 2000 THEN 'high' ELSE 'low' END AS product_value, CASE WHEN contains(text, '|') THEN 'table' ELSE 'note' END AS output_type, count(*) AS n FROM documents GROUP BY ALL")
def series_catalogue(spark, sf):
    """Documents by series, subseries, theme, product value and output type."""
    t = F.col("text")
    theme = F.coalesce(classify.matched(t, [("licen[sc]e|copyright", "licence")], ["label"])["label"], F.lit("prose"))
    rows = table(spark, sf, "documents").select(F.col("lang").alias("series"), F.col("source").alias("subseries"), theme.alias("theme"), F.when(F.col("n_chars") > 2000, "high").otherwise("low").alias("product_value"), F.when(F.contains(t, F.lit("|")), "table").otherwise("note").alias("output_type"))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


@query("CLS-18 FIL-26", "SELECT doc_id, CASE WHEN contains(text, '|') AND len(string_split(text, chr(10))) >= 2 THEN 'table' WHEN len(string_split(text, chr(10))) >= 2 THEN 'list' ELSE 'paragraph' END AS form, CASE WHEN regexp_matches(text, '(?i)\\b(is defined as|means|because|mechanism|revised|framework)\\b|定义|机制|修正') THEN 'keep' WHEN regexp_matches(text, '\\d') THEN 'drop' ELSE 'keep' END AS retention FROM documents".replace("\\\\", "\\"))
def display_and_retention(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents").select("doc_id", classify.display_form(F.size(F.split(t, "\n")), F.when(F.contains(t, F.lit("|")), 2).otherwise(1), F.lit(False)).alias("form"), classify.retention(t).alias("retention"))


@query("SORT-6", """WITH q AS (SELECT DISTINCT item_id AS id, unnest(list_filter(string_split(text, ' '), lambda x: x <> '')) AS t FROM benchmark), p AS (SELECT DISTINCT doc_id AS page_id, unnest(list_filter(string_split(text, ' '), lambda x: x <> '')) AS t FROM documents),
o AS (SELECT id, page_id, count(*) AS overlap FROM q JOIN p USING (t) GROUP BY 1, 2) SELECT id, place, page_id, overlap FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY overlap DESC, page_id) AS place FROM o) WHERE place <= 2""")
def minimum_pages(spark, sf):
    """For each benchmark passage the two documents that share most of its words."""
    from ..operators.wiki import minimum_pages as best

    words = lambda c: F.filter(F.split(c, " "), lambda x: x != "")
    q = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), words("text").alias("tokens"))
    p = table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), words("text").alias("tokens"))
    return best(q, p).withColumn("place", F.col("place").cast("long"))


@query("FN-M10", "WITH c AS (SELECT avg((toxic = 1)::INT) AS prior, avg((quality = 0)::INT) FILTER (toxic = 1) AS hit, avg((quality = 0)::INT) FILTER (toxic = 0) AS miss FROM labels) SELECT round(prior, 6) AS prior, round(coalesce(hit, 0), 6) AS hit, round(coalesce(prior * hit / nullif(prior * hit + (1 - prior) * miss, 0), 0), 6) AS posterior FROM c")
def posterior_toxic(spark, sf):
    from ..functions.finance import posterior

    t, q = F.col("toxic") == 1, F.col("quality") == 0
    c = table(spark, sf, "labels").agg(F.avg(t.cast("int")).alias("prior"), F.avg(F.when(t, q.cast("int"))).alias("hit"), F.avg(F.when(~t, q.cast("int"))).alias("miss"))
    return c.select(F.round("prior", 6).alias("prior"), F.round(F.coalesce("hit", F.lit(0.0)), 6).alias("hit"), F.round(F.coalesce(posterior(F.col("prior"), F.col("hit"), F.col("miss")), F.lit(0.0)), 6).alias("posterior"))
