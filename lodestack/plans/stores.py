"""Queries that write and read again: CSV, JSON, save modes, logs, snapshots; and the acquisition rules around them."""

from __future__ import annotations

import inspect
import re

from pyspark.sql import functions as F

from ..catalog import query, sql_rows
from ..functions import strings
from ..operators import pages as page_ops
from ..operators.inventory import one_inventory
from ..schemas import EVAL_SET, TABLES
from ..session import table
from ..sources import documents, sinks
from ..sources.shared import scratch


@query("SRC-9 SNK-9 PRJ-1 FIL-16", r"""SELECT doc_id, lang, source, n_chars FROM documents WHERE NOT regexp_matches(text, '[\w.+-]+@[\w-]+\.[\w.]+')""")
def published_csv(spark, sf):
    """Rows that pass a gate, written as CSV in a folder of their own and read with their schema."""
    at = scratch(spark, "files")
    d = table(spark, sf, "documents")
    sinks.publish(d, f"{at}/public", F.col("text").rlike(r"[\w.+-]+@[\w-]+\.[\w.]+"), ["doc_id", "lang", "source", "n_chars"])
    spark.read.parquet(f"{at}/public").write.csv(f"{at}/csv", header=True, escape='"')
    return documents.read_csv(spark, f"{at}/csv", d.select("doc_id", "lang", "source", "n_chars").schema)


@query("SRC-8 D6 FN-J1 FN-J3", "SELECT 'conv-' || conv_id AS skill_name, CAST(turn AS INT) AS id, text AS prompt, role AS expected_output FROM conversations")
def json_documents(spark, sf):
    """Conversations as eval sets: JSON documents written, read with an explicit schema, unpacked."""
    at = scratch(spark, "files")
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(F.col("turn").cast("int").alias("id"), F.col("text").alias("prompt"), F.col("role").alias("expected_output"), F.array().cast("array<string>").alias("files")))).alias("evals"))
    c.select(F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("skill_name"), "evals").write.json(f"{at}/evals")
    sets = spark.read.schema(EVAL_SET).json(f"{at}/evals")
    return sets.select("skill_name", F.explode("evals").alias("e")).select("skill_name", "e.id", "e.prompt", "e.expected_output")


@query("FN-J3 SRC-16 FN-J2", "SELECT CAST(user_id AS BIGINT) AS page, CAST(count(*) OVER (PARTITION BY user_id) AS BIGINT) AS total, CAST(event_id AS BIGINT) AS aid, event_type AS title FROM events")
def listing_unpack(spark, sf):
    """Nested listing responses unpacked into items."""
    items = F.sort_array(F.collect_list(F.struct(F.col("event_id").alias("aid"), F.col("event_type").alias("title"))))
    responses = table(spark, sf, "events").groupBy(F.col("user_id").alias("page")).agg(F.to_json(F.struct(F.count("*").alias("total"), items.alias("app_msg_list"))).alias("body"))
    return page_ops.listing_items(responses, "total bigint, app_msg_list array<struct<aid: bigint, title: string>>")


@query("SNK-3 SNK-4 SNK-7 SNK-11 FIL-13", "SELECT 'ignored' AS step, count(*) AS n FROM nation UNION ALL SELECT 'forced', count(*) FROM region UNION ALL SELECT 'appended', 2 * count(*) FROM region UNION ALL SELECT 'snapshot', 2 * count(*) FROM region UNION ALL SELECT 'pruned', count(*) FROM nation WHERE n_nationkey % 5 <> 0")
def save_modes(spark, sf):
    """A target skipped if there, overwritten, appended to, kept as a snapshot, and replaced by pruned rows."""
    at = scratch(spark, "files")
    nation, region = table(spark, sf, "nation").select("n_nationkey"), table(spark, sf, "region").select(F.col("r_regionkey").alias("n_nationkey"))
    steps = []

    def note(step, path):
        steps.append((step, spark.read.parquet(path).count()))

    sinks.write_if_absent(nation, f"{at}/t")
    sinks.write_if_absent(region, f"{at}/t")
    note("ignored", f"{at}/t")
    sinks.write_if_absent(region, f"{at}/t", force=True)
    note("forced", f"{at}/t")
    sinks.append_log(region, f"{at}/t")
    note("appended", f"{at}/t")
    note("snapshot", sinks.snapshot(spark.read.parquet(f"{at}/t"), f"{at}/kept", "20240102-030405"))
    files = nation.withColumn("relative", F.concat(F.when(F.col("n_nationkey") % 5 == 0, "__pycache__/").otherwise("src/"), F.col("n_nationkey").cast("string")))
    sinks.replace_pruned(files, f"{at}/t")
    note("pruned", f"{at}/t")
    return spark.createDataFrame(steps, "step string, n long")


@query("SRC-7 JOIN-5 FIL-12", "SELECT p.name, n.n_name IS NOT NULL AS there FROM (VALUES ('NATION_1'), ('NATION_3'), ('NATION_77')) AS p(name) LEFT JOIN nation n ON n.n_name = p.name")
def inline_sources(spark, sf):
    listed = documents.inline_table(spark, [("NATION_1", "a"), ("NATION_3", "b"), ("NATION_77", "c")])
    there = table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.lit(True).alias("there"))
    return listed.join(there, "name", "left").select("name", F.coalesce("there", F.lit(False)).alias("there"))


@query("SRC-11 SRC-19 SORT-5", """SELECT page_id, coalesce(nullif(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), ''), nullif(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), ''), url) AS label,
 CASE WHEN regexp_matches(url, '\\.(pdf|pptx?|docx?)') THEN 1 WHEN contains(url, '.html') THEN 2 ELSE 3 END AS reading_place FROM pages""".replace("\\\\", "\\"))
def first_label(spark, sf):
    """A page's label from the first source that has one, and its place in the reading order: originals first."""
    h = F.nullif(F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1), F.lit(""))
    place = F.when(F.col("url").rlike(r"\.(pdf|pptx?|docx?)"), 1).when(F.contains("url", F.lit(".html")), 2).otherwise(3)
    return table(spark, sf, "pages").select("page_id", documents.first_source(h, page_ops.title(F.col("html")), F.col("url")).alias("label"), place.alias("reading_place"))


@query("SET-3", "SELECT doc_id AS id, source AS origin FROM documents UNION ALL SELECT page_id, 'web' FROM pages UNION ALL SELECT conv_id, role FROM conversations")
def one_list(spark, sf):
    return one_inventory(
        table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("origin")),
        table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.lit("web").alias("origin")),
        table(spark, sf, "conversations").select(F.col("conv_id").alias("id"), F.col("role").alias("origin")),
    )


@query("PRJ-3 WIN-9 PRJ-2", """WITH t AS (SELECT conv_id, turn, string_split('---' || chr(10) || 'role: ' || role || chr(10) || '---' || chr(10) || text || chr(10) || '---' || chr(10) || 'end', chr(10)) AS lines FROM conversations),
x AS (SELECT conv_id, turn, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM t), f AS (SELECT *, sum((line = '---')::INT) OVER (PARTITION BY conv_id, turn ORDER BY place) AS fences FROM x)
SELECT 'c' || conv_id || '-' || turn AS domain, string_agg(line, chr(10) ORDER BY place) FILTER (fences >= 2 AND line <> '---') AS body FROM f GROUP BY conv_id, turn""")
def fenced_bodies(spark, sf):
    """What follows the second fence, later fences dropped: the running count is an array fold, so no row is exploded."""
    c = table(spark, sf, "conversations")
    name = F.concat(F.lit("/n/c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"), F.lit(".md"))
    text = F.concat(F.lit("---\nrole: "), F.col("role"), F.lit("\n---\n"), F.col("text"), F.lit("\n---\nend"))
    return page_ops.note_from_file(c.select(name.alias("path"), text.alias("text"))).select("domain", "body")


@query("FN-S4", "SELECT conv_id, turn, regexp_replace(' ' || chr(9) || text || chr(10), '^\\s+|\\s+$', '', 'g') AS text FROM conversations".replace("\\\\", "\\"))
def stripped(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", strings.strip_unicode(F.concat(F.lit(" \t"), F.col("text"), F.lit("\n"))).alias("text"))


#: Contents of port files, and the port and path that each gives.
_PORTS = [("9222\n/devtools/browser/a-b\n", 9222, "/devtools/browser/a-b"), ("9229", 9229, None), (" 8080 \n\n", 8080, None), ("70000\n/x", None, None), ("0\n/x", None, None), ("abc", None, None), ("", None, None), ("65535x\n/y", 65535, "/y"), ("-1", None, None)]


@query("SRC-10", f"SELECT s_suppkey, port, path FROM supplier JOIN (VALUES {sql_rows([(i, port, path) for i, (_, port, path) in enumerate(_PORTS)])}) AS p(i, port, path) ON i = s_suppkey % {len(_PORTS)}")
def port_files(spark, sf):
    """A port file for each supplier, parsed: the first line a port, the second a path if there is one."""
    content = F.element_at(F.array(*(F.lit(x) for x, _, _ in _PORTS)), (F.col("s_suppkey") % len(_PORTS) + 1).cast("int"))
    return table(spark, sf, "supplier").select("s_suppkey", documents.port_file(content).alias("p")).select("s_suppkey", F.col("p.port").alias("port"), F.col("p.path").alias("path"))


@query("SRC-5 SRC-6 SORT-1 PRJ-4", "SELECT n_name AS folder, 'notes.txt' AS relative, length(n_name) + 10 AS length FROM nation UNION ALL SELECT n_name, 'sub/name.txt', length(n_name) + 1 FROM nation")
def folder_walk(spark, sf):
    """Two files for each nation written and walked: folder, path below it and size."""
    at = f"{scratch(spark, 'walk')}/root"
    n = table(spark, sf, "nation").select("n_name")
    for part, text in (("notes.txt", F.concat(F.lit("notes on "), F.col("n_name"))), ("sub/name.txt", F.col("n_name"))):
        folder, _, name = part.rpartition("/")
        rows = n.select(text.alias("value"), F.col("n_name").alias("top"))
        rows.write.partitionBy("top").mode("overwrite").text(f"{at}/{folder or 'here'}/{name}")
    files = documents.walk(spark, at, content=False)
    parts = F.split("relative", "/")  # kind, file name, top=<nation>, Spark's part file
    at_top = F.when(F.get(parts, F.lit(0)) == "here", F.get(parts, F.lit(1))).otherwise(F.concat_ws("/", F.get(parts, F.lit(0)), F.get(parts, F.lit(1))))
    return files.select(F.regexp_replace(F.get(parts, F.lit(2)), "^top=", "").alias("folder"), at_top.alias("relative"), F.col("length").cast("long").alias("length"))


_TEMPLATES = {"SKILL.md": "---\nname: {{NAME}}\n---\n# {{TITLE}}\n", "scripts/example.py": "print('{{NAME}}')\n"}


@query("SNK-1 SNK-2 FN-S1 FN-S3", "WITH f AS (SELECT DISTINCT replace(lower(n_name), '_', '-') AS folder FROM nation WHERE n_nationkey >= 5) SELECT folder, 'SKILL.md' AS relative, '---' || chr(10) || 'name: ' || folder || chr(10) || '---' || chr(10) || '# Nation ' || split_part(folder, '-', 2) || chr(10) AS content FROM f UNION ALL SELECT folder, 'scripts/example.py', 'print(''' || folder || ''')' || chr(10) FROM f")
def scaffold_archives(spark, sf):
    """A folder from templates for each nation, but for five that are there; archived, and read from the archives again."""
    names = table(spark, sf, "nation").select("n_nationkey", F.translate(F.lower("n_name"), "_", "-").alias("folder"))
    files = sinks.scaffolded(names, _TEMPLATES, names.where("n_nationkey < 5"))
    back = sinks.unarchived(sinks.archived(files.withColumn("content", F.col("content").cast("binary"))))
    return back.select("folder", "relative", F.col("content").cast("string").alias("content"))


@query("SNK-10 AGG-14", "WITH v AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderstatus = 'F') SELECT count(*) FILTER (v.k IS NOT NULL) AS cleaned, CAST(coalesce(sum(l_quantity) FILTER (v.k IS NOT NULL), 0) AS BIGINT) AS cleaned_size, count(*) FILTER (v.k IS NULL) AS kept FROM lineitem LEFT JOIN v ON v.k = l_orderkey")
def cleaned_intermediates(spark, sf):
    """Lines of verified orders are cleaned away: how many, their size, and what is left in the table."""
    at = scratch(spark, "cleaned")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_quantity").cast("long").alias("size"))
    done = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"))
    report = sinks.cleaned(lines, done, "k", "size", at)
    return report.withColumn("kept", F.lit(spark.read.parquet(at).count()).cast("long"))


@query("UDF-4")
def tool_catalogue(spark, sf):
    """The named queries as tools: name, purpose, the tables that each reads, and the operators shown."""
    from ..catalog import QUERIES

    def described(name, q):
        read = {*re.findall(r'table\(spark, sf, "(\w+)"\)', inspect.getsource(q.run)), *re.findall(r"(?:FROM|JOIN) (\w+)", q.sql or "")}
        tables = sorted(read & set(TABLES))
        return name, " ".join((q.run.__doc__ or name.replace("_", " ")).split()), tables, list(q.operators)

    return spark.createDataFrame([described(n, q) for n, q in sorted(QUERIES.items())], "name string, purpose string, inputs array<string>, operators array<string>")
