"""Queries on the rule tables: each customer, part or document says one of the phrases that the tables know, or none."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query, sql_rows, sql_text
from ..operators import classify, textstyle
from ..operators.tables import ARCHETYPES, GAPS, MACRO_KINDS, PRIMITIVES, QUESTION_SIGNALS, ROUTES, WRITING_MODES
from ..session import table


def _said(key, name, phrases):
    """A text for each row: one of the phrases, and a name."""
    return F.concat(F.element_at(F.array(*map(F.lit, phrases)), (F.col(key) % len(phrases) + 1).cast("int")), F.lit(" / "), F.col(name)).alias("said")


def _said_sql(key, name, phrases):
    return f"list_extract([{', '.join(map(sql_text, phrases))}], ({key} % {len(phrases)} + 1)::INT) || ' / ' || {name}"


def _first_rule(key, rows, names, text, source):
    """SQL: the values of the first rule whose pattern is in the text."""
    values = ", ".join(names)
    return f"WITH s AS (SELECT {key}, {text} AS said FROM {source}), r AS (SELECT * FROM (VALUES {sql_rows([(i, *r) for i, r in enumerate(rows)])}) AS v(i, pattern, {values})), b AS (SELECT {key}, min(i) AS i FROM s JOIN r ON regexp_matches(said, '(?i)(' || pattern || ')') GROUP BY 1) SELECT s.{key}, {values} FROM s LEFT JOIN b ON b.{key} = s.{key} LEFT JOIN r ON r.i = b.i"


_ASKED = [f"请问，{x}？" for p, *_ in QUESTION_SIGNALS for x in p.split("|")] + ["今天天气不错", "我知道但做不出来，又拖延"]
_SIGNALS = ["tools", "ask_next"]


@query("CLS-5", _first_rule("c_custkey", QUESTION_SIGNALS, _SIGNALS, _said_sql("c_custkey", "c_name", _ASKED), "customer"))
def question_signals(spark, sf):
    """The candidate tools for a question, and what to ask next."""
    c = table(spark, sf, "customer").select("c_custkey", _said("c_custkey", "c_name", _ASKED))
    return c.select("c_custkey", classify.matched(F.col("said"), QUESTION_SIGNALS, _SIGNALS).alias("r")).select("c_custkey", "r.*")


_WANTED = [f"老师，{x}吧" for _, p in ROUTES for x in p.split("|")] + ["帮我分析一下，再写公众号", "hello"]


@query("CLS-1", _first_rule("c_custkey", [(p, x) for x, p in ROUTES], ["layer"], _said_sql("c_custkey", "c_name", _WANTED), "customer"))
def request_route(spark, sf):
    """The ability layer that a request asks for."""
    c = table(spark, sf, "customer").select("c_custkey", _said("c_custkey", "c_name", _WANTED))
    return c.select("c_custkey", classify.matched(F.col("said"), [(p, x) for x, p in ROUTES], ["layer"])["layer"].alias("layer"))


_TASKS = [f"{x}。" for _, p, _ in WRITING_MODES for x in p.split("|")] + ["给我标题，检查下问题", "这篇太 ai 了", "别的事"]
_MODES = [(p, m, d) for m, p, d in WRITING_MODES]


@query("CLS-2", _first_rule("p_partkey", _MODES, ["mode", "deliverable"], _said_sql("p_partkey", "p_name", _TASKS), "part"))
def writing_modes(spark, sf):
    """The writing mode of a request, and what it delivers."""
    p = table(spark, sf, "part").select("p_partkey", _said("p_partkey", "p_name", _TASKS))
    return p.select("p_partkey", classify.matched(F.col("said"), _MODES, ["mode", "deliverable"]).alias("r")).select("p_partkey", "r.*")


@query("CLS-4", f"SELECT c_custkey, main_tools, chain, focus FROM customer LEFT JOIN (VALUES {sql_rows([(i, *r[1:]) for i, r in enumerate(GAPS)])}) AS g(i, main_tools, chain, focus) ON i = c_custkey % {len(GAPS) + 1}")
def gap_tools(spark, sf):
    """Main tools, chain and output focus for each of the things that may be missing, and for one that is unknown."""
    gap = F.element_at(F.array(*(F.lit(g) for g, *_ in GAPS), F.lit("别的")), (F.col("c_custkey") % (len(GAPS) + 1) + 1).cast("int"))
    return classify.gap_tools(table(spark, sf, "customer").select("c_custkey", gap.alias("gap")), "gap").drop("gap")


_MATERIAL = ["我亲历了一次实验，实测了工具", "热点争议与行业变化", "这个插件是一种具体工具", "我的经验、心得与框架", "产品体验", "别的", "工具 工具 方法论", "调查 热点"]


@query("CLS-3", f"""WITH s AS (SELECT p_partkey, {_said_sql("p_partkey", "p_name", _MATERIAL)} AS said FROM part), n AS (SELECT p_partkey, i, label, len(regexp_extract_all(said, pattern)) AS n FROM s, (VALUES {sql_rows([(i, *r) for i, r in enumerate(ARCHETYPES)])}) AS a(i, label, pattern))
SELECT p_partkey, CASE WHEN max(n) = 0 THEN 'none' ELSE arg_max(label, n * 100 - i) END AS archetype FROM n GROUP BY 1""")
def main_archetype(spark, sf):
    """The article archetype with the most marks in the material; mixed material gets one main type."""
    p = table(spark, sf, "part").select("p_partkey", _said("p_partkey", "p_name", _MATERIAL))
    return p.select("p_partkey", classify.argmax(classify.scores(F.col("said"), ARCHETYPES)).alias("archetype"))


_THINGS = [f"a {x} here" for _, p in PRIMITIVES for x in p.split("|")] + ["nothing", "Verify the Schema"]


@query("CLS-9", _first_rule("p_partkey", [(p, k) for k, p in PRIMITIVES], ["kind"], _said_sql("p_partkey", "'-'", _THINGS), "part"))
def primitive_kind(spark, sf):
    """The type of primitive that a part is described as."""
    p = table(spark, sf, "part").select("p_partkey", F.lit("-").alias("dash")).select("p_partkey", _said("p_partkey", "dash", _THINGS))
    return p.select("p_partkey", classify.matched(F.col("said"), [(x, k) for k, x in PRIMITIVES], ["kind"])["kind"].alias("kind"))


_NOTES = [f"关于{x}的材料" for _, p, _ in MACRO_KINDS for x in p.split("|")] + ["别的", "周期与定义"]
_MACRO = [(p, k, q) for k, p, q in MACRO_KINDS]


@query("CLS-16", _first_rule("s_suppkey", _MACRO, ["kind", "settles"], _said_sql("s_suppkey", "s_name", _NOTES), "supplier"))
def macro_kinds(spark, sf):
    """The kind of macro information in a note, and what it settles."""
    s = table(spark, sf, "supplier").select("s_suppkey", _said("s_suppkey", "s_name", _NOTES))
    return s.select("s_suppkey", classify.matched(F.col("said"), _MACRO, ["kind", "settles"]).alias("r")).select("s_suppkey", "r.*")


#: What is added to each document: stock sentences, abstract words, attributions, label endings, and plain endings.
_ENDS = ["不是快，而是稳。不是多，而是准。", "综上所述，核心 价值 与 趋势", "报告说 底层逻辑 的 重要性", "希望对你有所帮助", "以上就是全部内容  ", "材料指出，这，才是 黄金", "完"]


@query("FN-S15 FN-S17 FN-S18 FN-S19", f"""WITH s AS (SELECT doc_id, coalesce(text, '') || chr(10) || list_extract([{", ".join(map(sql_text, _ENDS))}], (doc_id % {len(_ENDS)} + 1)::INT) AS t FROM documents)
SELECT doc_id, len(regexp_extract_all(t, '{"|".join(textstyle.CLICHES)}')) AS stock, round(len(regexp_extract_all(t, '{"|".join(textstyle.ABSTRACT)}')) / nullif(len(list_filter(string_split(t, ' '), lambda x: x <> '')), 0), 6) AS abstract,
 regexp_matches(list_extract(string_split(rtrim(t, ' '), chr(10)), -1), '{"|".join(textstyle.LABEL_ENDINGS)}') AS label_ending, regexp_matches(t, '{"|".join(textstyle.ATTRIBUTIONS)}') AS attributed FROM s""")
def style_lexicons(spark, sf):
    """Stock sentences, abstract words, label endings and attributions of each document with a closing line."""
    end = F.element_at(F.array(*map(F.lit, _ENDS)), (F.col("doc_id") % len(_ENDS) + 1).cast("int"))
    t = F.col("t")
    d = table(spark, sf, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit("\n"), end).alias("t"))
    return d.select("doc_id", textstyle.stock_sentences(t).cast("long").alias("stock"), F.round(textstyle.word_density(t), 6).alias("abstract"), textstyle.label_ending(t).alias("label_ending"), textstyle.attributed(t).alias("attributed"))
