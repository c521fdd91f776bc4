"""Classification by rule tables: rows of (label, priority, pattern), or boolean columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .rules import count_true
from .tables import FIRST_HAND, GAPS

WEB_TOOLS = {"discover": "search", "extract": "fetch", "raw html": "curl", "blocked or private": "browser", "login or interaction": "browser"}
#: Rules that a table held as rows may have; they become one expression.
MOST_RULES = 1000


def bounded_rows(table: DataFrame, most: int = MOST_RULES) -> list[Row]:
    """The rows of a rule table; more than ``most`` are an error."""
    rows = table.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a rule table may have {most} rows")
    return rows


def route(text: Column, table: list[tuple[str, str]], default: str = "none") -> Column:
    """The first label whose pattern is in the text, in any case (CLS-1, CLS-2, CLS-9).

    The table is code, so this is one CASE without a join.
    """
    out = None
    for label, pattern in table:
        hit = text.rlike(f"(?iu){pattern}")
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def matched(text: Column, rules: list[tuple], names: list[str]) -> Column:
    """The values, as a struct of ``names``, of the first rule whose pattern is in the text, in any case; null without a match (CLS-1, 2, 5, 9, 16).

    A rule is a tuple (pattern, value, value, ...).  The rules are one CASE: no
    join, and no row is moved.
    """
    kind = "struct<" + ", ".join(f"{n}: string" for n in names) + ">"
    out = F.lit(None).cast(kind)
    for pattern, *values in reversed(rules):
        out = F.when(text.rlike(f"(?iu){pattern}"), F.struct(*(F.lit(v).alias(n) for n, v in zip(names, values, strict=True)))).otherwise(out)
    return out


def route_join(df: DataFrame, text: str, table: DataFrame) -> DataFrame:
    """``df`` with ``label`` by a table (label, priority, pattern) held as rows; the best priority wins, null without a match (CLS-12)."""
    rules = sorted(bounded_rows(table), key=lambda r: (r["priority"], r["label"]))
    return df.withColumn("label", matched(F.col(text), [(r["pattern"], r["label"]) for r in rules], ["label"])["label"])


def scores(text: Column, table: list[tuple[str, str]]) -> Column:
    """label → number of matches (CLS-3)."""
    return F.map_from_arrays(F.array(*(F.lit(k) for k, _ in table)), F.array(*(F.regexp_count(text, F.lit(f"(?iu){p}")) for _, p in table)))


def argmax(scored: Column, default: str = "none") -> Column:
    """The label with the highest positive score, the first in order on ties (CLS-3: mixed texts get one main type)."""
    entries = F.map_entries(scored)
    top = F.array_max(F.transform(entries, lambda e: e["value"]))
    return F.when(F.coalesce(top, F.lit(0)) > 0, F.element_at(F.filter(entries, lambda e: e["value"] == top), 1)["key"]).otherwise(default)


def gap_tools(df: DataFrame, gap: str) -> DataFrame:
    """``df`` with the main tools, supporting chain and output focus for what is missing (CLS-4); null for an unknown gap."""
    found = F.element_at(F.create_map(*(x for g, *rest in GAPS for x in (F.lit(g), F.array(*map(F.lit, rest))))), F.col(gap))
    return df.select("*", *(found[i].alias(n) for i, n in enumerate(("main_tools", "chain", "focus"))))


def timing(built: Column) -> Column:
    """CLS-6, the first axis."""
    return F.when(built, "reflection").otherwise("planning")


def lens(niche: Column, primitive: Column, frugal: Column) -> Column:
    """CLS-6, the second axis: none or several asked for means the full pass."""
    n = count_true(niche, primitive, frugal)
    return F.when(n != 1, "full").when(niche, "niche").when(primitive, "primitive").otherwise("frugal")


def disposition(pulls_weight: Column, plausible_later: Column, callable_: Column) -> Column:
    """Expose, keep, defer or cut (CLS-7)."""
    return F.when(callable_, "expose").when(pulls_weight, "keep").when(plausible_later, "defer").otherwise("cut")


def opportunity(*tests: Column) -> Column:
    """How many of the eight opportunity tests hold (CLS-8)."""
    return count_true(*tests)


def shape(*primitive_side: Column) -> Column:
    """Solution- or primitive-shaped by the majority of five dimensions (CLS-10)."""
    return F.when(2 * count_true(*primitive_side) > len(primitive_side), "primitive").otherwise("solution")


def container(reuse: Column, needs_trigger: Column, global_rule: Column) -> Column:
    """The smallest container that keeps a method (CLS-11)."""
    return F.when(global_rule, "global rule").when(needs_trigger, "skill").when(reuse, "prompt").otherwise("answer")


def display_form(items: Column, columns: Column, narrative: Column) -> Column:
    """Table for several columns, list for several items, else a paragraph (CLS-18; thresholds ours)."""
    return F.when(narrative, "paragraph").when((columns >= 2) & (items >= 2), "table").when(items >= 2, "list").otherwise("paragraph")


def file_role(path: Column) -> Column:
    """Six buckets by folder and extension (FIL-20); a Markdown file is knowledge only in a wiki folder."""
    p = F.lower(path)
    return (
        F.when(p.rlike(r"(^|/)(\.git|__pycache__|node_modules|\.cache)/|(^|/)\.[^/]+\z"), "noise")
        .when(p.rlike(r"(^|/)(tmp|temp)/"), "temporary")
        .when(p.rlike(r"(^|/)(wiki|notes)/.*\.md\z"), "knowledge")
        .when(p.rlike(r"\.(py|sh|ps1|mjs|js|ts)\z"), "script")
        .when(p.rlike(r"(^|/)(outputs?|dist|build)/"), "output")
        .otherwise("raw")
    )


def workspace_mode(chaotic: Column, hard_to_read: Column) -> Column:
    """FIL-21: compilation-first unless chaos alone, hybrid for both."""
    return F.when(chaotic & hard_to_read, "hybrid").when(chaotic, "structure-first").otherwise("compilation-first")


def fan_out(independent: Column, tasks: Column, heavy: Column) -> Column:
    """FIL-27: work is dealt out if the targets are independent, several, and each is large enough."""
    return independent & (tasks >= 2) & heavy


def retention(text: Column) -> Column:
    """Keep definitions, mechanisms and revisions, drop point values (FIL-26; by a small lexicon, ours)."""
    return F.when(text.rlike(r"(?iu)\b(is defined as|means|because|mechanism|revised|framework)\b|定义|机制|修正"), "keep").when(text.rlike(r"\d"), "drop").otherwise("keep")


def first_hand(kind: Column, source: Column) -> Column:
    """Whether a source is the first-hand one for this kind of claim (CLS-20)."""
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in FIRST_HAND for x in pair)), kind) == source, F.lit(False))


def evidence_tier(df: DataFrame, claim: str, source: str, first_hand: str) -> DataFrame:
    """Per claim: first-hand if any source is, else secondary, or single for one source only (CLS-20)."""
    per = df.groupBy(claim).agg(F.max(F.col(first_hand).cast("int")).alias("_f"), F.count_distinct(source).alias("sources"))
    return per.select(claim, "sources", F.when(F.col("_f") == 1, "first-hand").when(F.col("sources") == 1, "single source").otherwise("secondary").alias("tier"))
