"""Text style measures on columns; word lists are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored
from .classify import bounded_rows

# Patterns of stock sentences, label endings, attributions and abstract words.
CLICHES = ["不是[^。！？\\n]{0,40}而是", "黄金", "这，才是", "核心", "首先其次最后", "综上所述", "值得注意的是"]
LABEL_ENDINGS = ["以上就是全部内容", "希望对你有所帮助", "欢迎点赞收藏转发"]
ATTRIBUTIONS = ["报告说", "报告给出", "材料指出"]
ABSTRACT = ["价值", "趋势", "底层逻辑", "重要性"]


def stock_sentences(text: Column, patterns: list[str] = CLICHES) -> Column:
    """FN-S15."""
    return F.regexp_count(text, F.lit("|".join(patterns)))


def density(text: Column, pattern: str) -> Column:
    """Matches per character (FN-S16)."""
    return F.try_divide(F.regexp_count(text, F.lit(pattern)), F.char_length(text))


def word_density(text: Column, words: list[str] = ABSTRACT) -> Column:
    """Listed words per blank-split token (FN-S17)."""
    return F.try_divide(F.regexp_count(text, F.lit("|".join(words))), F.size(tokens(text)))


def label_ending(text: Column, endings: list[str] = LABEL_ENDINGS) -> Column:
    """Whether the last paragraph has a label-style ending (FN-S18)."""
    return F.element_at(F.split(F.rtrim(text), "\n"), -1).rlike("|".join(endings))


def attributed(text: Column, phrases: list[str] = ATTRIBUTIONS) -> Column:
    """FN-S19."""
    return text.rlike("|".join(phrases))


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda t: t != "")


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "[.!?。！？\\n]"), lambda s: F.trim(s)), lambda s: s != "")


def repetition(parts: Column) -> Column:
    """1 - distinct / total of an array (AGG-20)."""
    return 1 - F.try_divide(F.size(F.array_distinct(parts)), F.size(parts))


def uniformity(df: DataFrame, key: str, text: str) -> DataFrame:
    """Number of paragraphs of each text, and the coefficient of variation of their lengths (AGG-21); null for one paragraph.  A text without paragraphs has no row."""
    p = df.select(key, F.transform(F.filter(F.split(text, "\n"), lambda x: F.trim(x) != ""), lambda x: F.char_length(x).cast("double")).alias("p")).where(F.size("p") > 0)
    p = p.withColumn("n", F.size("p")).withColumn("mean", F.aggregate("p", F.lit(0.0), lambda a, x: a + x) / F.col("n"))
    squares = F.aggregate("p", F.lit(0.0), lambda a, x: a + (x - F.col("mean")) * (x - F.col("mean")))
    return p.select(key, F.col("n").cast("long").alias("paragraphs"), F.when(F.col("n") > 1, F.try_divide(F.sqrt(squares / (F.col("n") - 1)), F.col("mean"))).alias("variation"))


def entropy(df: DataFrame, key: str, text: str) -> DataFrame:
    """Shannon entropy in bits of the blank-split tokens of each text (FN-S20); a text without tokens has no row.

    H = log2(N) - sum(n * log2(n)) / N, over the runs of the sorted tokens: no row
    is exploded or moved.
    """
    t = df.select(key, F.sort_array(tokens(F.col(text))).alias("t")).where(F.size("t") > 0)
    part = lambda n: F.when(n > 1, n * F.log2(n)).otherwise(0.0)
    state = lambda last, n, total: F.struct(last.alias("last"), n.alias("n"), total.alias("total"))
    step = lambda a, x: F.when(x == a["last"], state(a["last"], a["n"] + 1, a["total"])).otherwise(state(x, F.lit(1), a["total"] + part(a["n"])))
    spent = F.aggregate("t", state(F.lit(None).cast("string"), F.lit(0), F.lit(0.0)), step, lambda a: a["total"] + part(a["n"]))
    return t.select(key, (F.log2(F.size("t")) - spent / F.size("t")).alias("entropy"))


def holding(docs: DataFrame, key: str, text: str, passages: DataFrame, item: str, passage: str, size: int = 4) -> DataFrame:
    """(key, item) of the texts that hold a whole passage.

    A passage's inner words, all but the first and last, stand whole in a text
    that holds it.  So windows of ``size`` words are hashed on both sides; of
    each passage only the window that is rarest in the texts is joined, and those
    pairs are confirmed.  Passages too short for a window are a rule table of
    bounded size, and each is looked for in every text.
    """
    windows = lambda w: F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.xxhash64(F.slice(w, i, size))))
    words = lambda c: F.split(c, " ")
    inner = F.slice(words(passage), 2, F.greatest(F.size(words(passage)) - 2, F.lit(0)))
    p = passages.select(item, passage, inner.alias("_w"))
    keyed = p.where(F.size("_w") >= size).select(item, F.explode(windows("_w")).alias("_k"))
    t = docs.select(key, words(text).alias("_w")).where(F.size("_w") >= size).select(key, F.explode(windows("_w")).alias("_k"))
    met = stored(t.join(keyed.select("_k").distinct(), "_k"), "windows")  # texts' windows that a passage has
    often = met.groupBy("_k").agg(F.count("*").alias("_n"))
    rarest = keyed.join(often, "_k", "left").groupBy(item).agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_k").alias("k"))).alias("_r")).where("_r.n > 0").select(item, F.col("_r.k").alias("_k"))
    near = met.join(rarest, "_k").select(key, item).distinct()
    found = near.join(passages.select(item, passage), item).join(docs.select(key, text), key).where(F.contains(text, passage)).select(key, item)
    short = [(r[item], r[passage]) for r in bounded_rows(p.where(F.size("_w") < size))]
    if not short:
        return found
    kind = passages.schema[item].dataType
    hits = F.array(*(F.when(F.contains(text, F.lit(x)), F.lit(i).cast(kind)) for i, x in short))
    return found.unionByName(docs.select(key, F.explode(F.filter(hits, lambda h: h.isNotNull())).alias(item)))
