"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch is the sorted array of the k smallest distinct 48-bit hashes of a
text's shingles (five words, lower-cased; fewer words: the whole sequence).
Sketches of parts merge into the sketch of the whole, and two sketches estimate
resemblance, containment and the number of distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import docs_of

#: Hashes kept; the standard error of a resemblance r is sqrt(r * (1 - r) / K).
K = 128
_BITS = 48
#: Rows of neighbouring doc_ids handled together, about.
RANGE_ROWS = 128
#: Ranges of about as many rows that doc_ids are first cut into at most, and doc_ids sampled for each bound.
MOST_RANGES, SAMPLE_IDS = 4096, 20
_STEP, _WIDE = 64, 1 << 32


def with_sketch(df: DataFrame, text: str, to: str, size: int = 5, k: int = K) -> DataFrame:
    """``df`` with the column ``to``, the sketch of the column ``text``; null, empty and blank texts have an empty sketch."""
    words, hashes = f"_{to}_words", f"_{to}_hashes"
    df = df.withColumn(words, F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+", -1), ""))
    df = df.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    h, mask = F.col(hashes), F.lit((1 << _BITS) - 1)
    many = F.transform(F.sequence(F.lit(1), F.size(h) - size + 1), lambda i: F.xxhash64(*(F.element_at(h, i + j) for j in range(size))).bitwiseAND(mask))
    one = F.array(F.xxhash64(h).bitwiseAND(mask))
    all_of = F.when(F.size(h) >= size, many).when(F.size(h) > 0, one).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(to, F.slice(F.sort_array(F.array_distinct(all_of)), 1, k)).drop(words, hashes)


def merged(a: F.Column, b: F.Column, k: int = K) -> F.Column:
    """The sketch of the union of two shingle sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: F.Column, b: F.Column, k: int = K) -> F.Column:
    """Estimate of intersection / union: the share of the union's sketch that both have.  Two empty sets are alike: 1."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.greatest(F.size(union), F.lit(1)))


def distinct_shingles(a: F.Column, k: int = K) -> F.Column:
    """Estimate of the number of distinct shingles; exact below k."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * float(1 << _BITS) / (F.element_at(a, -1) + 1))


def containment(a: F.Column, b: F.Column, k: int = K) -> F.Column:
    """Estimate of the share of a's shingles that b has; 1 for an empty a."""
    both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / F.greatest(distinct_shingles(a, k), F.lit(1.0))))


def as_text(sketch: F.Column) -> F.Column:
    """The sketch as base64 of its hashes, six bytes each."""
    return F.base64(F.unhex(F.array_join(F.transform(sketch, lambda x: F.lpad(F.hex(x), 12, "0")), "")))


def _bounds(docs: DataFrame, n: int) -> list[int]:
    """Ascending doc_ids that cut the rows into ranges of about equal size, from a sample; a doc_id with more rows than a range has one to itself."""
    ranges = int(max(1, min(MOST_RANGES, n // RANGE_ROWS)))
    known = docs.where("doc_id IS NOT NULL").select("doc_id")
    share = SAMPLE_IDS * ranges / max(1, n)
    ids = sorted((known if share >= 1 else known.sample(share, seed=11)).toArrow()["doc_id"].to_pylist())  # SAMPLE_IDS * MOST_RANGES numbers, about
    cuts = [ids[len(ids) * k // ranges] for k in range(1, ranges)] if ids else []
    often = {x for x, y in zip(cuts, cuts[1:], strict=False) if x == y}
    return sorted({*cuts, *(x + 1 for x in often if x < (1 << 63) - 1)})


def _place(x: F.Column, bounds: list[int]) -> F.Column:
    """How many of the bounds are at most x, in two looks at some sixty bounds each."""
    if not bounds:
        return F.lit(0)
    up_to = lambda some: F.size(F.filter(some, lambda b: b <= x))
    coarse = up_to(F.array(*map(F.lit, bounds[::_STEP])))
    fine = up_to(F.slice(F.array(*map(F.lit, bounds)), F.greatest(_STEP * (coarse - 1) + 1, F.lit(1)), F.lit(_STEP)))
    return F.when(coarse == 0, F.lit(0)).otherwise(_STEP * (coarse - 1) + fine)


def _turn(text: F.Column) -> F.Column:
    """A number from 0 to 2 ** 63 - 1 that orders the rows of one doc_id."""
    return F.shiftrightunsigned(F.xxhash64(text), 1)


def with_ranges(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``range``, a number that rises with doc_id (lowest: null), for about RANGE_ROWS rows each; and of each range that has rows, ``up``: the one before it in descending order, the lowest for the highest.

    Ranges of one doc_id are cut by the hash of the text instead.  To the driver
    come a sample of ids and two numbers for each of the first cuts.
    """
    n = docs.count()
    bounds = _bounds(docs, n)
    first = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(_place(F.col("doc_id"), bounds)).cast("long")
    counts = {r["r"]: r["n"] for r in docs.groupBy(first.alias("r")).agg(F.count("*").alias("n")).collect()}
    lows, highs = [-(1 << 63), *bounds], [*bounds, (1 << 63) - 1]
    cuts = {r: 1 + k // RANGE_ROWS for r, k in counts.items()}
    if max(counts.values(), default=0) < 2 * RANGE_ROWS:
        ranged = docs.withColumn("range", first * _WIDE)
    else:
        alone = [k for k in range(len(lows)) if highs[k] - lows[k] == 1] + [-1]
        own = {r: c for r, c in cuts.items() if r in alone and c > 1}
        if ends := docs.agg(F.min("doc_id"), F.max("doc_id")).first():
            lows[0], highs[-1] = ends[0] if ends[0] is not None else 0, (ends[1] if ends[1] is not None else 0) + 1
        of = lambda values: F.element_at(F.array(*(F.lit(v) for v in values)), (F.col("_r") + 1).cast("int"))
        some = range(len(lows))
        inside = (F.col("doc_id").cast("double") - of([float(x) for x in lows])) / of([float(max(1, highs[k] - lows[k])) for k in some])
        mine = of([1 if k in own else cuts.get(k, 1) for k in some])
        sub = F.when(F.col("_r") >= 0, F.greatest(F.lit(0), F.least(F.floor(inside * mine), mine - 1))).otherwise(F.lit(0))
        for r, c in own.items():  # each has at least a range's share of all rows
            by_text = (c - 1) - F.least(F.floor(_turn(F.col("text")) / float(1 << 63) * c), F.lit(c - 1))
            sub = F.when(F.col("_r") == r, by_text).otherwise(sub)
        ranged = docs.withColumn("_r", first).withColumn("range", F.col("_r") * _WIDE + sub.cast("long")).drop("_r")
    group = F.floor(F.col("range") / _WIDE).cast("long")
    lowest = {r["r"]: r["low"] for r in ranged.groupBy(group.alias("r")).agg(F.min("range").alias("low")).collect()}
    order = sorted(lowest)
    before = {r: lowest[order[(i + 1) % len(order)]] for i, r in enumerate(order)}  # of the first range of each group
    last = F.element_at(F.map_from_arrays(F.array(*(F.lit(r).cast("long") for r in order)), F.array(*(F.lit(before[r]).cast("long") for r in order))), group) if order else F.lit(0).cast("long")
    each = ranged.select("range").distinct()
    return ranged, each.withColumn("up", F.coalesce(F.lag("range").over(Window.partitionBy(group).orderBy(F.desc("range"))), last))


def fingerprint_edits(docs: DataFrame, k: int = K) -> DataFrame:
    """Each row's sketch, that of its edited text, and that of the next row.

    The next row is the one before in ascending doc_id, after the smallest the
    largest; rows of one doc_id are ordered by their text's hash, a null doc_id
    counts as smallest.  The edited text has the last floor(n / 2) code points
    replaced by the first as many of the next text.  Null texts count as empty.
    Columns: doc_id, n_chars, edited, sketch, edited_sketch, next_sketch.  A
    single row is its own next.  An empty table gives no row.  Rows that agree
    in doc_id and text stay in one range, however many they are.
    """
    docs = docs_of(docs).withColumn("text", F.coalesce("text", F.lit("")))
    docs, ranges = with_ranges(docs)
    order = [F.desc_nulls_last("doc_id"), _turn(F.col("text")), F.col("text")]
    inside = Window.partitionBy("range").orderBy(*order)
    dealt = docs.repartition("range")  # moved once: both branches read this exchange
    # Where a range ends, the next row is the head of the range that has this one as ``up``.
    heads = dealt.withColumn("place", F.row_number().over(inside)).where("place = 1").select("range", F.col("text").alias("head")).join(ranges, "range")
    heads = with_sketch(heads.select(F.col("up").alias("range"), "head"), "head", "head_sketch", k=k)

    mine = with_sketch(dealt, "text", "sketch", k=k)
    mine = mine.withColumns({"next": F.lead("text").over(inside), "next_sketch": F.lead("sketch").over(inside)}).join(heads, "range", "left")
    mine = mine.withColumns({"next": F.coalesce("next", "head"), "next_sketch": F.coalesce("next_sketch", "head_sketch"), "n_chars": F.char_length("text").cast("long")})
    moved = F.floor(F.col("n_chars") / 2).cast("int")
    mine = mine.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - moved).cast("int")), F.substring(F.col("next"), F.lit(1), moved)))
    mine = mine.select("doc_id", "n_chars", "edited", "sketch", "next_sketch")
    return with_sketch(mine, "edited", "edited_sketch", k=k)
