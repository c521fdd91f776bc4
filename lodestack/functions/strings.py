"""String, array, map, JSON and date functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(name: Column) -> Column:
    """Hyphens become blanks and each part starts with a capital (FN-S1)."""
    return F.initcap(F.replace(name, F.lit("-"), F.lit(" ")))


def fill(template: str | Column, **values: Column) -> Column:
    """``{{NAME}}`` placeholders replaced one after another (FN-S2, FN-S3)."""
    out = F.lit(template) if isinstance(template, str) else template
    for k, v in values.items():
        out = F.replace(out, F.lit("{{" + k + "}}"), F.coalesce(v.cast("string"), F.lit("")))
    return out


def strip_unicode(x: Column) -> Column:
    """Without Unicode white space at both ends (FN-S4); trim() would take blanks only."""
    return F.regexp_replace(x, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def chained_edits(x: Column, edits: list[tuple[str, str]]) -> Column:
    """Pattern and replacement pairs, in order (FN-S5)."""
    for pattern, replacement in edits:
        x = F.regexp_replace(x, pattern, replacement)
    return x


def matches_any_case(x: Column, pattern: str) -> Column:
    """Case-insensitive regular expression, Unicode-aware (FN-S6)."""
    return x.rlike(f"(?iu){pattern}")


def full_lines(x: Column) -> Column:
    """Lines that aren't empty after trimming (FN-S7)."""
    return F.filter(F.transform(F.split(x, "\\r?\\n"), lambda line: F.trim(line)), lambda line: line != "")


def int_or(x: Column, default: int, prefix: bool = True) -> Column:
    """The integer at the start of a text, or the default (FN-S8); prefix=False asks for nothing else in it."""
    found = F.regexp_extract(x, r"^\s*([+-]?\d{1,18})" + ("" if prefix else r"\s*\z"), 1)
    return F.coalesce(F.nullif(found, F.lit("")).try_cast("long"), F.lit(default))


def head(x: Column, n: int = 100) -> Column:
    """The first n code points (SRC-15, FN-S10)."""
    return F.substring(x, 1, n)


def major_version(x: Column) -> Column:
    """22 of v22.1 (FN-S11); null if there is none."""
    return F.nullif(F.regexp_extract(x, r"^v?(\d{1,9})", 1), F.lit("")).try_cast("int")


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://([^/?#]+)", 1)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://[^/?#]+([^?#]*)", 1)


def query_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def query_map(url: Column) -> Column:
    """The URL's parameters as a map; the stored URL itself is never rewritten (FN-S12, FN-S13)."""
    pairs = F.filter(F.split(query_of(url), "&"), lambda p: p != "")
    entries = F.transform(pairs, lambda p: F.struct(F.element_at(F.split(p, "=", 2), 1).alias("key"), F.coalesce(F.get(F.split(p, "=", 2), F.lit(1)), F.lit("")).alias("value")))
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]))


def safe_filename(title: Column, platform_id: Column) -> Column:
    """A file name from title and id: runs of anything but letters, digits, dot and hyphen become one underscore (FN-S14)."""
    return F.concat_ws("__", F.regexp_replace(F.regexp_replace(title, r"[^\p{L}\p{N}.-]+", "_"), r"^_+|_+\z", ""), platform_id)


def iso_date(x: Column) -> Column:
    return F.try_to_timestamp(x, F.lit("yyyy-MM-dd")).cast("date")


def session_stamp(x: Column) -> Column:
    """The time in a folder's suffix YYYYMMDD-HHMMSS, or null (FN-D1)."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(x, r"(\d{8}-\d{6})\z", 1), F.lit("")), F.lit("yyyyMMdd-HHmmss"))


def lookup(mapping: dict[str, str] | Column, key: Column, default: str | None = None) -> Column:
    """A map's value or the default (FN-A2)."""
    if isinstance(mapping, dict):
        mapping = F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv))
    return F.coalesce(F.try_element_at(mapping, key), F.lit(default))


def key_difference(keys: Column, allowed: list[str]) -> Column:
    """Keys beyond the allowed ones, sorted and joined (FIL-1, SET-1, SORT-8, FN-A1)."""
    return F.array_join(F.array_sort(F.array_except(keys, F.array(*map(F.lit, allowed)))), ", ")


def value_then_error(value: Column, error: Column, raw: Column) -> Column:
    """What an evaluation gives: its value, else its error, else the raw result (SRC-14, FN-J2)."""
    return F.coalesce(value, error, raw)
