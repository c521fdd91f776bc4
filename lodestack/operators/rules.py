"""Ordered rules as data: the first that fails gives the message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[Column, Column | str]


def first_failure(rules: list[Rule], ok: str = "ok") -> Column:
    """The message of the first rule whose condition is true, else ``ok`` (FIL-9).  A null condition is no failure."""
    text = lambda m: F.lit(m) if isinstance(m, str) else m
    return F.coalesce(*(F.when(cond, text(message)) for cond, message in rules), F.lit(ok))


def count_true(*flags: Column) -> Column:
    """How many conditions hold; null counts as false (AGG-12, SET-4)."""
    total = F.lit(0)
    for f in flags:
        total = total + F.coalesce(f, F.lit(False)).cast("int")
    return total
