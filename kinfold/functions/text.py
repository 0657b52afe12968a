"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains(text: Column, needle: str) -> Column:
    """Case-sensitive containment; false on a null text."""
    return text.isNotNull() & text.contains(needle)


def tokens(text: Column) -> Column:
    """Lower-case, split at punctuation and blanks, no empty tokens."""
    return F.array_remove(F.split(F.lower(text), r"[\p{P} ]"), "")


def is_blank(text: Column) -> Column:
    """True for a text of nothing but white space, and for a null."""
    return F.coalesce(~text.rlike(r"[^\s\p{Z}]"), F.lit(True))
