"""Text predicates and case rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_null_or_empty(col: Column | str) -> Column:
    """Null or the empty string (never null itself)."""
    c = _c(col)
    return c.isNull() | (F.coalesce(c.cast("string"), F.lit("")) == "")


def is_present(col: Column | str) -> Column:
    """Neither null nor the empty string."""
    return ~is_null_or_empty(col)


def capitalise_words(col: Column | str) -> Column:
    """upper-case the first letter of each blank-separated word, lower the rest.

    ``Semi-Detached`` -> ``Semi-detached``: only the space starts a word.
    """
    return F.initcap(_c(col))
