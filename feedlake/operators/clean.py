"""Clean raw feed rows (dates, signs, placeholders, integer columns)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from feedlake import config as C
from feedlake.functions import (
    clean_price,
    clean_sqft,
    negative_to_null_int,
    normalise_date,
)
from feedlake.functions.dates import normalise_date_columns

DATE_RULE_COLUMNS = ("feed_date", "sold_let_date")


def cleaning_rules(sqft_threshold: float = C.SQFT_PLACEHOLDER_THRESHOLD) -> dict[str, callable]:
    """Column -> rule. Columns not listed pass through unchanged
    (borough, tenure, epc_rating, coordinates and the rest, by design)."""
    return {
        "feed_date": normalise_date,
        "sold_let_date": normalise_date,
        "sqft": lambda c: clean_sqft(c, sqft_threshold),
        "price": clean_price,
        "bedrooms": negative_to_null_int,
        "bathrooms": negative_to_null_int,
    }


def clean(df: DataFrame, sqft_threshold: float = C.SQFT_PLACEHOLDER_THRESHOLD) -> DataFrame:
    """Apply the cleaning rules to the columns present, in one projection.

    Result types: dates stay text (``yyyy-MM-dd``), ``sqft``/``price`` double,
    ``bedrooms``/``bathrooms`` int. A column missing from the input is left
    missing (a union over sources fills it with nulls).
    """
    rules = cleaning_rules(sqft_threshold)
    updates: dict[str, Column] = {
        name: rule(df[name]) for name, rule in rules.items()
        if name in df.columns and name not in DATE_RULE_COLUMNS
    }
    # Dates go through the staged form of the same rule (each step once).
    return normalise_date_columns(df.withColumns(updates), DATE_RULE_COLUMNS)
