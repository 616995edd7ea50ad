"""Native column functions: dates, numbers, text."""

from feedlake.functions.dates import (
    date_format_bucket,
    date_format_label,
    normalise_date,
    strip,
)
from feedlake.functions.numbers import (
    clean_price,
    clean_sqft,
    is_negative,
    is_negative_int,
    is_not_numeric,
    is_zero,
    negative_to_null_int,
    parse_double,
    parse_int,
    price_per_sqft,
)
from feedlake.functions.text import capitalise_words, is_null_or_empty, is_present

__all__ = [
    "capitalise_words", "clean_price", "clean_sqft", "date_format_bucket",
    "date_format_label", "is_negative", "is_negative_int", "is_not_numeric",
    "is_null_or_empty", "is_present", "is_zero", "negative_to_null_int",
    "normalise_date", "parse_double", "parse_int", "price_per_sqft",
    "strip",
]
