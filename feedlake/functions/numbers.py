"""Number parsing and the cleaning rules for numeric columns.

Raw feed columns are text. The rules were written for a Spark with ANSI mode
off, where a bad text casts to null and a string compared with an integer is
cast to int with truncation. These helpers give those meanings with ANSI mode
on or off: ``try_cast`` instead of ``cast``, and an explicit integer parse.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake import config as C

# A plain decimal number text: optional sign, digits with an optional
# fraction (or a bare fraction), surrounding blanks allowed. No exponent.
_DECIMAL_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_double(col: Column | str) -> Column:
    """Text -> double; unparseable text -> null (``NaN``/``Infinity`` kept)."""
    return _c(col).try_cast("double")


def parse_int(col: Column | str) -> Column:
    """Text -> int the way a non-ANSI cast does it.

    ``'2.5'`` -> 2, ``'-0.5'`` -> 0, ``' 3 '`` -> 3, ``'.5'`` -> 0; exponents,
    ``NaN``, out-of-range values and any other text -> null. A bare
    ``try_cast('int')`` would wrongly give null for ``'2.5'``.
    """
    c = _c(col).cast("string")
    return F.when(c.rlike(_DECIMAL_TEXT), c.try_cast("double").try_cast("int"))


def is_negative_int(col: Column | str) -> Column:
    """``col < 0`` with the integer meaning of a raw text column."""
    return F.coalesce(parse_int(col) < 0, F.lit(False))


def is_negative(col: Column | str) -> Column:
    """The double value is below zero."""
    return F.coalesce(parse_double(col) < 0, F.lit(False))


def is_zero(col: Column | str) -> Column:
    """P5: the double value equals zero."""
    return F.coalesce(parse_double(col) == 0, F.lit(False))


def is_not_numeric(col: Column | str) -> Column:
    """Blank or unparseable as a double."""
    return parse_double(col).isNull()


def clean_sqft(col: Column | str, threshold: float = C.SQFT_PLACEHOLDER_THRESHOLD) -> Column:
    """placeholder (>= threshold, NaN included) -> null, else absolute value.

    The placeholder test comes first, so ``-99999`` becomes 99999 and stays.
    """
    d = parse_double(col)
    return F.when(d >= threshold, F.lit(None).cast("double")).otherwise(F.abs(d))


def clean_price(col: Column | str) -> Column:
    """absolute value of the double."""
    return F.abs(parse_double(col))


def negative_to_null_int(col: Column | str) -> Column:
    """integer parse, negatives -> null (the text test runs once)."""
    c = _c(col).cast("string")
    n = c.try_cast("double").try_cast("int")
    return F.when(c.rlike(_DECIMAL_TEXT), F.when(n >= 0, n))


def price_per_sqft(price: Column | str, sqft: Column | str) -> Column:
    """``round(price / sqft, 2)`` when sqft is known and positive, else null."""
    p, s = _c(price), _c(sqft)
    return F.when(s.isNotNull() & (s > 0), F.round(p / s, 2))


_EXACT_LIMIT = 128.0          # values checked exactly: 2**-10 <= x < 128
_TINY = 2.0 ** -10            # below this, 0 at up to 2 decimals


def round_half_even_exact(col: Column | str, ndigits: int = 1) -> Column:
    """Python's ``round(x, ndigits)`` for doubles ``0 <= x < 128``.

    Python rounds the exact binary value to the nearest ``ndigits`` decimal,
    ties to even; Spark's ``round`` goes half up on the shortest decimal text
    (``round(0.35, 1)`` is 0.3 in Python, 0.4 in Spark). Percentages and
    scores are checked exactly in 64-bit integers: with ``K = 52 -
    floor(log2 x)`` the product ``X = x * 2**K`` is the integer mantissa,
    ``k = floor(10**n * x)`` is ``(10**n * X) >> K``, and ``x`` against the
    midpoint ``(2k+1) / (2 * 10**n)`` is ``2 * 10**n * X`` against
    ``(2k+1) << K`` (all below 2**62). Outside the range: ``bround``.
    """
    if ndigits not in (0, 1, 2):
        raise ValueError("ndigits must be 0, 1 or 2")
    x = _c(col).cast("double")
    scale = 10 ** ndigits
    k0 = F.lit(52) - F.floor(F.log2(x)).cast("int")
    x0 = x * F.pow(F.lit(2.0), k0)
    shift = (F.when(x0 >= float(2 ** 53), k0 - 1)
              .when(x0 < float(2 ** 52), k0 + 1)
              .otherwise(k0)).cast("int")
    mant = (x * F.pow(F.lit(2.0), shift)).cast("long")
    k = F.call_function("shiftright", mant * scale, shift)
    unit = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
    cmp = mant * (2 * scale) - (k * 2 + 1) * unit
    up = F.when(cmp > 0, True).when(cmp < 0, False).otherwise(k % 2 == 1)
    exact = F.when(up, k + 1).otherwise(k).cast("double") / scale
    in_range = (x >= _TINY) & (x < _EXACT_LIMIT)
    return (F.when(in_range, exact)
             .when((x >= 0) & (x < _TINY), F.lit(0.0))
             .otherwise(F.bround(x, ndigits)))
