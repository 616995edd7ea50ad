"""Date text functions (F1 normalise, F2 classify, F8 strip), all native.

Every function maps a string ``Column`` to a ``Column``: no Python UDF, so the
expressions stay inside whole-stage codegen and filters stay pushable.

Rules of the date normaliser:

1. null -> null.
2. Strip surrounding whitespace (Python's notion of whitespace); ``''`` or the
   text ``None`` -> null.
3. A 10-character text whose 5th character is ``-`` is returned unchanged,
   with no validity check (``2025-99-99`` passes through).
4. Otherwise the first format that matches *and* is a real calendar date wins:
   ``Y-m-d``, ``d/m/Y``, ``Y/m/d``, ``d Mon Y``, ``d-m-Y``. Day and month
   take one or two digits (a day may also be a blank followed by one digit),
   the year exactly four (not ``0000``), month names are English
   three-letter abbreviations in any case, and the blanks around a month name
   may be any whitespace run.
5. Anything else -> null. Slashes are day first, so ``12/31/2025`` is null.

The result is ``yyyy-MM-dd`` text.

How it runs per value: one regular expression rewrites any of the four
numeric formats to ``<tab>y-M-d`` (the formats never overlap: a four-digit
year sits either first or last), and one date parse with that exact pattern
checks the calendar. A text that did not match keeps no leading tab (it was
stripped), so it cannot parse. Month names take a second, separate rewrite
only when the numeric one gave nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import config as C

# Python's str.strip() whitespace, derived by rule rather than listed.
PY_WHITESPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())
# The same set as a Java regex character class body.
_WS_CLASS = "".join(f"\\u{ord(ch):04x}" for ch in PY_WHITESPACE)
_WS_RUN = f"[{_WS_CLASS}]+"

# Component patterns: day (optionally blank-padded), month, year 0001-9999.
_DAY = r"(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
_MONTH = r"(1[0-2]|0[1-9]|[1-9])"
_YEAR = r"((?!0000)[0-9]{4})"
_MON = "((?i:" + "|".join(C.MONTH_ABBREVIATIONS) + "))"

# The numeric formats as one alternation. Capture groups, in order:
#   Y-M-D: 1 2 3   D/M/Y: 4 5 6   Y/M/D: 7 8 9   D-M-Y: 10 11 12
_NUMERIC_RX = (f"^(?:{_YEAR}-{_MONTH}-{_DAY}|{_DAY}/{_MONTH}/{_YEAR}"
               f"|{_YEAR}/{_MONTH}/{_DAY}|{_DAY}-{_MONTH}-{_YEAR})$")
_NUMERIC_TO_YMD = "\t$1$6$7$12-$2$5$8$11-$3$4$9$10"
_MONTH_NAME_RX = f"^{_DAY}{_WS_RUN}{_MON}{_WS_RUN}{_YEAR}$"
_MONTH_NAME_TO_YMD = "\t$3-$2-$1"
_MARK = "'\t'"      # the tab as a literal in a datetime pattern


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """F8: remove leading and trailing whitespace (Python ``str.strip``)."""
    return F.btrim(_c(col), F.lit(PY_WHITESPACE))


def _numeric_ymd(s: Column) -> Column:
    """``<tab>y-M-d`` for a stripped text in a numeric format, else the text."""
    return F.regexp_replace(s, _NUMERIC_RX, _NUMERIC_TO_YMD)


def _month_name_ymd(s: Column) -> Column:
    """``<tab>y-Mon-d`` for a stripped ``d Mon Y`` text, else the text."""
    return F.regexp_replace(s, _MONTH_NAME_RX, _MONTH_NAME_TO_YMD)


def _parse_numeric(ymd: Column) -> Column:
    return F.try_to_date(F.translate(ymd, " ", ""), _MARK + "yyyy-M-d")


def _parse_month_name(ymd: Column) -> Column:
    return F.try_to_date(ymd, _MARK + "yyyy-MMM-d")


def _numeric_date(s: Column) -> Column:
    """DATE of a stripped text in one of the four numeric formats, else null."""
    return _parse_numeric(_numeric_ymd(s))


def _month_name_date(s: Column) -> Column:
    """DATE of a stripped ``d Mon Y`` text, else null."""
    return _parse_month_name(_month_name_ymd(s))


def _is_blank(s: Column) -> Column:
    return s.isNull() | (s == "")


def normalise_date(col: Column | str) -> Column:
    """normalise a date text to ``yyyy-MM-dd`` (rules in the module doc)."""
    s = strip(_c(col).cast("string"))
    parsed = F.coalesce(_numeric_date(s), _month_name_date(s)).cast("string")
    return (F.when(_is_blank(s) | (s == "None"), F.lit(None).cast("string"))
             .when((F.length(s) == 10) & (F.substring(s, 5, 1) == "-"), s)
             .otherwise(parsed))


def _numeric_label(s: Column, extended: bool) -> Column:
    """Label of a text already known to parse in a numeric format."""
    year_first = F.translate(F.substring(s, 1, 4), "0123456789", "") == ""
    sep = F.substring(s, 5, 1)
    label = (F.when(year_first & (sep == "-"), F.lit(C.LABEL_ISO))
              .when(year_first, F.lit(C.LABEL_YMD_SLASH))
              .when(F.instr(s, "/") > 0, F.lit(C.LABEL_DMY_SLASH)))
    if extended:
        label = label.otherwise(F.lit(C.LABEL_DMY_DASH))
    return label


def date_format_label(col: Column | str, extended: bool = False) -> Column:
    """label the format of a date text.

    null or blank -> ``empty``; then the first of ``YYYY-MM-DD``,
    ``DD/MM/YYYY``, ``YYYY/MM/DD``, ``DD Mon YYYY`` that parses to a real
    date (``DD-MM-YYYY`` too with ``extended``); else ``UNKNOWN (<text>)``.
    """
    s = strip(_c(col).cast("string"))
    label = F.coalesce(
        F.when(_numeric_date(s).isNotNull(), _numeric_label(s, extended)),
        F.when(_month_name_date(s).isNotNull(), F.lit(C.LABEL_DMON)),
        F.concat(F.lit(C.LABEL_UNKNOWN + " ("), s, F.lit(")")))
    return F.when(_is_blank(s), F.lit(C.LABEL_EMPTY)).otherwise(label)


def date_format_bucket(col: Column | str, extended: bool = False) -> Column:
    """F2 with every ``UNKNOWN (...)`` label folded into ``UNKNOWN``."""
    s = strip(_c(col).cast("string"))
    label = F.coalesce(
        F.when(_numeric_date(s).isNotNull(), _numeric_label(s, extended)),
        F.when(_month_name_date(s).isNotNull(), F.lit(C.LABEL_DMON)),
        F.lit(C.LABEL_UNKNOWN))
    return F.when(_is_blank(s), F.lit(C.LABEL_EMPTY)).otherwise(label)


def _stage_names(column: str) -> tuple[str, str, str]:
    return f"__{column}__s", f"__{column}__num", f"__{column}__mon"


def _with_date_stages(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add, per column, the stripped text and the two rewrites as columns.

    Kept in their own projection (the optimizer does not inline a costly
    column used more than once), so each runs once per value, the regex
    rewrites only where needed, and the date parser only sees texts the
    rewrite matched (a failed parse is costly).
    """
    stripped = {_stage_names(c)[0]: strip(F.col(c).cast("string")) for c in columns}
    df = df.withColumns(stripped)
    rewrites: dict[str, Column] = {}
    for c in columns:
        s_name, num_name, _ = _stage_names(c)
        s = F.col(s_name)
        needs_parse = ~(_is_blank(s) | (s == "None")
                        | ((F.length(s) == 10) & (F.substring(s, 5, 1) == "-")))
        rewrites[num_name] = F.when(needs_parse, _numeric_ymd(s))
    df = df.withColumns(rewrites)
    months: dict[str, Column] = {}
    for c in columns:
        s_name, num_name, mon_name = _stage_names(c)
        num = F.col(num_name)
        months[mon_name] = F.when(num.isNotNull() & ~num.startswith("\t"),
                                  _month_name_ymd(F.col(s_name)))
    return df.withColumns(months)


def normalise_date_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """F1 on several columns of ``df`` in place; same result as
    :func:`normalise_date`, with each costly step run once per value."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    staged = _with_date_stages(df, columns)
    out: dict[str, Column] = {}
    for c in columns:
        s_name, num_name, mon_name = _stage_names(c)
        s, num, mon = F.col(s_name), F.col(num_name), F.col(mon_name)
        out[c] = (F.when(_is_blank(s) | (s == "None"), F.lit(None).cast("string"))
                   .when((F.length(s) == 10) & (F.substring(s, 5, 1) == "-"), s)
                   .when(num.startswith("\t"), _parse_numeric(num).cast("string"))
                   .when(mon.startswith("\t"), _parse_month_name(mon).cast("string")))
    drop = [n for c in columns for n in _stage_names(c)]
    return staged.withColumns(out).drop(*drop)


def with_date_format_bucket(df: DataFrame, column: str, out: str,
                            extended: bool = False) -> DataFrame:
    """Add ``out`` = :func:`date_format_bucket` of ``column``, staged like
    :func:`normalise_date_columns`."""
    s_name, num_name, mon_name = _stage_names(column)
    stripped = df.withColumn(s_name, strip(F.col(column).cast("string")))
    s = F.col(s_name)
    staged = stripped.withColumn(num_name, F.when(~_is_blank(s), _numeric_ymd(s)))
    num = F.col(num_name)
    staged = staged.withColumn(mon_name, F.when(num.isNotNull() & ~num.startswith("\t"),
                                                _month_name_ymd(s)))
    mon = F.col(mon_name)
    numeric_ok = num.startswith("\t") & _parse_numeric(num).isNotNull()
    label = (F.when(_is_blank(s), F.lit(C.LABEL_EMPTY))
              .when(numeric_ok, F.coalesce(_numeric_label(s, extended), F.lit(C.LABEL_UNKNOWN)))
              .when(mon.startswith("\t") & _parse_month_name(mon).isNotNull(), F.lit(C.LABEL_DMON))
              .otherwise(F.lit(C.LABEL_UNKNOWN)))
    return staged.withColumn(out, label).drop(s_name, num_name, mon_name)
