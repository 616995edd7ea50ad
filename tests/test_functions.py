"""Unit vectors for the column functions, with ANSI mode on and off."""

from __future__ import annotations

from datetime import datetime

import pytest

from feedlake.functions import (
    capitalise_words,
    clean_price,
    clean_sqft,
    date_format_label,
    is_negative_int,
    negative_to_null_int,
    normalise_date,
    parse_int,
    price_per_sqft,
    strip,
)

ISO = "2025-01-06"

NORMALISE = [
    (None, None), ("", None), (" ", None), ("None", None),
    ("2025-01-06", ISO), (" 2025-01-06 ", ISO), ("06/01/2025", ISO), ("6/1/2025", ISO),
    ("\t06/01/2025\n", ISO), ("2025/01/06", ISO), ("2025/1/6", ISO), ("06 Jan 2025", ISO),
    ("6  JAN 2025", ISO), ("06-01-2025", ISO), ("6-1-2025", ISO), ("2025-1-6", ISO),
    ("29/02/2024", "2024-02-29"),
    ("2025-99-99", "2025-99-99"), ("abcd-efghi", "abcd-efghi"),
    ("30/02/2025", None), ("29-02-2023", None), ("31 Apr 2025", None), ("13/13/2025", None),
    ("12/31/2025", None), ("006/01/2025", None), ("20250106", None), ("06 January 2025", None),
    ("06 Jan 25", None), ("2025-01-06T00:00", None),
    # a blank-padded day, as the day directive of strptime allows
    ("2025/01/ 6", ISO),
    ("29/02/1900", None), ("29/02/2000", "2000-02-29"), ("00/01/2025", None),
    ("1/1/0000", None), ("31 dec 1999", "1999-12-31"), ("31\tDec\t1999", "1999-12-31"),
]


def _collect(spark, values, *exprs):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [tuple(r) for r in df.select("v", *exprs).collect()]


def _strptime_reference(text):
    """The rule written with the standard library, for cross-checking."""
    if text is None:
        return None
    s = str(text).strip()
    if s in ("", "None"):
        return None
    if len(s) == 10 and s[4] == "-":
        return s
    for fmt in ("%Y-%m-%d", "%d/%m/%Y", "%Y/%m/%d", "%d %b %Y", "%d-%m-%Y"):
        try:
            return datetime.strptime(s, fmt).strftime("%Y-%m-%d")
        except ValueError:
            continue
    return None


def test_normalise_date_vectors(ansi_spark):
    got = dict(_collect(ansi_spark, [v for v, _ in NORMALISE], normalise_date("v").alias("n")))
    for value, want in NORMALISE:
        assert got[value] == want, value


def test_normalise_date_matches_strptime(spark):
    got = _collect(spark, [v for v, _ in NORMALISE], normalise_date("v").alias("n"))
    for value, norm in got:
        assert norm == _strptime_reference(value), value


LABELS = [
    (None, "empty"), ("", "empty"), ("  ", "empty"),
    ("2025-01-06", "YYYY-MM-DD"), ("06/01/2025", "DD/MM/YYYY"), ("2025/01/06", "YYYY/MM/DD"),
    ("06 Jan 2025", "DD Mon YYYY"), ("06-01-2025", "UNKNOWN (06-01-2025)"),
    ("2025-99-99", "UNKNOWN (2025-99-99)"), (" x ", "UNKNOWN (x)"), ("None", "UNKNOWN (None)"),
]


def test_date_format_label(ansi_spark):
    got = dict(_collect(ansi_spark, [v for v, _ in LABELS], date_format_label("v").alias("l")))
    for value, want in LABELS:
        assert got[value] == want, value


def test_date_format_label_extended(spark):
    got = dict(_collect(spark, ["06-01-2025"], date_format_label("v", extended=True).alias("l")))
    assert got["06-01-2025"] == "DD-MM-YYYY"


INTS = [("2", 2), ("2.5", 2), ("-2.5", -2), ("-0.5", 0), (" 3 ", 3), (".5", 0), ("+4", 4),
        ("5.", 5), ("", None), ("abc", None), ("1e3", None), ("NaN", None),
        ("3000000000", None), ("5d", None), ("-", None), (None, None)]


def test_parse_int(ansi_spark):
    got = dict(_collect(ansi_spark, [v for v, _ in INTS], parse_int("v").alias("i")))
    for value, want in INTS:
        assert got[value] == want, value


def test_negative_int_predicate(ansi_spark):
    got = dict(_collect(ansi_spark, ["-0.5", "-7.9", "-3000000000", "abc", None, "-1"],
                        is_negative_int("v").alias("p")))
    assert got == {"-0.5": False, "-7.9": True, "-3000000000": False, "abc": False,
                   None: False, "-1": True}


def test_negative_to_null(ansi_spark):
    got = dict(_collect(ansi_spark, ["-1", "0", "3", "x", None, "-0.5"],
                        negative_to_null_int("v").alias("n")))
    assert got == {"-1": None, "0": 0, "3": 3, "x": None, None: None, "-0.5": 0}


SQFT = [("99998", None), ("99999", None), ("NaN", None), ("99997", 99997.0), ("-200", 200.0),
        ("-99999", 99999.0), ("0", 0.0), ("", None), ("abc", None)]


def test_clean_sqft(ansi_spark):
    got = dict(_collect(ansi_spark, [v for v, _ in SQFT], clean_sqft("v").alias("s")))
    for value, want in SQFT:
        assert got[value] == want, value


def test_clean_price(ansi_spark):
    got = dict(_collect(ansi_spark, ["-5", "7.5", "", "x"], clean_price("v").alias("p")))
    assert got == {"-5": 5.0, "7.5": 7.5, "": None, "x": None}


def test_initcap(spark):
    got = dict(_collect(spark, ["Semi-Detached", "under  OFFER", "N/A", "a\tb", None],
                        capitalise_words("v").alias("c")))
    assert got == {"Semi-Detached": "Semi-detached", "under  OFFER": "Under  Offer",
                   "N/A": "N/a", "a\tb": "A\tb", None: None}


def test_price_per_sqft_rounding(spark):
    df = spark.createDataFrame([(1.005, 1.0), (2.675, 1.0), (-1.005, 1.0), (10.0, 0.0),
                                (10.0, None), (None, 2.0)], "p double, s double")
    got = [r[0] for r in df.select(price_per_sqft("p", "s")).collect()]
    assert got == [1.01, 2.68, -1.01, None, None, None]


@pytest.mark.parametrize("text,want", [(" x　", "x"), ("\x1cy\x1f", "y"), (" z ", "z")])
def test_strip_python_whitespace(spark, text, want):
    got = _collect(spark, [text], strip("v").alias("s"))
    assert got[0][1] == want == text.strip()


def test_staged_forms_match_column_forms(ansi_spark):
    from feedlake.functions import date_format_bucket
    from feedlake.functions.dates import normalise_date_columns, with_date_format_bucket

    values = [v for v, _ in NORMALISE] + [v for v, _ in LABELS] + [
        "1/12/2025", "31/1/2025", "2025/12/ 1", "7 sep 2024", "29 Feb 2023", "9999-12-31"]
    df = ansi_spark.createDataFrame([(v, v) for v in values], "v string, w string")
    staged = normalise_date_columns(df, ["w"]).withColumnRenamed("w", "staged")
    staged = with_date_format_bucket(staged, "v", "staged_label")
    got = staged.select("v", "staged", normalise_date("v").alias("direct"), "staged_label",
                        date_format_bucket("v").alias("direct_label")).collect()
    for r in got:
        assert r.staged == r.direct, r.v
        assert r.staged_label == r.direct_label, r.v
        assert r.direct == _strptime_reference(r.v), r.v


def test_round_half_even_exact_matches_python(spark):
    from feedlake.functions.numbers import round_half_even_exact

    pairs = [(n, t) for t in (1, 3, 7, 8, 16, 20, 40, 41, 97, 200, 400, 1000, 4096, 60000)
             for n in range(0, t + 1, max(1, t // 97))]
    values = sorted({n / t * 100 for n, t in pairs} | {0.25, 0.35, 12.25, 12.75, 90.5, 94.45, 99.95})
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for nd in (0, 1, 2):
        got = df.select("x", round_half_even_exact("x", nd).alias("r")).collect()
        for r in got:
            assert r.r == round(r.x, nd), (r.x, nd)


def test_round_half_even_exact_random_and_near_ties(ansi_spark):
    import math
    import random

    from feedlake.functions.numbers import round_half_even_exact

    rng = random.Random(7)
    values = [rng.uniform(0, 128) for _ in range(3000)] + [rng.uniform(0, 1) for _ in range(1000)]
    for j in range(0, 2560):
        t = (2 * j + 1) / 200
        values += [t, math.nextafter(t, 0), math.nextafter(t, 200)]
    values = [v for v in values if 0 <= v < 128]
    df = ansi_spark.createDataFrame([(v,) for v in values], "x double")
    for nd in (1, 2):
        for r in df.select("x", round_half_even_exact("x", nd).alias("r")).collect():
            assert r.r == round(r.x, nd), (r.x, nd)
