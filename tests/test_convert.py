import datetime as dt

import pytest
from pyspark.sql import functions as F

from ratemill.functions import convert

APRIL = dt.date(2026, 4, 1)

DATES = {
    "1042026": APRIL,
    "01042026": APRIL,
    " 01042026 ": APRIL,
    " 1042026\t": APRIL,
    "31032027": dt.date(2027, 3, 31),
    "2026-04-01": APRIL,
    "04/01/2026": APRIL,
    "4/1/2026": APRIL,
    "4/01/2026": APRIL,
    "01-Apr-2026": APRIL,
    "01-APR-2026": APRIL,
    "2026-04-01T23:59:59": APRIL,
    "2026-04-01 10:00:00.123Z": APRIL,
    "2026-04-01 23:59": APRIL,
    "2026-04-01T23:59:59+05:30": APRIL,
    "2026-4-1": APRIL,
    "2026/04/01": APRIL,
    "2026/4/1 7:05": APRIL,
    "2026/04/01 07:05:00-03:00": APRIL,
    "1-Apr-2026": APRIL,
    "11-Oct-2026 0:00": dt.date(2026, 10, 11),
    "4/1/2026 0:00": APRIL,
    "04/01/2026 13:30:15": APRIL,
    "4/1/2026 2:30 PM": APRIL,
    "4/1/2026 02:30:15 am": APRIL,
    "4/1/2026 12:00AM": APRIL,
    "4/1/2026 2 PM": APRIL,
    "4/1/2026 14:30 PM": APRIL,
    "2026-04-01 11:59:59 PM": APRIL,
    "1-Apr-2026 9:05 Pm": APRIL,
    "4/1/2026 13:30 AM": None,
    "4/1/2026 24:30 PM": None,
    "4/1/2026 2:60 PM": None,
    "4/1/2026 2:30 XM": None,
    "4/1/2026 PM": None,
    "01042026 2:30 PM": None,
    "2026-04-01 99:99": None,
    "2026-04-01T25:00:00": None,
    "2026-04-01T10:60": None,
    "2026-04-01T10:00:60": None,
    "2026-04-01T10:00:00+99:99": None,
    "2026-04-01T10:00:00+14:30": None,
    "2026-04/01": None,
    "4/1/2026 24:00": None,
    "1-Apr-2026 9:99": None,
    "2026-2-30": None,
    "29022024": dt.date(2024, 2, 29),
    "31022026": None,
    "29022026": None,
    "20260401": None,
    "00000000": None,
    "01010000": None,
    "13/01/2026": None,
    "2026-13-01": None,
    "2026": None,
    "abc": None,
    "abcdefg": None,
    "  ": None,
    None: None,
}

# text: safe_int, safe_double, strict_int, strict_decimal
NUMBERS = {
    " 12 ": (12, 12.0, 12, 12.0),
    "+5": (5, 5.0, 5, 5.0),
    "-5": (-5, -5.0, -5, -5.0),
    "1,234": (0, 1234.0, None, 1234.0),
    "1,234.50": (0, 1234.5, None, 1234.5),
    "1.5": (0, 1.5, None, 1.5),
    ".5": (0, 0.5, None, 0.5),
    "5.": (0, 5.0, None, 5.0),
    "1e3": (0, 1000.0, None, None),
    "1E-2": (0, 0.01, None, None),
    "1e400": (0, 0.0, None, None),
    "4-": (0, 0.0, None, -4.0),
    " 1,000.5- ": (0, 0.0, None, -1000.5),
    "+4-": (0, 0.0, None, None),
    "1d": (0, 0.0, None, None),
    "1f": (0, 0.0, None, None),
    "0x1p3": (0, 0.0, None, None),
    "NaN": (0, 0.0, None, None),
    "Infinity": (0, 0.0, None, None),
    ",5": (0, 0.0, None, None),
    "1 2": (0, 0.0, None, None),
    "99999999999": (0, 99999999999.0, None, 99999999999.0),
    "79228162514264337593543950335": (0, 7.922816251426434e28, None, 7.922816251426434e28),
    "99228162514264337593543950335": (0, 9.922816251426434e28, None, None),
    "2147483647": (2147483647, 2147483647.0, 2147483647, 2147483647.0),
    "2147483648": (0, 2147483648.0, None, 2147483648.0),
    "": (0, 0.0, None, None),
    None: (0, 0.0, None, None),
}


def apply(spark, texts, *columns):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return {r[0]: tuple(r)[1:] for r in df.select("t", *[c(F.col("t")) for c in columns]).collect()}


def test_dates(spark):
    got = apply(spark, DATES, convert.parse_feed_date)
    assert {t: v[0] for t, v in got.items()} == DATES


def test_numbers(spark):
    got = apply(
        spark,
        NUMBERS,
        convert.safe_int,
        convert.safe_double,
        convert.strict_int,
        convert.strict_decimal,
    )
    assert got == NUMBERS


@pytest.mark.parametrize(
    "text, code", [("0350", "350"), (" 7 ", "7"), ("+12", "12"), ("A1", None), (None, None)]
)
def test_normalize_code(spark, text, code):
    assert apply(spark, [text], convert.normalize_code) == {text: (code,)}


def test_safe_string(spark):
    assert apply(spark, [None, "", "x"], convert.safe_string) == {None: ("",), "": ("",), "x": ("x",)}
