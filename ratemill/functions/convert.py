"""Text to typed values (F1-F8). No function raises: a bad value is NULL or a default."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratemill.functions.text import strip_space

# What counts as number text.
_PAD = r"[\t-\r ]*"
_NUMBER = r"(\d[\d,]*(\.\d*)?|\.\d+)"
INTEGER_TEXT = rf"^{_PAD}[+-]?\d+{_PAD}$"
DOUBLE_TEXT = rf"^{_PAD}[+-]?{_NUMBER}([eE][+-]?\d+)?{_PAD}$"
PLAIN_TEXT = rf"^{_PAD}[+-]?{_NUMBER}{_PAD}$"
SIGN_LAST_TEXT = rf"^{_PAD}{_NUMBER}[+-]{_PAD}$"
DECIMAL_LIMIT = 79228162514264337593543950335.0

# Shapes of date text. Year 0000 is no year.
_MINUTES = r":[0-5]\d(:[0-5]\d(\.\d+)?)?"
_HALF_DAY = rf"((0?\d|1[0-2])({_MINUTES})? ?[Aa]|([01]?\d|2[0-3])({_MINUTES})? ?[Pp])[Mm]"
_TIME = rf"(([01]?\d|2[0-3]){_MINUTES}|{_HALF_DAY})"
_OFFSET = r"(Z|[+-](0\d|1[0-3]):[0-5]\d|[+-]14:00)"
DAY_FIRST = r"^\d{3,4}(?!0000)\d{4}$"
YEAR_FIRST = rf"^(?!0000)\d{{4}}([-/])\d{{1,2}}\1\d{{1,2}}([T ]{_TIME}{_OFFSET}?)?$"
MONTH_FIRST = rf"^\d{{1,2}}/\d{{1,2}}/(?!0000)\d{{4}}( {_TIME})?$"
MONTH_NAME = rf"^\d{{1,2}}-[A-Za-z]{{3}}-(?!0000)\d{{4}}( {_TIME})?$"


def parse_feed_date(col: Column) -> Column:
    """Date of a feed (F1): ddMMyyyy or dMMyyyy; year first with dashes or slashes; month first
    with slashes; d-MMM-yyyy. A time of day, also one with AM or PM, may follow all but the first
    and is cut off. Anything else, and a day or time that does not exist, is NULL."""
    return stripped_date(strip_space(col))


def stripped_date(text: Column) -> Column:
    """:func:`parse_feed_date` of text without outer white space.

    All shapes in digits are put into the one that a cast reads, which has no pattern to parse.
    """
    day = F.substring_index(F.substring_index(text, " ", 1), "T", 1)
    padded = F.lpad(text, 8, "0")
    in_month = F.substring_index(F.substring_index(day, "/", 2), "/", -1)
    digits = (
        F.when(text.rlike(DAY_FIRST), _iso(padded.substr(5, 4), padded.substr(3, 2), padded.substr(1, 2)))
        .when(text.rlike(YEAR_FIRST), F.replace(day, F.lit("/"), F.lit("-")))
        .when(text.rlike(MONTH_FIRST), _iso(F.substring_index(day, "/", -1), F.substring_index(day, "/", 1), in_month))
    )
    # The month's name may hold a T, so the day is cut off at the blank alone.
    named_day = F.substring_index(text, " ", 1)
    named = F.when(text.rlike(MONTH_NAME), F.try_to_date(F.lpad(named_day, 11, "0"), "dd-MMM-yyyy"))
    return F.coalesce(digits.try_cast("date"), named)


def _iso(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", year, month, day)


def strict_int(col: Column) -> Column:
    """Integer or NULL."""
    return F.when(col.rlike(INTEGER_TEXT), col.try_cast("int"))


def safe_int(col: Column, default: int = 0) -> Column:
    """Integer or the default."""
    return F.coalesce(strict_int(col), F.lit(default))


def _number(col: Column) -> Column:
    return F.replace(col, F.lit(","), F.lit("")).try_cast("double")


def strict_double(col: Column) -> Column:
    """Number with optional thousands commas and exponent, or NULL if not finite."""
    value = _number(col)
    return F.when(col.rlike(PLAIN_TEXT) & (F.char_length(col) < 300), value).when(
        col.rlike(DOUBLE_TEXT) & (F.abs(value) < float("inf")), value
    )


def safe_double(col: Column, default: float = 0.0) -> Column:
    """Number or the default."""
    return F.coalesce(strict_double(col), F.lit(default))


def strict_decimal(col: Column) -> Column:
    """Decimal number as double, or NULL.

    Thousands commas and one leading or trailing sign, no exponent, within the range of a
    96-bit decimal.
    """
    value = _number(col)
    moved = _number(F.regexp_replace(col, r"^\s*([\d.,]+)([+-])\s*$", "$2$1"))
    short = F.char_length(col) <= 28
    return F.when(
        col.rlike(PLAIN_TEXT) & (short | (F.abs(value) <= DECIMAL_LIMIT)), value
    ).when(col.rlike(SIGN_LAST_TEXT) & (F.abs(moved) <= DECIMAL_LIMIT), moved)


def safe_string(col: Column, default: str = "") -> Column:
    """The text, or the default for NULL (F2)."""
    return F.coalesce(col, F.lit(default))


def normalize_code(col: Column) -> Column:
    """Integer code as text without leading zeros, or NULL."""
    return strict_int(col).cast("string")
