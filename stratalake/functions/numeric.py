"""Number clean-up and number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.constants import (
    CPI_INDEX_MARKER,
    CPI_INDEX_UNIT,
    CPI_RATE_UNIT,
    EM_DASH,
    MISSING_NUMBERS,
)

# Plain decimal notation only: "nan", "inf", "1.5d" and "1_000" are not published numbers.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_BLANKS = " \t\r\n\u00a0"


def parse_rate(text: Column) -> Column:
    """Published number text to double; missing-value tokens and junk become NULL."""
    cleaned = F.replace(F.btrim(text, F.lit(_BLANKS)), F.lit(","), F.lit(""))
    is_number = ~cleaned.isin(MISSING_NUMBERS) & cleaned.rlike(_NUMBER)
    return F.when(is_number, cleaned.try_cast("double"))


def unit_of(series_code: Column) -> Column:
    return F.when(series_code.contains(CPI_INDEX_MARKER), F.lit(CPI_INDEX_UNIT)).otherwise(
        F.lit(CPI_RATE_UNIT)
    )


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, 0.0 for an empty whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def fixed2(value: Column) -> Column:
    """Two decimals without grouping, a dash for NULL; halves round away from zero."""
    eighths = value * 8
    exact_half_possible = eighths == F.floor(eighths)
    rounded = F.when(exact_half_possible, F.round(value, 2)).otherwise(value)
    text = F.call_function("format_number", rounded, F.lit("0.00"))
    return F.coalesce(text, F.lit(EM_DASH))


def grouped_integer(value: Column) -> Column:
    """Thousands-grouped whole number, a dash for NULL."""
    return F.coalesce(F.format_number(value, 0), F.lit(EM_DASH))
