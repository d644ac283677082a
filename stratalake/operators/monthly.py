"""Monthly series side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.constants import INDICATOR_CODES, MONTHS, USD_PHP
from stratalake.functions.temporal import date_from_parts, month_key

CHART_CODES = (*INDICATOR_CODES.values(), USD_PHP)


def _last_value(code: str) -> Column:
    """Value at the latest period of a code. All buffers are fixed width, so it hash-aggregates."""
    hit = F.col("code") == code
    return F.max_by("value", F.when(hit, F.col("period"))).alias(code)


def pivot_codes(
    df: DataFrame, month: str, code: str, value: str, period: str, codes: Sequence[str]
) -> DataFrame:
    """One row per month, one column per code, the latest period of the month wins."""
    long = df.select(
        F.col(month).alias("month"),
        F.col(code).alias("code"),
        F.col(value).alias("value"),
        F.col(period).alias("period"),
    )
    return long.groupBy("month").agg(*[_last_value(c) for c in codes])


def _long(df: DataFrame, code: Column, value: str) -> DataFrame:
    return df.select(
        month_key(F.col("period")).alias("month"), code.alias("code"), F.col(value).alias("value"), "period"
    )


def monthly_trend(macro: DataFrame, fx: DataFrame) -> DataFrame:
    """Chart rows ``period, CPI_ALL, CPI_YOY, USD/PHP``: union and one aggregation by month."""
    both = _long(macro, F.col("indicator_code"), "value").unionByName(
        _long(fx, F.lit(USD_PHP), "rate")
    )
    points = both.groupBy("month").agg(*[_last_value(c) for c in CHART_CODES])
    return points.withColumnRenamed("month", "period").orderBy("period")


def monthly_trend_outer(macro: DataFrame, fx: DataFrame) -> DataFrame:
    """The same rows by a full outer join of the two monthly reductions."""
    macro_points = pivot_codes(
        _long(macro, F.col("indicator_code"), "value"),
        "month", "code", "value", "period", list(INDICATOR_CODES.values()),
    )
    fx_points = pivot_codes(
        _long(fx, F.lit(USD_PHP), "rate"), "month", "code", "value", "period", [USD_PHP]
    )
    merged = macro_points.join(fx_points, "month", "full_outer")
    return merged.withColumnRenamed("month", "period").orderBy("period")


def unpivot_months(wide: DataFrame, year: str, months: Sequence[str] = MONTHS) -> DataFrame:
    """Year rows with twelve month columns to ``rate_date, rate``; empty months are left out."""
    ids = [c for c in wide.columns if c not in months]
    long = wide.unpivot(ids, list(months), "_month", "rate").filter(F.col("rate").isNotNull())
    number = F.array_position(F.array(*[F.lit(m) for m in months]), F.col("_month")).cast("int")
    others = [c for c in ids if c != year]
    return long.select(*others, date_from_parts(F.col(year), number).alias("rate_date"), "rate")


def pivot_months(
    df: DataFrame, keys: Sequence[str], day: Column, value: Column, months: Sequence[str] = MONTHS
) -> DataFrame:
    """Largest value per key and calendar month, one column per month."""
    cells = [F.max(F.when(F.month(day) == i + 1, value)).alias(m) for i, m in enumerate(months)]
    return df.groupBy(*keys).agg(*cells)
