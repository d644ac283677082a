"""Row filters. All are plain predicates, so Catalyst pushes them to the scan."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def in_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Both bounds included; NULL is out."""
    return df.filter(F.col(column).between(low, high))


def in_set(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isin(list(allowed)))


def not_after(df: DataFrame, column: str, as_of: date | Column | None = None) -> DataFrame:
    """No future dates. ``as_of`` defaults to the session's current date."""
    limit = F.current_date() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    return df.filter(F.col(column) <= limit)


def min_year(df: DataFrame, text_column: str, first_year: int) -> DataFrame:
    """Rows whose text is a year from ``first_year`` on; other text is skipped."""
    return df.filter(F.col(text_column).try_cast("int") >= first_year)


def by_value(df: DataFrame, column: str, value: str | None = None) -> DataFrame:
    """Equality filter that is absent when no value is asked for."""
    return df if value is None else df.filter(F.col(column) == value)


def split(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """Rows where the flag is true, and all others: a NULL flag counts as not true."""
    holds = F.coalesce(F.col(flag), F.lit(False))
    return df.filter(holds), df.filter(~holds)


def allowed(name: str, names: Iterable[str]) -> str:
    """Pass a known name through, refuse others."""
    known = sorted(names)
    if name not in known:
        raise LookupError(f"unknown dataset {name!r}; allowed: {known}")
    return name
