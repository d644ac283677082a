"""Bronze to silver: parse, cast, filter, deduplicate, classify."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.constants import (
    BSP_FX,
    BSP_POLICY,
    DIRECTIONS,
    POLICY_RATE_MAX,
    POLICY_RATE_MIN,
    PSA,
)
from stratalake.functions.temporal import iso_date, parse_period
from stratalake.layout import Lake
from stratalake.operators.change import classify_change
from stratalake.operators.columns import derive, project
from stratalake.operators.filters import drop_null, in_range, not_after
from stratalake.operators.latest import dedup
from stratalake.schemas import get_silver_schema
from stratalake.sinks import write_snapshots

# Natural keys per source.
PSA_KEY = ("series_code", "period_date")
FX_KEY = ("currency_pair", "period_date")
POLICY_KEY = ("decision_date",)

#: Among copies of a natural key the newest landing wins, then the greater batch id, then the value.
_NEWEST = ("fetched_at", "batch_id")

#: The value column of sources that drop no row for its value before they deduplicate.
_VALUES = {PSA: "value", BSP_FX: "rate"}


def _to_schema(df: DataFrame, source: str, extra: Sequence[str]) -> DataFrame:
    """Silver columns in schema order, in front of them the batch columns of a multi-batch job."""
    if not extra:
        return project(df, get_silver_schema(source))
    wanted = get_silver_schema(source)
    return df.select(*extra, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])


def _unread(day: str, text: str) -> Column:
    """Key part of a row without a readable date: its raw text, so different rows stay apart."""
    return F.when(F.col(day).isNull(), F.coalesce(text, F.lit("")))


def psa_silver(bronze: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Consumer prices. An unreadable period stays as NULL for the quality checks to reject."""
    dated = derive(bronze, {"period_date": parse_period(F.col("period"))})
    keyed = derive(dated, {"_unread": _unread("period_date", "period")})
    unique = dedup(keyed, [*by, *PSA_KEY, "_unread"], [*_NEWEST, "value"])
    parts = {"period_year": F.year("period_date"), "period_month": F.month("period_date")}
    return _to_schema(derive(unique, parts), PSA, by)


def fx_silver(bronze: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exchange rates. Cast first, then drop what has no rate. An unreadable date stays as NULL."""
    typed = derive(
        bronze,
        {"period_date": iso_date(F.col("rate_date")), "rate": F.col("rate").try_cast("double")},
    )
    keyed = derive(typed, {"_unread": _unread("period_date", "rate_date")})
    unique = dedup(drop_null(keyed, "rate"), [*by, *FX_KEY, "_unread"], [*_NEWEST, "rate"])
    return _to_schema(unique, BSP_FX, by)


def policy_silver(
    bronze: DataFrame,
    as_of: date | Column | None = None,
    series: Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """Policy decisions: filter and deduplicate, then classify, so dropped rows leave no trace.

    ``series`` names extra key columns when a table holds several rate series. A series has at
    most one row per calendar day once deduplicated, which bounds the sorted group of the lag.
    """
    groups = [*by, *series]
    typed = derive(
        bronze,
        {
            "decision_date": iso_date(F.col("decision_date")),
            "overnight_rp": F.col("overnight_rp").try_cast("double"),
            "overnight_srp": F.col("overnight_srp").try_cast("double"),
        },
    )
    plausible = in_range(typed, "overnight_rp", POLICY_RATE_MIN, POLICY_RATE_MAX)
    # A direction that came with the record has to be a known one; none at all is fine.
    known = F.col("direction").isNull() | F.col("direction").isin(DIRECTIONS)
    past = not_after(plausible.filter(known), "decision_date", as_of)
    unique = dedup(past, [*groups, *POLICY_KEY], [*_NEWEST, "overnight_rp"])
    years = [F.year("decision_date")]
    classified = classify_change(unique, groups, ["decision_date"], "overnight_rp", years)
    return _to_schema(classified, BSP_POLICY, groups)


_TRANSFORMS: dict[str, Callable[..., DataFrame]] = {
    PSA: psa_silver,
    BSP_FX: fx_silver,
    BSP_POLICY: policy_silver,
}

#: Date column and the names of its year and month partition columns.
_DATES = {
    PSA: ("period_date", "period_year", "period_month"),
    BSP_FX: ("period_date", "period_year", "period_month"),
    BSP_POLICY: ("decision_date", "decision_year", "decision_month"),
}


def greatest(bronze: DataFrame, source: str) -> DataFrame:
    """Of rows that differ in their value alone the one that :func:`transform` would keep.

    Rows of one landing share its time and batch id, so most copies of a natural key are such rows.
    A hash aggregation sends one of them per task, without sorting the others first. Rows of other
    sources, which are chosen by more than that, are all passed on.
    """
    value = _VALUES.get(source)
    if value is None:
        return bronze
    others = [c for c in bronze.columns if c != value]
    return bronze.groupBy(*others).agg(F.max(value).alias(value)).select(*bronze.columns)


def transform(bronze: DataFrame, source: str, by: Sequence[str] = (), **options) -> DataFrame:
    if source not in _TRANSFORMS:
        raise ValueError(f"unknown source {source!r}")
    return _TRANSFORMS[source](bronze, by=by, **options)


def write_silver(lake: Lake, silver: DataFrame, source: str, days: Sequence[date]) -> str:
    """Write snapshots (rows carry text columns ``year``, ``month``), ascending by date."""
    day, year, month = _DATES[source]
    parts = {year: F.year(day), month: F.month(day)}
    path = lake.silver(source)
    write_snapshots(derive(silver, parts), path, days, [year, month], [day])
    return path
