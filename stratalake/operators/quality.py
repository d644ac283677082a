"""Contract checks: flags, split, one-pass statistics and the failure-rate gate.

A check is one Boolean expression. A row check speaks about a single row. A table check is an
aggregate over the whole table and holds for all of its rows or none. So every figure the gate
needs comes out of a single aggregation, and annotating rows adds projections only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.digest import all_true
from stratalake.functions.numeric import ratio
from stratalake.operators.columns import missing_columns
from stratalake.operators.filters import split


@dataclass(frozen=True)
class CheckConfig:
    """One configured check of a contract."""

    check: str
    columns: Sequence[str] | None = None
    column: str | None = None
    value: float | None = None
    min: float | None = None
    max: float | None = None


class HardQualityFailure(Exception):
    """The share of rejected rows is above the contract's threshold."""

    def __init__(self, run_id: str, failure_rate: float) -> None:
        super().__init__(f"run {run_id}: failure rate {failure_rate:.4f} is above the threshold")
        self.run_id = run_id
        self.failure_rate = failure_rate


# ---------------------------------------------------------------- check expressions


def _no_nulls(df: DataFrame, cfg: CheckConfig) -> Column:
    if not cfg.columns:
        raise ValueError("no_nulls needs a list of columns")
    return all_true([F.col(c).isNotNull() for c in cfg.columns])


def _value_range(df: DataFrame, cfg: CheckConfig) -> Column:
    if cfg.column is None:
        raise ValueError("value_range needs a column")
    bounds = []
    if cfg.min is not None:
        bounds.append(F.col(cfg.column) >= cfg.min)
    if cfg.max is not None:
        bounds.append(F.col(cfg.column) <= cfg.max)
    # A NULL is in no range: it counts as failed, so no row falls between clean and rejected.
    return F.coalesce(all_true(bounds), F.lit(False))


def _schema(df: DataFrame, cfg: CheckConfig) -> Column:
    return F.lit(not missing_columns(cfg.columns or [], df.columns))


def _row_count_min(df: DataFrame, cfg: CheckConfig) -> Column:
    if cfg.value is None:
        raise ValueError("row_count_min needs a value")
    return F.count(F.lit(1)) >= cfg.value


Expression = Callable[[DataFrame, CheckConfig], Column]
_ROW_CHECKS: dict[str, Expression] = {
    "no_nulls": _no_nulls,
    "value_range": _value_range,
    "schema": _schema,
}
_TABLE_CHECKS: dict[str, Expression] = {"row_count_min": _row_count_min}


def register_check(name: str, expression: Expression, *, table_level: bool = False) -> None:
    """Add a check. ``expression(df, cfg)`` returns a Boolean column, aggregated if table level."""
    _ROW_CHECKS.pop(name, None)
    _TABLE_CHECKS.pop(name, None)
    (_TABLE_CHECKS if table_level else _ROW_CHECKS)[name] = expression


def known_checks() -> list[str]:
    return sorted([*_ROW_CHECKS, *_TABLE_CHECKS])


@dataclass(frozen=True)
class _Flag:
    """A check bound to a frame: its flag column and its expression."""

    name: str
    expression: Column
    table_level: bool


def _bind(df: DataFrame, checks: Sequence[CheckConfig]) -> list[_Flag]:
    repeated = {name for name, n in Counter(c.check for c in checks).items() if n > 1}
    flags = []
    for position, cfg in enumerate(checks):
        name = cfg.check
        if name in repeated:
            subject = cfg.column or "_".join(cfg.columns or []) or str(position)
            name = f"{name}_{subject}"
        table_level = cfg.check in _TABLE_CHECKS
        registry = _TABLE_CHECKS if table_level else _ROW_CHECKS
        if cfg.check not in registry:
            raise KeyError(f"unknown check {cfg.check!r}; known: {known_checks()}")
        flags.append(_Flag(f"{name}_passed", registry[cfg.check](df, cfg), table_level))
    names = Counter(flag.name for flag in flags)
    if max(names.values(), default=0) > 1:
        raise ValueError(f"two checks share a flag column: {names.most_common(1)[0][0]}")
    return flags


def flag_columns(
    df: DataFrame, checks: Sequence[CheckConfig], table_level: bool | None = None
) -> list[str]:
    """Names of all flags, or of the table-level or row-level ones alone."""
    return [f.name for f in _bind(df, checks) if table_level in (None, f.table_level)]


# ---------------------------------------------------------------- row annotation and split


def annotate(
    df: DataFrame, checks: Sequence[CheckConfig], given: Mapping[str, Column] | None = None
) -> DataFrame:
    """Add one flag per check and ``is_valid``; rows and columns stay as they are.

    ``given`` supplies the flags that are already known, such as table checks once statistics
    exist. Any other table check is a scalar subquery: the count is taken once and enters the row
    expression as a constant, with no join.
    """
    given = given or {}
    flags = _bind(df, checks)
    annotated = df
    for flag in flags:
        holds = given.get(flag.name)
        if holds is None:
            holds = flag.expression
            if flag.table_level:
                holds = df.agg(holds.alias(flag.name)).scalar()
        annotated = annotated.withColumn(flag.name, F.coalesce(holds, F.lit(False)))
    return annotated.withColumn("is_valid", all_true([F.col(flag.name) for flag in flags]))


def run_check(df: DataFrame, cfg: CheckConfig) -> DataFrame:
    """A single check's flag column."""
    return annotate(df, [cfg]).drop("is_valid")


def apply_checks(
    df: DataFrame, checks: Sequence[CheckConfig], given: Mapping[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected): clean has the input's columns, rejected keeps all flags."""
    annotated = annotate(df, checks, given)
    clean, rejected = split(annotated, "is_valid")
    return clean.select(*df.columns), rejected


# ---------------------------------------------------------------- statistics


def quality_stats(
    df: DataFrame,
    checks: Sequence[CheckConfig],
    by: Sequence[str] = (),
    given: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One aggregation: per group the row counts, failure rate and per check failures.

    Columns: ``by..., total, clean, rejected, failure_rate`` and per check ``<flag>`` (did the check
    hold for every row) and ``<flag>_failed`` (rows failing it).
    """
    given = given or {}
    flags = [
        _Flag(f.name, given.get(f.name, f.expression), f.table_level and f.name not in given)
        for f in _bind(df, checks)
    ]
    row_flags = [flag for flag in flags if not flag.table_level]
    row_valid = all_true([F.coalesce(flag.expression, F.lit(False)) for flag in row_flags])
    aggregates = [F.count(F.lit(1)).alias("total"), F.count_if(row_valid).alias("_row_clean")]
    for i, flag in enumerate(flags):
        if flag.table_level:
            aggregates.append(F.coalesce(flag.expression, F.lit(False)).alias(f"_t{i}"))
        else:
            failed = ~F.coalesce(flag.expression, F.lit(False))
            aggregates.append(F.count_if(failed).alias(f"_f{i}"))
    sums = df.groupBy(*by).agg(*aggregates)

    total = F.col("total")
    table_ok = all_true([F.col(f"_t{i}") for i, flag in enumerate(flags) if flag.table_level])
    clean = F.when(table_ok, F.col("_row_clean")).otherwise(F.lit(0)).cast("bigint")
    outcomes = []
    for i, flag in enumerate(flags):
        failed = (
            F.when(F.col(f"_t{i}"), F.lit(0)).otherwise(total).cast("bigint")
            if flag.table_level
            else F.col(f"_f{i}")
        )
        holds = F.col(f"_t{i}") if flag.table_level else F.col(f"_f{i}") == 0
        outcomes += [holds.alias(flag.name), failed.alias(f"{flag.name}_failed")]
    return sums.select(
        *by,
        "total",
        clean.alias("clean"),
        (total - clean).alias("rejected"),
        ratio(total - clean, total).alias("failure_rate"),
        *outcomes,
    )


def check_results(
    df: DataFrame, checks: Sequence[CheckConfig], threshold: float, by: Sequence[str] = ()
) -> DataFrame:
    """One row per check: ``by..., check_name, passed, failed_count, threshold`` and the totals."""
    stats = quality_stats(df, checks, by)
    return unpivot_results(stats, flag_columns(df, checks), threshold, by)


def unpivot_results(
    stats: DataFrame, flags: Sequence[str], threshold: float, by: Sequence[str] = ()
) -> DataFrame:
    rows = [
        F.struct(
            F.lit(flag.removesuffix("_passed")).alias("check_name"),
            F.col(flag).alias("passed"),
            F.col(f"{flag}_failed").alias("failed_count"),
        )
        for flag in flags
    ]
    if not rows:
        raise ValueError("there are no checks to report")
    return stats.select(
        *by, "total", "clean", "rejected", "failure_rate", F.inline(F.array(*rows))
    ).withColumn("threshold", F.lit(float(threshold)))


def pass_rate(clean: Column, total: Column) -> Column:
    """Share of clean rows in percent."""
    return F.round(ratio(clean, total) * 100, 2)


def enforce(run_id: str, failure_rate: float, threshold: float) -> None:
    """Raise if the failure rate is strictly above the threshold."""
    if failure_rate > threshold:
        raise HardQualityFailure(run_id, failure_rate)
