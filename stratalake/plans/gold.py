"""Silver to gold: map, check, gate, publish, quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.constants import INDICATOR_CODES
from stratalake.contracts import Contract
from stratalake.layout import Lake
from stratalake.operators.columns import keep, missing_columns, recode, rename
from stratalake.operators.quality import (
    CheckConfig,
    HardQualityFailure,
    annotate,
    flag_columns,
    quality_stats,
)
from stratalake.schemas import schema_hash
from stratalake.sinks import SNAPSHOT_COLUMNS, write_partitioned, write_snapshots

# Silver column to gold column.
_RENAMES = {
    "gold_macro_indicators": {"period_date": "period", "series_code": "indicator_code"},
    "gold_exchange_rates": {"period_date": "period"},
}
_COLUMNS = {
    "gold_macro_indicators": ["period", "indicator_code", "value", "source"],
    "gold_exchange_rates": ["period", "currency_pair", "rate", "source"],
}


def map_to_gold(silver: DataFrame, dataset: str, also: Sequence[str] = ()) -> DataFrame:
    """Gold names, gold columns, gold codes. Other datasets pass through unchanged."""
    if dataset not in _COLUMNS:
        return silver
    mapped = keep(rename(silver, _RENAMES[dataset]), [*also, *_COLUMNS[dataset]])
    if "indicator_code" in mapped.columns:
        mapped = recode(mapped, "indicator_code", INDICATOR_CODES)
    return mapped


def conform(df: DataFrame, contract: Contract, also: Sequence[str] = ()) -> DataFrame:
    """The contract's columns in its order and types.

    A value that does not fit its type becomes NULL and a column that is missing becomes a NULL
    column: both are for the checks to reject, not for the job to fail on.
    """
    present = set(df.columns)
    columns = [
        (F.col(c).try_cast(t) if c in present else F.lit(None).cast(t)).alias(c)
        for c, t in contract.schema.items()
    ]
    return df.select(*also, *columns)


def contract_checks(present: Sequence[str], contract: Contract) -> list[CheckConfig]:
    """The contract's checks, plus a schema check if ``present`` lacks any of its columns."""
    checks = list(contract.quality_checks)
    lacking = missing_columns(list(contract.schema), present)
    if lacking and all(c.check != "schema" for c in checks):
        checks.append(CheckConfig("schema", columns=sorted(contract.schema)))
    return checks


@dataclass(frozen=True)
class Batch:
    """A batch month's run."""

    day: date
    run_id: str


@dataclass(frozen=True)
class Outcome:
    """What publishing did for one batch."""

    batch: Batch
    total: int
    clean: int
    rejected: int
    failure_rate: float
    gold_path: str | None
    quarantine_path: str | None
    schema_hash: str

    @property
    def status(self) -> str:
        """A month without a row is no success: what was published before stays in force."""
        if not self.total:
            return "FAILED"
        return "SUCCESS" if self.gold_path else "PARTIAL"

    @property
    def error(self) -> str | None:
        if not self.total:
            return f"no rows for {self.batch.day:%Y-%m}"
        return None if self.gold_path else str(HardQualityFailure(self.batch.run_id, self.failure_rate))


@dataclass(frozen=True)
class Published:
    outcomes: list[Outcome]
    results: list[dict[str, Any]]  # one per batch and check

    def raise_for_gate(self) -> None:
        """Raise for the first batch that did not pass."""
        for outcome in self.outcomes:
            if outcome.gold_path is None:
                raise HardQualityFailure(outcome.batch.run_id, outcome.failure_rate)


_ON = list(SNAPSHOT_COLUMNS)
_COUNTS = ("total", "clean", "rejected", "failure_rate")


def publish(
    lake: Lake, silver: DataFrame, contract: Contract, batches: Sequence[Batch]
) -> Published:
    """Check and publish one or many batch months of a dataset.

    ``silver`` carries its batch month as text columns ``year`` and ``month``. One aggregation
    yields all figures, then there are at most two writes, however many months there are. Rejected
    rows and check results are kept in every case; gold is written for the months that pass the
    gate only. A month without rows passes no gate and leaves its gold as it is.
    """
    spark = silver.sparkSession
    mapped = map_to_gold(silver, contract.dataset, _ON)
    checks = contract_checks(mapped.columns, contract)
    # Conforming adds missing columns as NULL, so the schema check looks at the mapped frame.
    schema_flags = {
        "schema_passed": F.lit(not missing_columns(c.columns or [], mapped.columns))
        for c in checks
        if c.check == "schema"
    }
    rows = conform(mapped, contract, _ON)
    # An empty month has no group: what the checks say of no rows holds for it.
    nothing = quality_stats(rows.filter(F.lit(False)), checks, (), schema_flags).first().asDict()
    stats = _figures(quality_stats(rows, checks, _ON, schema_flags), batches, nothing)
    passed = [
        b
        for b in batches
        if stats[b]["total"] and stats[b]["failure_rate"] <= contract.hard_failure_threshold
    ]

    flags = flag_columns(rows, checks)
    table_flags = flag_columns(rows, checks, table_level=True)
    # One row per batch month of this job, hence small enough to broadcast.
    verdicts = spark.createDataFrame(
        [
            (*_text(b), b.run_id, b in passed, *[stats[b][f] for f in table_flags])
            for b in batches
        ],
        ", ".join(
            ["year string, month string, run_id string, _gate boolean"]
            + [f"`_{f}` boolean" for f in table_flags]
        ),
    )
    given = {**schema_flags, **{f: F.col(f"_{f}") for f in table_flags}}
    annotated = annotate(rows.join(F.broadcast(verdicts), _ON), checks, given)

    quarantines = contract.quarantine_on_failure and any(s["rejected"] for s in stats.values())
    if quarantines:
        rejected = annotated.filter(~F.col("is_valid"))
        columns = [*contract.schema, *flags, "is_valid", "run_id"]
        write_partitioned(rejected.select(*columns), lake.quarantine(contract.dataset), ["run_id"])
    clean = annotated.filter(F.col("is_valid") & F.col("_gate")).select(*_ON, *contract.schema)
    if passed:
        days = [b.day for b in passed]
        write_snapshots(clean, lake.gold(contract.dataset), days, contract.partition_key)

    identity = schema_hash(clean.drop(*_ON))
    outcomes = []
    for batch in batches:
        figures = {k: stats[batch][k] for k in _COUNTS}
        gold = lake.snapshot(lake.gold(contract.dataset), batch.day) if batch in passed else None
        kept = contract.quarantine_on_failure and figures["rejected"]
        quarantine = f"{lake.quarantine(contract.dataset)}/run_id={batch.run_id}" if kept else None
        outcomes.append(Outcome(batch, **figures, gold_path=gold, quarantine_path=quarantine, schema_hash=identity))
    results = [
        {
            "run_id": batch.run_id,
            "check_name": flag.removesuffix("_passed"),
            "passed": stats[batch][flag],
            "failed_count": stats[batch][f"{flag}_failed"],
            "threshold": float(contract.hard_failure_threshold),
        }
        for batch in batches
        for flag in flags
    ]
    return Published(outcomes, results)


def _text(batch: Batch) -> tuple[str, str]:
    return f"{batch.day.year}", f"{batch.day.month:02d}"


def _figures(
    stats: DataFrame, batches: Sequence[Batch], nothing: Mapping[str, Any]
) -> dict[Batch, Mapping[str, Any]]:
    """Statistics per batch, ``nothing`` for one without rows: one collected row per batch month."""
    rows = {(r["year"], r["month"]): r.asDict() for r in stats.collect()}
    unknown = set(rows) - {_text(b) for b in batches}
    if unknown:
        raise ValueError(f"rows of months that are not part of this job: {sorted(unknown)}")
    return {b: rows.get(_text(b), nothing) for b in batches}


def batch_columns(df: DataFrame, day: date) -> DataFrame:
    """Tag all rows with one batch month."""
    return df.withColumns({"year": F.lit(f"{day.year}"), "month": F.lit(f"{day.month:02d}")})

