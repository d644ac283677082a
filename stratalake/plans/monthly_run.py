"""The monthly chain of one source: guard, land, conform, check, publish, record.

Each source runs its own chain. One month and a backfill of many months are the same plan; a
backfill is one Spark job per layer over all months, not a loop of jobs.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.constants import BSP_FX, PSA
from stratalake.contracts import load_contract
from stratalake.layout import batch_folder, first_day
from stratalake.operators.columns import computed_once, project
from stratalake.plans.bronze import PendingBatch, land, make_batch_id, read_bronze
from stratalake.plans.gold import Batch, Published, publish
from stratalake.plans.metadata import MetadataStore, now
from stratalake.plans.silver import greatest, transform, write_silver
from stratalake.schemas import get_silver_schema, record_schema
from stratalake.sinks import SNAPSHOT_COLUMNS, read_snapshots

# The gold dataset a source feeds. Policy decisions end in silver.
GOLD_OF = {PSA: "gold_macro_indicators", BSP_FX: "gold_exchange_rates"}


#: Rows that a task conforms at a time, about.
_TASK_ROWS = 500_000


@dataclass(frozen=True)
class RunResult:
    day: date
    run_id: str | None
    status: str  # SUCCESS, PARTIAL, FAILED without rows, or SKIPPED by the guard


def months_between(start: date, end: date) -> list[date]:
    """First-of-month dates, both ends included."""
    count = (end.year - start.year) * 12 + end.month - start.month + 1
    first = start.year * 12 + start.month - 1
    return [date((first + i) // 12, (first + i) % 12 + 1, 1) for i in range(count)]


def run_month(
    store: MetadataStore,
    source: str,
    records: DataFrame,
    run_date: date,
    backfill: bool = False,
    as_of: date | None = None,
) -> RunResult:
    """Process one month; a month that is done is skipped unless it is a backfill."""
    day = first_day(run_date)
    if not backfill and store.batch_processed(source, day):
        return RunResult(day, None, "SKIPPED")
    batch = Batch(day, store.create_run(source, run_date))

    def bronze() -> Landed:
        path = land(store.lake, store, source, records, run_date)
        # The same content may have landed under an earlier month: tag it with this one.
        rows = read_bronze(store, source, path)
        rows = rows.withColumns({"year": F.lit(f"{day.year}"), "month": F.lit(f"{day.month:02d}")})
        return Landed(rows, _row_counts(rows), {})

    return _chain(store, source, bronze, [batch], as_of)[0]


def run_backfill(
    store: MetadataStore,
    source: str,
    records: DataFrame,
    start: date,
    end: date,
    as_of: date | None = None,
    batch_date: str | None = None,
) -> list[RunResult]:
    """Reprocess all months from ``start`` to ``end``, done or not.

    ``batch_date`` names a column that assigns records to batch months. Without it every month
    gets the full record set, as a publisher's table always holds the whole history. Records whose
    date cannot be read belong to no month: they are kept in quarantine, in a folder of the batch.
    A month without records fails and keeps what was published for it.
    """
    batch_id = make_batch_id()
    days = months_between(start, end)
    batches = [Batch(d, run) for d, run in zip(days, store.create_runs(source, days))]
    if batch_date is None:
        dated = records.withColumn("_batch", F.lit(days[0]))
    else:
        # The filter would copy the source's expression for the date, and evaluate every copy.
        month = F.trunc(F.col(batch_date).try_cast("date"), "month").alias("_month")
        tagged = records.select(*record_schema(source).fieldNames(), month)
        once = computed_once(tagged, {"_batch": F.col("_month")}).drop("_month")
        dated = once.filter(F.col("_batch").isNull() | F.col("_batch").between(days[0], days[-1]))
    typed = project(dated, record_schema(source).add("_batch", "date"))

    def bronze() -> Landed:
        return _land_months(store, source, typed, batch_id, days if batch_date is None else [])

    return _chain(store, source, bronze, batches, as_of)


@dataclass(frozen=True)
class Landed:
    """Bronze rows under one month per content, rows per month, and the months of a content that
    stands for several."""

    rows: DataFrame
    counts: Mapping[tuple[str, str], int]
    copies: Mapping[date, Sequence[date]]


def _land_months(
    store: MetadataStore, source: str, rows: DataFrame, batch_id: str, whole: Sequence[date] = ()
) -> Landed:
    """Land records of many months (``_batch``) in one job, each content once, and read them back.

    As in :func:`stratalake.plans.bronze.land`, the source is evaluated once, and a month whose
    content has landed before, under whatever month, is not written again. ``whole``: the months
    that all get the one record set. Rows without a month are kept in quarantine.
    """
    root = store.lake.bronze(source)
    pending = PendingBatch(store.lake, store, source, rows, F.col("_batch"), batch_id=batch_id)
    try:
        contents = pending.contents()
        pending.set_aside(f"{store.lake.quarantine(source)}/batch_id={batch_id}")
        if not contents:
            raise ValueError("an empty record set cannot be landed")
        paths = pending.commit(contents)
    finally:
        pending.discard()
    months: dict[str, list[date]] = {}
    counts = {}
    for content in contents:
        for day in whole or [content.day]:
            months.setdefault(paths[content.sha256_hash], []).append(day)
            counts[_text(day)] = content.row_count
    # Rows are read once per content and tagged with the first of its months, which is that of the
    # folder unless the content had landed under another month.
    elsewhere = {
        p: days[0] for p, days in months.items() if not p.startswith(f"{root}/{batch_folder(days[0])}/")
    }
    parts = []
    if own := [p for p in months if p not in elsewhere]:
        parts.append(read_bronze(store, source, *own))
    if elsewhere:
        parts.append(_retagged(read_bronze(store, source, *elsewhere), root, elsewhere))
    copies = {days[0]: days for days in months.values() if len(days) > 1}
    return Landed(reduce(DataFrame.unionByName, parts), counts, copies)


def _retagged(landed: DataFrame, root: str, months: Mapping[str, date]) -> DataFrame:
    """Bronze rows under the month that is named for their path."""
    path = F.regexp_extract(F.input_file_name(), r"(year=\d+/month=\d+/batch_id=[^/]+)/", 1)
    named = {p.removeprefix(f"{root}/"): str(day) for p, day in months.items()}
    month = F.try_element_at(F.from_json(F.lit(json.dumps(named)), "map<string,string>"), path)
    return landed.withColumns({"year": F.substring(month, 1, 4), "month": F.substring(month, 6, 2)})


def _dealt(bronze: Landed) -> DataFrame:
    """Bronze rows in parts of about ``_TASK_ROWS`` rows.

    Conforming sorts the rows of a task before it sends the newest of each key. Files of many months
    are read by few tasks, which would sort more the more there is. Rows are dealt out by their place
    in a task, so copies of a row or a key do not meet in one part.
    """
    repeated = sum(bronze.counts[_text(day)] for days in bronze.copies.values() for day in days[1:])
    parts = math.ceil((sum(bronze.counts.values()) - repeated) / _TASK_ROWS)
    if parts < 2:
        return bronze.rows
    placed = bronze.rows.withColumn("_place", F.monotonically_increasing_id())
    return placed.repartition(parts, "_place").drop("_place")


def _spread(silver: DataFrame, copies: Mapping[date, Sequence[date]]) -> DataFrame:
    """Conformed rows of a content for all the months that it stands for."""
    if not copies:
        return silver
    text = {f"{d:%Y-%m}": [f"{c:%Y-%m}" for c in days] for d, days in copies.items()}
    known = F.from_json(F.lit(json.dumps(text)), "map<string,array<string>>")
    own = F.concat_ws("-", "year", "month")
    months = F.coalesce(F.try_element_at(known, own), F.array(own))
    return silver.withColumn("_month", F.explode(months)).withColumns(
        {"year": F.substring("_month", 1, 4), "month": F.substring("_month", 6, 2)}
    ).drop("_month")


def _chain(
    store: MetadataStore, source: str, bronze_of, batches: Sequence[Batch], as_of: date | None
) -> list[RunResult]:
    lake, by = store.lake, list(SNAPSHOT_COLUMNS)
    days = [b.day for b in batches]
    clock = _StageClock(store, batches)
    try:
        bronze = bronze_of()
        landed = bronze.counts
        clock.done("ingest", landed, landed)
        options = {"as_of": as_of} if source not in GOLD_OF else {}
        present = [d for d in days if _text(d) in landed]
        reduced = replace(bronze, rows=greatest(bronze.rows, source))
        conformed = _spread(transform(_dealt(reduced), source, by, **options), bronze.copies)
        silver_path = write_silver(lake, conformed, source, present)
        silver = _read_silver(store, source, silver_path, present)
        counts = _row_counts(silver)
        clock.done("transform", landed, counts)
        published = None
        if source in GOLD_OF:
            published = publish(lake, silver, load_contract(GOLD_OF[source]), batches)
            store.write("quality_results", published.results)
            clean = {_month(o.batch): o.clean for o in published.outcomes}
            clock.done("quality", counts, clean)
    except Exception as error:
        failed = {"status": "FAILED", "error_message": str(error)}
        store.update_runs([{"run_id": batch.run_id, **failed} for batch in batches])
        raise
    finally:
        clock.flush()
    return _commit(store, source, batches, counts, published)


def _text(day: date) -> tuple[str, str]:
    return f"{day.year}", f"{day.month:02d}"


def _month(batch: Batch) -> tuple[str, str]:
    return _text(batch.day)


def _row_counts(df: DataFrame) -> dict[tuple[str, str], int]:
    """Rows per batch month of stored data: no column is read, one row per month comes back."""
    return {(r["year"], r["month"]): r["count"] for r in df.groupBy(*SNAPSHOT_COLUMNS).count().collect()}


def _read_silver(store: MetadataStore, source: str, path: str, days: Sequence[date]) -> DataFrame:
    """The batch months just written."""
    schema = get_silver_schema(source).add("year", "integer").add("month", "integer")
    rows = read_snapshots(store.spark, path, days, schema)
    if rows is None:
        rows = store.spark.createDataFrame([], schema)
    return rows.withColumns(
        {
            "year": F.col("year").cast("string"),
            "month": F.lpad(F.col("month").cast("string"), 2, "0"),
        }
    )


def _commit(
    store: MetadataStore,
    source: str,
    batches: Sequence[Batch],
    counts: dict,
    published: Published | None,
) -> list[RunResult]:
    """Record every run; versions and the processed mark only for months that succeeded."""
    results, finished, versions, done = [], [], [], []
    for i, batch in enumerate(batches):
        rows = counts.get(_month(batch), 0)
        status, figures = "SUCCESS", {"records_ingested": rows, "records_rejected": 0}
        if published is None and not rows:
            status, figures["error_message"] = "FAILED", f"no rows for {batch.day:%Y-%m}"
        if published is not None:
            outcome = published.outcomes[i]
            status = outcome.status
            figures = {"records_ingested": outcome.clean, "records_rejected": outcome.rejected}
            if status == "SUCCESS":
                versions.append(
                    {
                        "run_id": batch.run_id,
                        "dataset_name": GOLD_OF[source],
                        "partition_key": batch_folder(batch.day),
                        "row_count": outcome.clean,
                        "schema_hash": outcome.schema_hash,
                        "s3_path": outcome.gold_path,
                        "created_at": now(),
                    }
                )
            else:
                figures["error_message"] = outcome.error
        finished.append({"run_id": batch.run_id, "status": status, **figures})
        if status == "SUCCESS":
            done.append((batch.day, batch.run_id))
        results.append(RunResult(batch.day, batch.run_id, status))
    # The status comes last: a run that is stopped before it is not a success without a version.
    if versions:
        store.write("dataset_versions", versions)
    if done:
        store.mark_processed(source, done)
    store.update_runs(finished)
    return results


class _StageClock:
    """Collects one stage-metrics row per run and finished stage; ``flush`` appends them."""

    def __init__(self, store: MetadataStore, batches: Sequence[Batch]) -> None:
        self.store, self.batches, self.started = store, batches, now()
        self.rows: list[dict] = []

    def done(self, stage: str, rows_in: Mapping, rows_out: Mapping) -> None:
        ended: datetime = now()
        self.rows += [
            {
                "run_id": batch.run_id,
                "stage_name": stage,
                "started_at": self.started,
                "duration_seconds": (ended - self.started).total_seconds(),
                "input_rows": rows_in.get(_month(batch), 0),
                "output_rows": rows_out.get(_month(batch), 0),
            }
            for batch in self.batches
        ]
        self.started = ended

    def flush(self) -> None:
        if self.rows:
            self.store.write("stage_metrics", self.rows)
