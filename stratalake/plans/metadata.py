"""Run, lineage, version and quality metadata.

Tables are append-only Parquet logs. Current rows come from folding the log by key: newest value
wins, first landing wins, or last value that is not NULL wins. Nothing is read, changed and written
back, so concurrent writers cannot lose each other's rows and no table is overwritten while read.
Files of appends are put together from time to time (:meth:`MetadataStore.fold`).
"""

from __future__ import annotations

import math
import secrets
import time
import uuid
from collections.abc import Collection, Sequence
from datetime import date, datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.constants import QUALITY_HISTORY_ROWS, RUN_LIST_DEFAULT, RUN_LIST_MAX
from stratalake.functions.temporal import first_of_month, month_sequence
from stratalake.layout import (
    Lake,
    children,
    data_files,
    delete_folder,
    first_day,
    folder_exists,
    move_folder,
    read_text,
)
from stratalake.operators.filters import by_value
from stratalake.operators.latest import latest_per_key, newest, newest_first, top_per_key
from stratalake.operators.merge import fold_patches
from stratalake.schemas import metadata_schema
from stratalake.sinks import append

# ---------------------------------------------------------------- read queries


def list_runs(runs: DataFrame, source: str | None = None, limit: int = RUN_LIST_DEFAULT) -> DataFrame:
    """Newest runs first, optionally of one source, 1 to 100 of them."""
    order = newest_first(["started_at", "run_id"])
    return newest(by_value(runs, "source", source), order, limit, RUN_LIST_MAX)


def run_detail(runs: DataFrame, stages: DataFrame, results: DataFrame) -> DataFrame:
    """Runs with their stage metrics (by start) and check results nested, empty lists if none.

    A run has one stage row per stage and one result row per check, so the lists are as long as
    the stage and check catalogues. For logs without that bound use :func:`run_detail_rows`.
    """
    return (
        runs.join(_children(stages, "stage_metrics", ["started_at", "id"]), "run_id", "left")
        .join(_children(results, "quality_results", ["id"]), "run_id", "left")
        .withColumns(
            {c: F.coalesce(c, F.array()) for c in ("stage_metrics", "quality_results")}
        )
    )


def _children(rows: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    rest = [c for c in rows.columns if c != "run_id" and c not in order]
    child = F.struct(*order, *rest)
    return rows.groupBy("run_id").agg(F.sort_array(F.collect_list(child)).alias(name))


def run_detail_rows(runs: DataFrame, stages: DataFrame) -> DataFrame:
    """The flat form: one row per run and stage, runs without stages kept. Any number of stages."""
    return runs.join(stages, "run_id", "left")


def run_lineage(runs: DataFrame, versions: DataFrame, run_id: str | None = None) -> DataFrame:
    """Which run wrote which dataset where."""
    joined = by_value(runs, "run_id", run_id).join(versions, "run_id")
    return joined.select("run_id", "source", "run_date", "dataset_name", "row_count", "s3_path")


def latest_versions(versions: DataFrame) -> DataFrame:
    """The newest version of every dataset."""
    return latest_per_key(versions, ["dataset_name"], ["created_at", "id"])


def quality_of(
    results: DataFrame, runs: DataFrame, versions: DataFrame, dataset: str | None = None
) -> DataFrame:
    """Check results of successful runs, once each however many versions a run wrote.

    ``dataset`` restricts to one dataset's runs; otherwise results are listed per dataset.
    """
    wrote = by_value(versions, "dataset_name", dataset).select("dataset_name", "run_id").distinct()
    succeeded = runs.filter(F.col("status") == "SUCCESS").select("run_id", "ended_at")
    return results.join(succeeded, "run_id").join(wrote, "run_id")


_HISTORY_ORDER = ("ended_at", "run_id", "id")


def quality_history(
    results: DataFrame,
    runs: DataFrame,
    versions: DataFrame,
    dataset: str,
    limit: int = QUALITY_HISTORY_ROWS,
) -> DataFrame:
    """Newest check results of a dataset's successful runs."""
    rows = quality_of(results, runs, versions, dataset)
    return newest(rows, newest_first(_HISTORY_ORDER), limit)


def quality_history_per_dataset(
    results: DataFrame, runs: DataFrame, versions: DataFrame, limit: int = QUALITY_HISTORY_ROWS
) -> DataFrame:
    """The same for every dataset at once."""
    rows = quality_of(results, runs, versions)
    return top_per_key(rows, ["dataset_name"], newest_first(_HISTORY_ORDER), limit)


def quality_latest(
    results: DataFrame, runs: DataFrame, versions: DataFrame, dataset: str
) -> DataFrame:
    """Check results of the dataset's latest successful run alone."""
    wrote = versions.filter(F.col("dataset_name") == dataset).select("run_id").distinct()
    succeeded = runs.filter(F.col("status") == "SUCCESS").join(wrote, "run_id", "left_semi")
    last = newest(succeeded, newest_first(["ended_at", "run_id"]), 1).select("run_id", "ended_at")
    return results.join(last, "run_id")


# ---------------------------------------------------------------- batch planning


def planned_batches(bounds: DataFrame, sources: Sequence[str]) -> DataFrame:
    """``source, batch_date`` for every month of ``bounds`` (one row ``start``, ``end``)."""
    per_source = F.explode(F.array(*[F.lit(s) for s in sources])).alias("source")
    return bounds.select(month_sequence(F.col("start"), F.col("end")).alias("batch_date")).select(
        per_source, "batch_date"
    )


def pending_batches(planned: DataFrame, processed: DataFrame, backfill: bool = False) -> DataFrame:
    """Planned batches that have not been processed; a backfill takes them all."""
    due = planned.withColumn("batch_date", first_of_month(F.col("batch_date"))).distinct()
    if backfill:
        return due
    done = processed.select("source", first_of_month(F.col("batch_date")).alias("batch_date"))
    return due.join(done.distinct(), ["source", "batch_date"], "left_anti")


# ---------------------------------------------------------------- store


_WRITER_BITS = 12
#: Rows of a folded file, about. No task sorts more, however long the log is.
_FOLDED_ROWS = 250_000


class MetadataStore:
    """The six tables of a lake."""

    def __init__(self, spark: SparkSession, lake: Lake) -> None:
        self.spark = spark
        self.lake = lake

    # -- log access

    def _log(self, table: str) -> DataFrame:
        """All rows of a log: its folded generations and the files that came after them.

        Two listings decide what is read; no file is opened for its schema.
        """
        schema = metadata_schema(table).add("_seq", "long")
        generations = self._generations(table)
        folded = {name for generation in generations for name in self._folded_names(generation)}
        paths = [f"{generation}/rows" for generation in generations]
        paths += [f for f in self._files(table) if f.rsplit("/", 1)[-1] not in folded]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _files(self, table: str) -> list[str]:
        """Files of single appends."""
        listed = children(self.spark, self.lake.metadata(table))
        return [path for path in listed if path.endswith(".parquet")]

    def _generations(self, table: str) -> list[str]:
        """Folders of finished folds, oldest first."""
        return sorted(children(self.spark, f"{self.lake.metadata(table)}/_folded"))

    def _folded_names(self, generation: str) -> list[str]:
        parts = data_files(self.spark, f"{generation}/names")
        return [name for part in parts for name in read_text(self.spark, part).split()]

    def fold(self, table: str) -> int:
        """Put the files of all appends so far into one file, or more if they hold very many rows,
        and return how many there were.

        A generation holds their rows and their names and appears with one rename. From then on
        readers leave the named files out, so removing them afterwards may be interrupted and
        repeated, and an append that arrives meanwhile is neither lost nor read twice. Folding once
        a month keeps a log at a dozen files a year, plus those of the current month.
        """
        log = self.lake.metadata(table)
        generations = self._generations(table)
        folded = {name for generation in generations for name in self._folded_names(generation)}
        files = self._files(table)
        new = [f for f in files if f.rsplit("/", 1)[-1] not in folded]
        if len(new) > 1:
            schema = metadata_schema(table).add("_seq", "long")
            pending = f"{log}/_folding-{uuid.uuid4().hex}"
            rows = self.spark.read.schema(schema).parquet(*new)
            # Appends hold a handful of rows each, so one file is the rule. The count reads footers.
            parts = math.ceil(rows.count() / _FOLDED_ROWS)
            cut = rows.repartitionByRange(parts, "_seq") if parts > 1 else rows.coalesce(1)
            cut.sortWithinPartitions("_seq").write.parquet(f"{pending}/rows")
            names = self.spark.createDataFrame([(f.rsplit("/", 1)[-1],) for f in new], "name string")
            names.coalesce(1).write.text(f"{pending}/names")
            move_folder(self.spark, pending, f"{log}/_folded/{len(generations):08d}-{uuid.uuid4().hex}")
            files = new + [f for f in files if f not in new]
        elif new:
            files = [f for f in files if f not in new]
        for file in files:
            delete_folder(self.spark, file)
        return len(new) if len(new) > 1 else 0

    def write(self, table: str, rows: Sequence[dict[str, Any]]) -> None:
        """Append a handful of metadata rows."""
        schema = metadata_schema(table).add("_seq", "long")
        # Microseconds, then bits drawn by this writer: writers at the same moment stay apart.
        clock, own = time.time_ns() // 1000, secrets.randbits(_WRITER_BITS)
        filled = [
            {"id": at, **row, "_seq": at}
            for i, row in enumerate(rows)
            for at in [(clock + i) << _WRITER_BITS | own]
        ]
        tuples = [tuple(row.get(name) for name in schema.fieldNames()) for row in filled]
        append(self.spark.createDataFrame(tuples, schema).coalesce(1), self.lake.metadata(table))

    def table(self, name: str) -> DataFrame:
        """Current rows."""
        log = self._log(name)
        if name == "pipeline_runs":
            # Values are texts, so every task sorts its rows by run. The rows are dealt out before that:
            # a file of many rows would be sorted by the one task that reads it. A run has few.
            dealt = log.hint("rebalance", "run_id")
            return fold_patches(dealt, ["run_id"], "_seq").select(*metadata_schema(name).fieldNames())
        if name == "processed_batches":
            return latest_per_key(log, ["source", "batch_date"], ["_seq"]).drop("_seq")
        if name == "file_manifest":
            # The first successful landing of a content counts; failures only until then. A batch
            # that failed before its content was known stands for itself.
            landed = log.withColumns(
                {
                    "_ok": (F.col("status") == "SUCCESS").cast("int"),
                    "_age": -F.col("_seq"),
                    "_content": F.coalesce("sha256_hash", "batch_id"),
                }
            )
            return latest_per_key(landed, ["source", "_content"], ["_ok", "_age"]).drop(
                "_ok", "_age", "_seq", "_content"
            )
        return log.drop("_seq")

    # -- runs

    def create_runs(
        self, source: str, run_dates: Sequence[date], name: str = "stratalake"
    ) -> list[str]:
        """Open one run per date with a single append."""
        run_ids = [str(uuid.uuid4()) for _ in run_dates]
        opened = {"pipeline_name": name, "source": source, "started_at": now(), "status": "RUNNING"}
        rows = [{"run_id": r, "run_date": d, **opened} for r, d in zip(run_ids, run_dates)]
        self.write("pipeline_runs", rows)
        return run_ids

    def create_run(self, source: str, run_date: date, name: str = "stratalake") -> str:
        return self.create_runs(source, [run_date], name)[0]

    def update_runs(self, rows: Sequence[dict[str, Any]]) -> None:
        """Finish runs (``run_id``, ``status``, figures); figures not given keep their value."""
        self.write("pipeline_runs", [{"ended_at": now(), **row} for row in rows])

    def update_run(self, run_id: str, status: str, **figures: Any) -> None:
        self.update_runs([{"run_id": run_id, "status": status, **figures}])

    # -- batches and versions

    def batch_processed(self, source: str, day: date) -> bool:
        done = self._log("processed_batches").filter(
            (F.col("source") == source) & (F.col("batch_date") == first_day(day))
        )
        return not done.isEmpty()

    def mark_processed(self, source: str, days_and_runs: Sequence[tuple[date, str]]) -> None:
        self.write(
            "processed_batches",
            [
                {"source": source, "batch_date": first_day(d), "run_id": r, "processed_at": now()}
                for d, r in days_and_runs
            ],
        )

    def landed_path(self, source: str, sha256_hash: str) -> str | None:
        """Path of an earlier landing of the same content."""
        return self.landed_paths(source, {sha256_hash}).get(sha256_hash)

    def landed_paths(self, source: str, hashes: Collection[str]) -> dict[str, str]:
        """Paths of earlier landings by content, for the contents of one job.

        A landing that was announced but never confirmed counts if its folder is there: the rename
        is the commit.
        """
        log = self._log("file_manifest").filter(
            (F.col("source") == source) & F.col("sha256_hash").isin(list(hashes))
        )
        rows = log.select("sha256_hash", "status", "file_path", "_seq").collect()  # few per content
        found = {}
        for row in sorted(rows, key=lambda r: (r.status != "SUCCESS", r["_seq"])):
            if row.sha256_hash not in found and (
                row.status == "SUCCESS"
                or row.status == "PENDING" and folder_exists(self.spark, row.file_path)
            ):
                found[row.sha256_hash] = row.file_path
        return found

    # -- read API

    def runs(self, source: str | None = None, limit: int = RUN_LIST_DEFAULT) -> DataFrame:
        return list_runs(self.table("pipeline_runs"), source, limit)

    def run(self, run_id: str) -> DataFrame:
        """Nested detail of one run; every table is filtered to it first."""
        one = [
            self._log("pipeline_runs").filter(F.col("run_id") == run_id),
            self.table("stage_metrics").filter(F.col("run_id") == run_id),
            self.table("quality_results").filter(F.col("run_id") == run_id),
        ]
        one[0] = fold_patches(one[0], ["run_id"], "_seq")
        return run_detail(*one)

    def lineage(self, run_id: str) -> DataFrame:
        return run_lineage(self.table("pipeline_runs"), self.table("dataset_versions"), run_id)

    def datasets(self) -> DataFrame:
        return latest_versions(self.table("dataset_versions"))

    def quality(self, dataset: str, limit: int = QUALITY_HISTORY_ROWS) -> DataFrame:
        return quality_history(
            self.table("quality_results"),
            self.table("pipeline_runs"),
            self.table("dataset_versions"),
            dataset,
            limit,
        )


def now() -> datetime:
    return datetime.now(timezone.utc)
