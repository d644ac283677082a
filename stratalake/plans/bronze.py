"""Landing: stamp, fingerprint, skip known content, write bronze."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.digest import fingerprint, row_digest
from stratalake.layout import (
    Lake,
    batch_folder,
    delete_folder,
    first_day,
    folder_exists,
    folder_size,
    move_folder,
)
from stratalake.operators.columns import project, stamp
from stratalake.plans.metadata import MetadataStore, now
from stratalake.schemas import get_bronze_schema, record_schema
from stratalake.sinks import write_partitioned

#: Fixed value: how Spark names the partition folder of NULL.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def make_batch_id() -> str:
    return str(uuid.uuid4())


def stamped(records: DataFrame, fetched_at: datetime | Column, batch_id: str | Column) -> DataFrame:
    """Records plus the two landing columns."""
    return stamp(records, {"fetched_at": fetched_at, "batch_id": batch_id}).withColumn(
        "fetched_at", F.col("fetched_at").cast("timestamp")
    )


def bronze_schema(source: str):
    """Registered bronze schema, or the record schema plus the landing columns."""
    try:
        return get_bronze_schema(source)
    except KeyError:
        return record_schema(source).add("fetched_at", "timestamp").add("batch_id", "string")


@dataclass(frozen=True)
class Content:
    """Records of one batch month as they are stored in the pending folder."""

    day: date
    row_count: int
    sha256_hash: str


class PendingBatch:
    """Records written once to a folder that no reader of bronze sees, to be committed or discarded.

    The source is evaluated by that write alone. What is fingerprinted, counted and committed is
    what was stored, so a source that gives other rows each time it is evaluated cannot land rows
    that its manifest entry does not describe. Committing renames folders.

    A commit announces its paths in the manifest, renames, then confirms. If it is interrupted, the
    next landing of the same content finds the announced folder and confirms that one.
    """

    def __init__(
        self,
        lake: Lake,
        store: MetadataStore,
        source: str,
        records: DataFrame,
        batch_date: Column,
        fetched_at: datetime | None = None,
        batch_id: str | None = None,
    ) -> None:
        self.lake, self.store, self.source, self.spark = lake, store, source, store.spark
        self.fetched_at, self.batch_id = fetched_at or now(), batch_id or make_batch_id()
        self.folder = f"{lake.bronze(source)}/_pending/{uuid.uuid4().hex}"
        rows = stamped(records, self.fetched_at, self.batch_id).withColumns(
            {
                "year": F.lpad(F.year(batch_date).cast("string"), 4, "0"),
                "month": F.lpad(F.month(batch_date).cast("string"), 2, "0"),
            }
        )
        self._schema = bronze_schema(source)
        columns = [f.name for f in self._schema.fields if f.name != "batch_id"]
        try:
            write_partitioned(rows.select(*columns, "year", "month"), self.folder, ["year", "month"])
        except Exception:
            self._record([{"fetch_date": None, "status": "FAILED"}])
            self.discard()
            raise

    def rows(self) -> DataFrame:
        """The stored rows; ``year`` and ``month`` are NULL where there was no batch date."""
        schema = self._schema.add("year", "string").add("month", "string")
        return self.spark.read.schema(schema).parquet(self.folder)

    def contents(self) -> list[Content]:
        """One per batch month, by month."""
        fields = record_schema(self.source).fieldNames()
        by_month = fingerprint(self.rows().filter("year IS NOT NULL"), fields, ["year", "month"])
        found = [
            Content(date(int(r.year), int(r.month), 1), r.row_count, r.sha256_hash)
            for r in by_month.collect()
        ]
        return sorted(found, key=lambda content: content.day)

    def commit(self, contents: Sequence[Content], fetch_dates: Mapping[date, date] = {}) -> dict[str, str]:
        """Path per content. One that has landed before, under whatever month, keeps its path."""
        known = self.store.landed_paths(self.source, {c.sha256_hash for c in contents})
        paths = {}
        fresh: dict[str, Content] = {}
        for content in contents:
            path = known.get(content.sha256_hash)
            if path is None and content.sha256_hash not in fresh:
                fresh[content.sha256_hash] = content
                path = f"{self.lake.bronze(self.source)}/{batch_folder(content.day)}/batch_id={self.batch_id}"
            if path is not None:
                paths.setdefault(content.sha256_hash, path)
        entries = [
            {
                "fetch_date": fetch_dates.get(content.day, content.day),
                "file_path": paths[digest],
                "sha256_hash": digest,
                "status": "PENDING",
            }
            for digest, content in fresh.items()
        ]
        if entries:
            self._record(entries)
            for digest, content in fresh.items():
                move_folder(self.spark, f"{self.folder}/{batch_folder(content.day)}", paths[digest])
            self._record(
                [
                    {**e, "status": "SUCCESS", "byte_size": folder_size(self.spark, e["file_path"])}
                    for e in entries
                ]
            )
        return paths

    def set_aside(self, folder: str) -> bool:
        """Move the rows without a batch date to ``folder``; False if there are none."""
        none = f"{self.folder}/year={_NO_VALUE}/month={_NO_VALUE}"
        if not folder_exists(self.spark, none):
            return False
        move_folder(self.spark, none, folder)
        return True

    def discard(self) -> None:
        """Remove what has not been committed."""
        delete_folder(self.spark, self.folder)

    def _record(self, entries: Sequence[dict]) -> None:
        about = {"source": self.source, "batch_id": self.batch_id, "fetched_at": self.fetched_at}
        self.store.write("file_manifest", [{**about, **entry} for entry in entries])


def land(
    lake: Lake,
    store: MetadataStore,
    source: str,
    records: DataFrame,
    run_date: date,
    fetched_at: datetime | None = None,
    batch_id: str | None = None,
) -> str:
    """Write a batch to bronze and return its path; the same content lands only once.

    The fingerprint covers the records alone. The landing time and the batch id differ on every
    fetch and would make every content look new.
    """
    typed, day = project(records, record_schema(source)), first_day(run_date)
    pending = PendingBatch(lake, store, source, typed, F.lit(day), fetched_at, batch_id)
    try:
        contents = pending.contents()
        if not contents:
            raise ValueError("an empty record set cannot be landed")
        return pending.commit(contents, {day: run_date})[contents[0].sha256_hash]
    finally:
        pending.discard()


def read_bronze(store: MetadataStore, source: str, *paths: str) -> DataFrame:
    """Bronze rows with ``year`` and ``month`` as text; ``paths`` narrow to landed batches."""
    lake = store.lake
    schema = bronze_schema(source).add("year", "integer").add("month", "integer")
    reader = store.spark.read.schema(schema).option("basePath", lake.bronze(source))
    rows = reader.parquet(*(paths or [lake.bronze(source)]))
    return rows.withColumns(
        {
            "year": F.col("year").cast("string"),
            "month": F.lpad(F.col("month").cast("string"), 2, "0"),
        }
    )


def content_digests(df: DataFrame, row_id: str, scope: Sequence[str], business: Sequence[str]) -> DataFrame:
    """``row_id, scope..., sha256_hash``: all that deduplication needs of a wide row."""
    return df.select(row_id, *scope, row_digest(business).alias("sha256_hash"))


def first_copies(digests: DataFrame, row_id: str, scope: Sequence[str]) -> DataFrame:
    """Give every row the least id of equal content: ``..., first_<row_id>``.

    The least id is an aggregate that is joined back: a content with very many copies is one row
    after the map side, and adaptive execution splits its copies over several tasks in the join.
    ``digests`` is read twice, so stage it if computing it means reading wide rows.
    """
    keys = [*scope, "sha256_hash"]
    firsts = digests.groupBy(*keys).agg(F.min(row_id).alias(f"first_{row_id}"))
    return digests.join(firsts, keys)


def resolve_paths(new: DataFrame, manifest: DataFrame) -> DataFrame:
    """Existing path of a content if it has landed before, else its planned path."""
    landed = manifest.select("source", "sha256_hash", F.col("file_path").alias("_existing"))
    joined = new.join(landed, ["source", "sha256_hash"], "left")
    return joined.withColumns(
        {
            "is_duplicate": F.col("_existing").isNotNull(),
            "file_path": F.coalesce("_existing", "file_path"),
        }
    ).drop("_existing")
