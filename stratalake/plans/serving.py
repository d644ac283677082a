"""Read side: latest snapshots, their metadata, charts and run tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.constants import GOLD_DATASETS, LOCAL_ZONE
from stratalake.functions.numeric import fixed2, grouped_integer
from stratalake.functions.temporal import (
    duration_text,
    iso_text,
    iso_timestamp_text,
    local_time_text,
)
from stratalake.functions.text import left_ellipsis, prefix8
from stratalake.layout import Lake, folder_exists
from stratalake.operators.filters import allowed
from stratalake.operators.latest import newest, newest_first
from stratalake.operators.monthly import monthly_trend
from stratalake.sources.evolved import read_evolved


class NoSnapshot(LookupError):
    """The dataset is known but has nothing to serve."""


def latest_meta(versions: DataFrame, dataset: str) -> DataFrame:
    """Newest version record of a dataset with times as ISO text; no data is read."""
    allowed(dataset, GOLD_DATASETS)
    rows = versions.filter(F.col("dataset_name") == dataset)
    latest = newest(rows, newest_first(["created_at", "id"]), 1)
    return latest.withColumn("created_at", iso_timestamp_text(F.col("created_at")))


def read_snapshot(spark: SparkSession, lake: Lake, path: str) -> DataFrame:
    """All part files below a snapshot folder, partition columns included.

    Part files of different schemas are united by name, under the least common types.
    """
    folder = lake.path(path)
    rows = read_evolved(spark, folder, [folder]) if folder_exists(spark, folder) else None
    if rows is None:
        raise NoSnapshot(f"{path} cannot be read")
    return rows


def latest_snapshot(spark: SparkSession, lake: Lake, versions: DataFrame, dataset: str) -> DataFrame:
    """Rows of the newest snapshot of a dataset.

    The version record names the snapshot's folder, so only that folder is listed and read.
    """
    record = latest_meta(versions, dataset).select("s3_path").first()
    if record is None:
        raise NoSnapshot(f"no version of {dataset} is recorded yet")
    if not record.s3_path:
        raise NoSnapshot(f"the latest version of {dataset} has no data")
    return read_snapshot(spark, lake, record.s3_path)


def as_json_rows(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text, ready for a JSON response."""
    rendered = {}
    for name, kind in df.dtypes:
        if kind == "date":
            rendered[name] = iso_text(F.col(name))
        elif kind.startswith("timestamp"):
            rendered[name] = iso_timestamp_text(F.col(name))
    return df.withColumns(rendered) if rendered else df


def trend_of_latest(spark: SparkSession, lake: Lake, versions: DataFrame) -> DataFrame:
    """The monthly chart over the newest snapshots of both datasets."""
    macro, fx = (latest_snapshot(spark, lake, versions, d) for d in GOLD_DATASETS)
    return monthly_trend(macro, fx)


def run_table(runs: DataFrame, zone: str = LOCAL_ZONE, stored_zone: str | None = None) -> DataFrame:
    """Run list as displayed."""
    rejected = F.coalesce(F.col("records_rejected"), F.lit(0))
    return runs.select(
        "run_id",
        iso_text(F.col("run_date")).alias("run_date"),
        "source",
        "status",
        grouped_integer(F.col("records_ingested")).alias("ingested"),
        grouped_integer(F.col("records_rejected")).alias("rejected"),
        (rejected > 0).alias("has_rejects"),
        duration_text(F.col("started_at"), F.col("ended_at")).alias("duration"),
        local_time_text(F.col("started_at"), zone, stored_zone).alias("started_local"),
    )


def stage_table(stages: DataFrame) -> DataFrame:
    return stages.select(
        "run_id",
        "stage_name",
        fixed2(F.col("duration_seconds")).alias("duration"),
        grouped_integer(F.col("input_rows")).alias("input_rows"),
        grouped_integer(F.col("output_rows")).alias("output_rows"),
    )


def version_table(versions: DataFrame) -> DataFrame:
    return versions.select(
        "dataset_name",
        "partition_key",
        grouped_integer(F.col("row_count")).alias("row_count"),
        prefix8(F.col("schema_hash")).alias("schema_hash"),
        left_ellipsis(F.col("s3_path")).alias("s3_path"),
    )
