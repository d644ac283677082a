"""Displayed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratalake.plans.serving import run_table, stage_table, version_table
from workload import query
from workload.tables import RUNS, STAGES, VERSIONS, runs, stages, versions


@query(
    "run_presentation",
    f"""
    WITH {RUNS},
    timed AS (SELECT *, CAST(epoch(ended_at) - epoch(started_at) AS BIGINT) AS s FROM runs)
    SELECT run_id, strftime(run_date, '%Y-%m-%d') AS run_date, source, status,
           format('{{:,}}', records_ingested) AS ingested,
           format('{{:,}}', records_rejected) AS rejected,
           records_rejected > 0 AS has_rejects,
           CASE WHEN ended_at IS NULL THEN 'in progress'
                WHEN s >= 60 THEN (s // 60) || 'm ' || (s % 60) || 's'
                ELSE s || 's' END AS duration,
           strftime(started_at + INTERVAL 8 HOUR, '%b %-d, %Y, %-I:%M %p') AS started_local
    FROM timed""",
)
def _run_presentation(spark: SparkSession, sf: str) -> DataFrame:
    return run_table(runs(spark, sf), stored_zone="UTC")


@query(
    "stage_presentation",
    f"WITH {STAGES} SELECT run_id, stage_name, printf('%.2f', duration_seconds) AS duration, "
    "format('{:,}', input_rows) AS input_rows, format('{:,}', output_rows) AS output_rows "
    "FROM stages",
)
def _stage_presentation(spark: SparkSession, sf: str) -> DataFrame:
    return stage_table(stages(spark, sf))


@query(
    "version_presentation",
    f"WITH {VERSIONS} SELECT dataset_name, partition_key, format('{{:,}}', row_count) AS row_count, "
    "left(schema_hash, 8) AS schema_hash, CASE WHEN length(s3_path) > 48 "
    "THEN '…' || right(s3_path, 45) ELSE s3_path END AS s3_path FROM versions",
)
def _version_presentation(spark: SparkSession, sf: str) -> DataFrame:
    return version_table(versions(spark, sf))
