"""Run lists, details, lineage, versions, quality history, upserts and guards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.temporal import first_of_month
from stratalake.functions.text import (
    left_ellipsis,
    partition_key,
    plain_dsn,
    to_s3a,
    uri_bucket,
    uri_key,
)
from stratalake.operators.latest import newest_first, top_per_key
from stratalake.operators.merge import coalesce_update, fold_patches, insert_absent, upsert_latest
from stratalake.plans import metadata as md
from workload import query
from workload.tables import (
    RESULTS,
    RUNS,
    STAGES,
    VERSIONS,
    iso,
    iso_ts,
    results,
    runs,
    stages,
    table,
    versions,
)

_RUN_COLUMNS = (
    f"run_id, pipeline_name, source, {iso('run_date')}, {iso_ts('started_at')}, "
    f"{iso_ts('ended_at')}, status, records_ingested, records_rejected"
)


@query(
    "runs_list",
    f"WITH {RUNS}, newest AS (SELECT * FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 20) "
    f"SELECT {_RUN_COLUMNS} FROM newest",
)
def _runs_list(spark: SparkSession, sf: str) -> DataFrame:
    return md.list_runs(runs(spark, sf))


@query(
    "runs_list_by_source",
    f"WITH {RUNS}, newest AS (SELECT * FROM runs WHERE source = '1-URGENT' "
    f"ORDER BY started_at DESC, run_id DESC LIMIT 100) SELECT {_RUN_COLUMNS} FROM newest",
)
def _runs_list_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return md.list_runs(runs(spark, sf), "1-URGENT", 100)


@query(
    "runs_newest_per_source",
    f"WITH {RUNS}, newest AS (SELECT * FROM runs QUALIFY row_number() OVER "
    f"(PARTITION BY source ORDER BY started_at DESC, run_id DESC) <= 20) "
    f"SELECT {_RUN_COLUMNS} FROM newest",
)
def _runs_newest_per_source(spark: SparkSession, sf: str) -> DataFrame:
    return top_per_key(runs(spark, sf), ["source"], newest_first(["started_at", "run_id"]), 20)


def _joined(entries: F.Column) -> F.Column:
    """Nested lists as one text column, for comparison."""
    return F.array_join(entries, ";")


@query(
    "run_detail",
    f"""
    WITH {RUNS}, {STAGES}, {RESULTS},
    s AS (SELECT run_id, count(*) AS n_stages, string_agg(
            strftime(started_at, '%Y-%m-%d') || '/' || stage_name || '/' || input_rows || '/'
              || output_rows, ';' ORDER BY started_at, id) AS stages
          FROM stages GROUP BY run_id),
    q AS (SELECT run_id, count(*) AS n_results, string_agg(
            check_name || '/' || passed || '/' || failed_count, ';' ORDER BY id) AS results
          FROM results GROUP BY run_id)
    SELECT run_id, source, status, coalesce(n_stages, 0) AS n_stages,
           coalesce(n_results, 0) AS n_results, coalesce(stages, '') AS stages,
           coalesce(results, '') AS results
    FROM runs LEFT JOIN s USING (run_id) LEFT JOIN q USING (run_id)""",
)
def _run_detail(spark: SparkSession, sf: str) -> DataFrame:
    nested = md.run_detail(runs(spark, sf), stages(spark, sf), results(spark, sf))

    def stage(s: F.Column) -> F.Column:
        day = F.date_format(s["started_at"], "yyyy-MM-dd")
        return F.concat_ws("/", day, s["stage_name"], s["input_rows"], s["output_rows"])

    def result(r: F.Column) -> F.Column:
        return F.concat_ws("/", r["check_name"], r["passed"].cast("string"), r["failed_count"])

    return nested.select(
        "run_id",
        "source",
        "status",
        F.size("stage_metrics").cast("bigint").alias("n_stages"),
        F.size("quality_results").cast("bigint").alias("n_results"),
        _joined(F.transform("stage_metrics", stage)).alias("stages"),
        _joined(F.transform("quality_results", result)).alias("results"),
    )


@query(
    "run_detail_rows",
    f"""
    WITH {RUNS}, {STAGES}
    SELECT runs.run_id, source, status, stage_name, input_rows, output_rows
    FROM runs LEFT JOIN stages USING (run_id)""",
)
def _run_detail_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = md.run_detail_rows(runs(spark, sf), stages(spark, sf))
    return rows.select("run_id", "source", "status", "stage_name", "input_rows", "output_rows")


@query(
    "run_lineage",
    f"WITH {RUNS}, {VERSIONS} SELECT run_id, source, {iso('run_date')}, dataset_name, row_count, "
    "s3_path FROM runs JOIN versions USING (run_id)",
)
def _run_lineage(spark: SparkSession, sf: str) -> DataFrame:
    return md.run_lineage(runs(spark, sf), versions(spark, sf))


@query(
    "latest_version",
    f"""
    WITH {VERSIONS}
    SELECT id, run_id, dataset_name, partition_key, row_count, schema_hash, s3_path,
           {iso_ts('created_at')}
    FROM (SELECT DISTINCT ON (dataset_name) * FROM versions
          ORDER BY dataset_name, created_at DESC, id DESC, run_id DESC, partition_key DESC,
                   row_count DESC, schema_hash DESC, s3_path DESC)""",
)
def _latest_version(spark: SparkSession, sf: str) -> DataFrame:
    return md.latest_versions(versions(spark, sf))


@query("dataset_names", f"WITH {VERSIONS} SELECT DISTINCT dataset_name FROM versions")
def _dataset_names(spark: SparkSession, sf: str) -> DataFrame:
    return versions(spark, sf).select("dataset_name").distinct()


_QUALITY = f"""
WITH {RUNS}, {RESULTS}, {VERSIONS},
wrote AS (SELECT DISTINCT dataset_name, run_id FROM versions),
history AS (
  SELECT dataset_name, results.run_id, results.id, check_name, passed, failed_count, threshold,
         ended_at
  FROM results JOIN runs ON runs.run_id = results.run_id AND status = 'SUCCESS'
       JOIN wrote ON wrote.run_id = results.run_id)"""
_QUALITY_COLUMNS = (
    "dataset_name, run_id, id, check_name, passed, failed_count, threshold, " + iso_ts("ended_at")
)


@query(
    "quality_history",
    f"{_QUALITY}, top AS (SELECT * FROM history WHERE dataset_name = 'dataset_1' "
    "ORDER BY ended_at DESC, run_id DESC, id DESC LIMIT 20) "
    f"SELECT {_QUALITY_COLUMNS} FROM top",
)
def _quality_history(spark: SparkSession, sf: str) -> DataFrame:
    return md.quality_history(results(spark, sf), runs(spark, sf), versions(spark, sf), "dataset_1")


@query(
    "quality_history_per_dataset",
    f"{_QUALITY}, top AS (SELECT * FROM history QUALIFY row_number() OVER "
    "(PARTITION BY dataset_name ORDER BY ended_at DESC, run_id DESC, id DESC) <= 20) "
    f"SELECT {_QUALITY_COLUMNS} FROM top",
)
def _quality_history_per_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return md.quality_history_per_dataset(
        results(spark, sf), runs(spark, sf), versions(spark, sf)
    )


@query(
    "quality_latest",
    f"{_QUALITY}, last AS (SELECT run_id FROM history WHERE dataset_name = 'dataset_2' "
    "ORDER BY ended_at DESC, run_id DESC LIMIT 1) "
    "SELECT run_id, id, check_name, passed, failed_count FROM history JOIN last USING (run_id) "
    "WHERE dataset_name = 'dataset_2'",
)
def _quality_latest(spark: SparkSession, sf: str) -> DataFrame:
    rows = md.quality_latest(results(spark, sf), runs(spark, sf), versions(spark, sf), "dataset_2")
    return rows.select("run_id", "id", "check_name", "passed", "failed_count")


# ---------------------------------------------------------------- upserts


def _order_state(spark: SparkSession, sf: str) -> DataFrame:
    """Latest state per customer is to be kept: closed orders stored, the others incoming."""
    return table(spark, sf, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice"
    )


_STATE = "o_custkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate, o_orderkey, o_orderstatus, o_totalprice"


@query(
    "upsert_latest",
    f"SELECT {_STATE} FROM (SELECT * FROM orders QUALIFY row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)",
)
def _upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    state = _order_state(spark, sf)
    stored, incoming = state.filter("o_orderstatus = 'F'"), state.filter("o_orderstatus <> 'F'")
    return upsert_latest(stored, incoming, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "insert_absent",
    f"SELECT {_STATE} FROM (SELECT * FROM orders WHERE o_orderstatus <> 'F' AND o_custkey NOT IN "
    "(SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') QUALIFY row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1)",
)
def _insert_absent(spark: SparkSession, sf: str) -> DataFrame:
    state = _order_state(spark, sf)
    stored, incoming = state.filter("o_orderstatus = 'F'"), state.filter("o_orderstatus <> 'F'")
    return insert_absent(stored, incoming, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "coalesce_update",
    """
    WITH patch AS (
      SELECT l_orderkey AS o_orderkey, max(l_extendedprice) AS o_totalprice,
             CASE WHEN count(*) > 4 THEN 'X' END AS o_orderstatus
      FROM lineitem GROUP BY 1)
    SELECT o.o_orderkey, coalesce(p.o_totalprice, o.o_totalprice) AS o_totalprice,
           coalesce(p.o_orderstatus, o.o_orderstatus) AS o_orderstatus
    FROM orders o LEFT JOIN patch p USING (o_orderkey)""",
)
def _coalesce_update(spark: SparkSession, sf: str) -> DataFrame:
    patch = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.max("l_extendedprice").alias("o_totalprice"),
            F.when(F.count(F.lit(1)) > 4, "X").alias("o_orderstatus"),
        )
    )
    target = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return coalesce_update(target, patch, ["o_orderkey"])


@query(
    "fold_patches",
    """
    SELECT user_id, arg_max(event_type, event_id) AS event_type,
           arg_max(value, event_id) FILTER (WHERE value <= 50) AS small_value
    FROM events GROUP BY user_id""",
)
def _fold_patches(spark: SparkSession, sf: str) -> DataFrame:
    log = table(spark, sf, "events").select(
        "user_id", "event_type", F.when(F.col("value") <= 50, F.col("value")).alias("small_value"),
        "event_id",
    )
    return fold_patches(log, ["user_id"], "event_id")


# ---------------------------------------------------------------- batch planning and paths

_SOURCES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

_PLANNED = """
planned AS (
  SELECT DISTINCT source, CAST(batch_date AS DATE) AS batch_date
  FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                      date_trunc('month', max(l_shipdate)), INTERVAL 1 MONTH))
               AS batch_date
        FROM (SELECT min(o_orderdate) AS o_orderdate FROM orders),
             (SELECT max(l_shipdate) AS l_shipdate FROM lineitem)),
       (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) s(source))"""


def _planned(spark: SparkSession, sf: str) -> DataFrame:
    """Months from the first order to the last shipment, per order priority."""
    first = table(spark, sf, "orders").agg(F.min("o_orderdate").alias("start"))
    last = table(spark, sf, "lineitem").agg(F.max("l_shipdate").alias("end"))
    bounds = first.select("start", last.scalar().alias("end"))
    return md.planned_batches(bounds, _SOURCES)


def _processed(spark: SparkSession, sf: str) -> DataFrame:
    """Batches that have a closed order."""
    closed = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    month = first_of_month(F.col("o_orderdate"))
    return closed.select(F.col("o_orderpriority").alias("source"), month.alias("batch_date")).distinct()


@query(
    "batch_guard",
    f"WITH {_PLANNED} SELECT source, {iso('batch_date')} FROM planned WHERE NOT EXISTS "
    "(SELECT 1 FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = source "
    "AND date_trunc('month', o_orderdate) = batch_date)",
)
def _batch_guard(spark: SparkSession, sf: str) -> DataFrame:
    return md.pending_batches(_planned(spark, sf), _processed(spark, sf))


@query("batch_backfill", f"WITH {_PLANNED} SELECT source, {iso('batch_date')} FROM planned")
def _batch_backfill(spark: SparkSession, sf: str) -> DataFrame:
    return md.pending_batches(_planned(spark, sf), _processed(spark, sf), backfill=True)


@query(
    "partition_path",
    """
    WITH paths AS (
      SELECT o_orderkey, o_orderdate,
             CASE o_orderstatus WHEN 'F' THEN 's3a://lake/' WHEN 'O' THEN 's3://lake/' ELSE '' END
               || 'bronze/' || o_orderpriority || '/' || strftime(o_orderdate, 'year=%Y/month=%m')
               || '/' || o_orderkey || '.parquet' AS raw
      FROM orders),
    uris AS (
      SELECT *, CASE WHEN raw LIKE 's3a://%' THEN raw WHEN raw LIKE 's3://%'
                THEN 's3a' || raw[3:] ELSE 's3a://lake/' || raw END AS uri
      FROM paths)
    SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS batch_date,
           strftime(o_orderdate, 'year=%Y/month=%m') AS partition_key, uri,
           split_part(uri, '/', 3) AS bucket, uri[12:] AS object_key,
           CASE WHEN length(uri) > 48 THEN '…' || right(uri, 45) ELSE uri END AS shown,
           'postgresql://host/' || o_orderkey AS dsn
    FROM uris""",
)
def _partition_path(spark: SparkSession, sf: str) -> DataFrame:
    key = partition_key(F.col("o_orderdate"))
    status = F.col("o_orderstatus")
    prefix = F.when(status == "F", "s3a://lake/").when(status == "O", "s3://lake/").otherwise("")
    raw = F.concat(
        prefix, F.lit("bronze/"), "o_orderpriority", F.lit("/"), key, F.lit("/"), "o_orderkey",
        F.lit(".parquet"),
    )
    dsn = F.concat(F.lit("postgresql+asyncpg://host/"), "o_orderkey")
    uris = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", key.alias("partition_key"), to_s3a(raw, "lake").alias("uri"),
        plain_dsn(dsn, "asyncpg").alias("dsn"),
    )
    return uris.select(
        "o_orderkey",
        first_of_month(F.col("o_orderdate")).alias("batch_date"),
        "partition_key",
        "uri",
        uri_bucket(F.col("uri")).alias("bucket"),
        uri_key(F.col("uri")).alias("object_key"),
        left_ellipsis(F.col("uri")).alias("shown"),
        "dsn",
    )
