"""Write paths: each query writes into a fresh shared folder and returns what is read back."""

from __future__ import annotations

from datetime import date, datetime, time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.contracts import load_contract
from stratalake.layout import Lake, readable
from stratalake.plans.bronze import land, read_bronze
from stratalake.plans.gold import Batch, batch_columns, publish
from stratalake.plans.metadata import MetadataStore
from stratalake.plans.monthly_run import run_backfill, run_month
from stratalake.plans.serving import latest_snapshot
from stratalake.plans.silver import fx_silver
from stratalake.schemas import schema_hash
from stratalake.session import shared_folder, staged
from stratalake.sinks import write_partitioned, write_snapshots
from workload import query
from workload.tables import (
    FX_BRONZE,
    SHIP_MONTHLY,
    SHIP_SILVER,
    fx_bronze,
    iso,
    ship_bronze,
    ship_monthly,
    table,
)

_JANUARY, _FEBRUARY = date(2024, 1, 1), date(2024, 2, 1)


def metadata_store(spark: SparkSession, purpose: str) -> MetadataStore:
    return MetadataStore(spark, Lake(shared_folder(spark, purpose)))


@query(
    "bronze_landing",
    f"WITH {FX_BRONZE} SELECT rate_date, currency_pair, rate, source, 'batch-1' AS batch_id, "
    "'2024' AS year, '02' AS month, 'true' AS landed_once FROM fx_bronze",
)
def _bronze_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Land a batch, land the same content again in another order: one batch, one path."""
    store = metadata_store(spark, "bronze-landing")
    records = fx_bronze(spark, sf).drop("fetched_at", "batch_id")
    first = land(store.lake, store, "bsp_fx", records, date(2024, 2, 15), batch_id="batch-1")
    again = land(
        store.lake, store, "bsp_fx", records.orderBy("rate"), date(2024, 3, 1), batch_id="batch-2"
    )
    once = F.lit(str(first == again).lower())
    return read_bronze(store, "bsp_fx").drop("fetched_at").withColumn("landed_once", once)


@query(
    "silver_partitions",
    f"WITH {SHIP_SILVER} SELECT {iso('period_date')}, rate, "
    "CAST(year(period_date) AS INTEGER) AS period_year, "
    "CAST(month(period_date) AS INTEGER) AS period_month FROM ship_silver",
)
def _silver_partitions(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark, "silver-partitions")
    silver = fx_silver(ship_bronze(spark, sf))
    dated = silver.withColumns(
        {"period_year": F.year("period_date"), "period_month": F.month("period_date")}
    )
    write_partitioned(dated, folder, ["period_year", "period_month"], ["period_date"])
    return spark.read.parquet(folder).select("period_date", "rate", "period_year", "period_month")


_PUBLISHED = f"""
WITH {FX_BRONZE},
judged AS (
  SELECT CAST(rate_date AS DATE) AS period, currency_pair, rate, source,
         coalesce(rate BETWEEN 0.0001 AND 1000000, false)
           AND (SELECT count(*) FROM fx_bronze) >= 20 AS is_valid
  FROM fx_bronze)"""


@query(
    "gold_publish",
    f"{_PUBLISHED} SELECT {iso('period')}, currency_pair, rate, source, "
    "CASE WHEN is_valid THEN 'gold' ELSE 'quarantine' END AS stored_in FROM judged",
)
def _gold_publish(spark: SparkSession, sf: str) -> DataFrame:
    """All raw rates through the contract: gold and quarantine together are the input."""
    lake = Lake(shared_folder(spark, "gold-publish"))
    rows = fx_bronze(spark, sf).withColumn("period_date", F.to_date("rate_date"))
    contract = load_contract("gold_exchange_rates")
    outcome = publish(
        lake, batch_columns(rows, _JANUARY), contract, [Batch(_JANUARY, "run-1")]
    ).outcomes[0]
    columns = list(contract.schema)
    gold = spark.read.parquet(outcome.gold_path).select(*columns, F.lit("gold").alias("stored_in"))
    kept = spark.read.parquet(outcome.quarantine_path)
    return gold.unionByName(kept.select(*columns, F.lit("quarantine").alias("stored_in")))


@query(
    "quality_record",
    f"{_PUBLISHED} SELECT 'run-1' AS run_id, check_name, failed_count = 0 AS passed, failed_count, "
    "CAST(0.05 AS DOUBLE) AS threshold FROM (SELECT "
    "count(*) FILTER (WHERE rate IS NULL) AS no_nulls, CAST(0 AS BIGINT) AS row_count_min, "
    "count(*) FILTER (WHERE NOT coalesce(rate BETWEEN 0.0001 AND 1000000, false)) AS value_range "
    "FROM judged) UNPIVOT (failed_count FOR check_name IN (no_nulls, row_count_min, value_range))",
)
def _quality_record(spark: SparkSession, sf: str) -> DataFrame:
    store = metadata_store(spark, "quality-record")
    rows = fx_bronze(spark, sf).withColumn("period_date", F.to_date("rate_date"))
    published = publish(
        store.lake,
        batch_columns(rows, _JANUARY),
        load_contract("gold_exchange_rates"),
        [Batch(_JANUARY, "run-1")],
    )
    store.write("quality_results", published.results)
    return store.table("quality_results").drop("id")


@query(
    "snapshot_latest",
    f"WITH {SHIP_MONTHLY} SELECT strftime(period_date, '%Y-%m-%d') AS period, currency_pair, "
    "rate, source FROM ship_monthly WHERE period_date < DATE '2000-01-01'",
)
def _snapshot_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Two snapshots, the newer one shorter; the newer one is served."""
    store = metadata_store(spark, "snapshot-latest")
    silver = staged(fx_silver(ship_monthly(spark, sf)), "snapshot-silver")
    contract = load_contract("gold_exchange_rates")
    shorter = silver.filter(F.col("period_date") < date(2000, 1, 1))
    for day, rows in ((_JANUARY, silver), (_FEBRUARY, shorter)):
        outcome = publish(store.lake, batch_columns(rows, day), contract, [Batch(day, "r")]).outcomes[0]
        store.write(
            "dataset_versions",
            [
                {
                    "run_id": "r",
                    "dataset_name": contract.dataset,
                    "partition_key": f"year=2024/month={day.month:02d}",
                    "row_count": outcome.clean,
                    "schema_hash": outcome.schema_hash,
                    "s3_path": outcome.gold_path,
                    "created_at": datetime.combine(day, time()),
                }
            ],
        )
    return latest_snapshot(spark, store.lake, store.table("dataset_versions"), contract.dataset)


@query(
    "backfill_overwrite",
    """
    WITH months AS (
      SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, o_orderkey,
             o_orderstatus, o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'
               AS redone
      FROM orders)
    SELECT year, month, o_orderkey, redone AS rewritten FROM months
    WHERE NOT redone OR o_orderstatus = 'F'""",
)
def _backfill_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """All months written, then the months of 1997 replaced by fewer rows in one job.

    Partitions by status that the new version no longer has must be gone, other years untouched.
    """
    folder = shared_folder(spark, "backfill-overwrite")
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_orderdate",
        F.lit(False).alias("rewritten"),
        F.date_format("o_orderdate", "yyyy").alias("year"),
        F.date_format("o_orderdate", "MM").alias("month"),
    )
    write_snapshots(rows, folder, [], ["o_orderstatus"])
    again = rows.filter("year = '1997' AND o_orderstatus = 'F'").withColumn("rewritten", F.lit(True))
    write_snapshots(again, folder, [date(1997, m, 1) for m in range(1, 13)], ["o_orderstatus"])
    stored = spark.read.parquet(folder)
    return stored.select(
        F.col("year").cast("string").alias("year"),
        F.lpad(F.col("month").cast("string"), 2, "0").alias("month"),
        "o_orderkey",
        "rewritten",
    )


@query(
    "backfill_chain",
    """
    WITH months AS (
      SELECT CAST(unnest(generate_series(date_trunc('month', (SELECT min(l_shipdate) FROM lineitem)),
               date_trunc('month', (SELECT max(l_shipdate) FROM lineitem)), INTERVAL 1 MONTH))
             AS DATE) AS run_date),
    pairs AS (
      SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS run_date,
             count(DISTINCT l_suppkey) AS n
      FROM lineitem GROUP BY 1),
    judged AS (SELECT run_date, coalesce(n, 0) AS n FROM months LEFT JOIN pairs USING (run_date))
    SELECT strftime(run_date, '%Y-%m-%d') AS run_date, 'bsp_fx' AS source,
           CASE WHEN n >= 20 THEN 'SUCCESS' WHEN n = 0 THEN 'FAILED' ELSE 'PARTIAL' END AS status,
           CASE WHEN n >= 20 THEN n ELSE 0 END AS records_ingested,
           CASE WHEN n >= 20 THEN 0 ELSE n END AS records_rejected
    FROM judged""",
)
def _backfill_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Every shipping month as a batch of its own through landing, silver, checks and gold."""
    store = metadata_store(spark, "backfill-chain")
    records = ship_monthly(spark, sf).drop("fetched_at", "batch_id")
    bounds = records.agg(F.min("rate_date").alias("first"), F.max("rate_date").alias("last")).first()
    start, end = date.fromisoformat(bounds.first), date.fromisoformat(bounds.last)
    run_backfill(store, "bsp_fx", records, start, end, batch_date="rate_date")
    return store.table("pipeline_runs").select(
        "run_date", "source", "status", "records_ingested", "records_rejected"
    )


@query(
    "backfill_empty_month",
    """
    WITH pairs AS (
      SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_suppkey,
             max(l_extendedprice) AS rate
      FROM lineitem GROUP BY ALL),
    published AS (
      SELECT month, count(*) AS rows, sum(rate) AS rates FROM pairs GROUP BY 1 HAVING count(*) >= 20)
    SELECT strftime(month, '%Y-%m-%d') AS month, rows, round(rates, 2) AS rates,
           CASE WHEN year(month) = 1996 THEN 1 ELSE 2 END AS versions
    FROM published""",
)
def _backfill_empty_month(spark: SparkSession, sf: str) -> DataFrame:
    """Every shipping month published, then all redone from records that lack 1996.

    The gold of 1996 stays as it was, without a second version.
    """
    store = metadata_store(spark, "backfill-empty-month")
    records = ship_monthly(spark, sf).drop("fetched_at", "batch_id")
    bounds = records.agg(F.min("rate_date").alias("first"), F.max("rate_date").alias("last")).first()
    span = date.fromisoformat(bounds.first), date.fromisoformat(bounds.last)
    run_backfill(store, "bsp_fx", records, *span, batch_date="rate_date")
    lacking = records.filter(~F.col("rate_date").startswith("1996"))
    run_backfill(store, "bsp_fx", lacking, *span, batch_date="rate_date")
    folder = store.lake.gold("gold_exchange_rates")
    if readable(spark, folder):
        stored = spark.read.parquet(folder)
    else:  # no month of a small table has the rows that the contract asks for
        stored = spark.createDataFrame([], "rate double, year int, month int")
    month = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1))
    gold = stored.groupBy(month.alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("rate"), 2).alias("rates")
    )
    versions = store.table("dataset_versions").groupBy("partition_key").agg(
        F.count(F.lit(1)).cast("int").alias("versions")
    )
    key = F.date_format("month", "'year='yyyy'/month='MM")
    return gold.join(versions, key == F.col("partition_key")).select("month", "rows", "rates", "versions")


@query(
    "snapshot_text_partition",
    """
    SELECT p_type || '/' || p_size AS pair, p_partkey, p_size % 2 = 0 AS rewritten
    FROM part WHERE p_size % 2 = 0 OR p_size > 25""",
)
def _snapshot_text_partition(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot partitioned by texts with slashes and spaces, redone without some of them."""
    folder = shared_folder(spark, "snapshot-text-partition")
    pair = F.concat_ws("/", "p_type", F.col("p_size").cast("string"))
    rows = table(spark, sf, "part").select(
        pair.alias("pair"), "p_partkey", "p_size", F.lit("2024").alias("year"), F.lit("01").alias("month")
    )
    flagged = rows.withColumn("rewritten", F.lit(False))
    write_snapshots(flagged, folder, [_JANUARY], ["pair"])
    even = rows.filter("p_size % 2 = 0").withColumn("rewritten", F.lit(True))
    odd = rows.filter("p_size % 2 = 1 AND p_size > 25").withColumn("rewritten", F.lit(False))
    write_snapshots(even.unionByName(odd), folder, [_JANUARY], ["pair"])
    return spark.read.parquet(folder).select("pair", "p_partkey", "rewritten")


@query(
    "stage_metrics",
    f"""
    WITH {SHIP_MONTHLY}
    SELECT stage_name, input_rows, output_rows FROM (
      SELECT unnest(['ingest', 'transform', 'quality']) AS stage_name,
             unnest([raw, raw, silver]) AS input_rows, unnest([raw, silver, silver]) AS output_rows
      FROM (SELECT count(*) AS raw FROM lineitem), (SELECT count(*) AS silver FROM ship_monthly))""",
)
def _stage_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """One month's run over all of lineitem."""
    store = metadata_store(spark, "stage-metrics")
    records = ship_monthly(spark, sf).drop("fetched_at", "batch_id")
    # Without a landing time of its own, a pair and month keeps its greatest rate.
    run_month(store, "bsp_fx", records, _JANUARY)
    return store.table("stage_metrics").select("stage_name", "input_rows", "output_rows")


_TYPES = (
    '{{"c_acctbal": "DoubleType()", "c_custkey": "LongType()", "c_mktsegment": "StringType()", '
    '"c_name": "StringType()", "c_nationkey": "{nation}()"}}'
)


@query(
    "schema_drift",
    "SELECT 'before' AS snapshot, count(*) AS row_count, "
    f"sha256('{_TYPES.format(nation='IntegerType')}') AS schema_hash FROM customer UNION ALL "
    f"SELECT 'after', count(*), sha256('{_TYPES.format(nation='LongType')}') FROM customer",
)
def _schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Schema hashes of two snapshots of customers, the second one with a changed column type."""
    folder = shared_folder(spark, "schema-drift")
    before = table(spark, sf, "customer")
    after = before.withColumn("c_nationkey", F.col("c_nationkey").cast("bigint"))
    hashes = []
    for name, rows in (("before", before), ("after", after)):
        rows.write.parquet(f"{folder}/{name}")
        stored = spark.read.parquet(f"{folder}/{name}")
        hashes.append(stored.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("snapshot"), "row_count", F.lit(schema_hash(stored)).alias("schema_hash")
        ))
    return hashes[0].unionByName(hashes[1])
