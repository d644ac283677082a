"""Bronze- and metadata-shaped views of the test tables, in Spark and as SQL common tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.numeric import unit_of
from stratalake.functions.text import partition_key


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _zoned(column: str) -> F.Column:
    return F.col(column).cast("timestamp")


# ---------------------------------------------------------------- consumer prices from orders

_SERIES = {"1-URGENT": "CPI_ALL_ITEMS", "2-HIGH": "CPI_YOY_CHANGE"}


def psa_bronze(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    series = F.col("o_orderpriority")
    code = (
        F.when(series == "1-URGENT", _SERIES["1-URGENT"])
        .when(series == "2-HIGH", _SERIES["2-HIGH"])
        .otherwise(series)
    )
    return orders.select(
        code.alias("series_code"),
        F.date_format("o_orderdate", "yyyy'M'MM").alias("period"),
        F.col("o_totalprice").alias("value"),
        unit_of(code).alias("unit"),
        F.lit("orders").alias("source"),
        _zoned("o_orderdate").alias("fetched_at"),
        F.col("o_orderkey").cast("string").alias("batch_id"),
    )


PSA_BRONZE = """
psa_bronze AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'CPI_ALL_ITEMS'
              WHEN '2-HIGH' THEN 'CPI_YOY_CHANGE' ELSE o_orderpriority END AS series_code,
         strftime(o_orderdate, '%YM%m') AS period,
         o_totalprice AS value,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'index (2018=100)' ELSE 'percent' END AS unit,
         'orders' AS source,
         o_orderdate AS fetched_at,
         CAST(o_orderkey AS VARCHAR) AS batch_id
  FROM orders)"""

PSA_SILVER = f"""{PSA_BRONZE},
psa_silver AS (
  SELECT period_date, CAST(year(period_date) AS INTEGER) AS period_year,
         CAST(month(period_date) AS INTEGER) AS period_month, series_code, value, unit, source
  FROM (SELECT *, make_date(CAST(split_part(period, 'M', 1) AS INTEGER),
                            CAST(split_part(period, 'M', 2) AS INTEGER), 1) AS period_date
        FROM psa_bronze)
  QUALIFY row_number() OVER (PARTITION BY series_code, period_date
            ORDER BY fetched_at DESC, batch_id DESC, value DESC) = 1)"""


# ---------------------------------------------------------------- rates from events and lineitem


def fx_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Day-grain rates; a value above 200 counts as not published."""
    return table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("rate_date"),
        F.col("event_type").alias("currency_pair"),
        F.when(F.col("value") <= 200, F.col("value")).alias("rate"),
        F.lit("events").alias("source"),
        _zoned("ts").alias("fetched_at"),
        F.col("event_id").cast("string").alias("batch_id"),
    )


FX_BRONZE = """
fx_bronze AS (
  SELECT strftime(ts, '%Y-%m-%d') AS rate_date, event_type AS currency_pair,
         CASE WHEN value <= 200 THEN value END AS rate, 'events' AS source,
         ts AS fetched_at, CAST(event_id AS VARCHAR) AS batch_id
  FROM events)"""

FX_SILVER = f"""{FX_BRONZE},
fx_silver AS (
  SELECT CAST(rate_date AS DATE) AS period_date, currency_pair, rate, source
  FROM fx_bronze WHERE rate IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY currency_pair, rate_date
            ORDER BY fetched_at DESC, batch_id DESC, rate DESC) = 1)"""


def ship_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """A single currency pair over all of lineitem: every row shares few hot keys."""
    return table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("rate_date"),
        F.lit("USD/PHP").alias("currency_pair"),
        F.col("l_extendedprice").alias("rate"),
        F.lit("lineitem").alias("source"),
        _zoned("l_shipdate").alias("fetched_at"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("batch_id"),
    )


def _ship_silver(name: str, day: str, pair: str) -> str:
    return f"""
{name} AS (
  SELECT CAST({day} AS DATE) AS period_date, {pair} AS currency_pair,
         l_extendedprice AS rate, 'lineitem' AS source
  FROM lineitem WHERE l_extendedprice IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY CAST({day} AS DATE), {pair}
            ORDER BY l_shipdate DESC, l_orderkey || '-' || l_linenumber DESC,
                     l_extendedprice DESC) = 1)"""


SHIP_SILVER = _ship_silver("ship_silver", "l_shipdate", "'USD/PHP'")
SHIP_MONTHLY = _ship_silver(
    "ship_monthly", "date_trunc('month', l_shipdate)", "'S' || l_suppkey"
)


def ship_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """A pair per supplier at month grain, the grain gold is partitioned by."""
    month = F.date_format(F.trunc(F.to_date("l_shipdate"), "month"), "yyyy-MM-dd")
    return table(spark, sf, "lineitem").select(
        month.alias("rate_date"),
        F.concat(F.lit("S"), "l_suppkey").alias("currency_pair"),
        F.col("l_extendedprice").alias("rate"),
        F.lit("lineitem").alias("source"),
        _zoned("l_shipdate").alias("fetched_at"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("batch_id"),
    )


# ---------------------------------------------------------------- policy decisions from orders

_DIRECTION = {"F": "hike", "O": "cut", "P": "pause"}


def policy_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """A rate series per customer; "pause" is no known direction and is filtered in silver."""
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        "o_custkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("decision_date"),
        F.round(F.col("o_totalprice") / 25000, 2).alias("overnight_rp"),
        F.lit(None).cast("double").alias("overnight_srp"),
        F.when(status == "F", "hike").when(status == "O", "cut").otherwise("pause").alias("direction"),
        F.lit("orders").alias("source"),
        _zoned("o_orderdate").alias("fetched_at"),
        F.col("o_orderkey").cast("string").alias("batch_id"),
    )


POLICY_BRONZE = """
policy_bronze AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS decision_date,
         round(o_totalprice / 25000, 2) AS overnight_rp,
         CASE o_orderstatus WHEN 'F' THEN 'hike' WHEN 'O' THEN 'cut' ELSE 'pause' END AS direction,
         o_orderdate AS fetched_at, CAST(o_orderkey AS VARCHAR) AS batch_id
  FROM orders)"""


# ---------------------------------------------------------------- runs, stages, results, versions


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """An order is a run. Only finished ones have an end."""
    status = F.col("o_orderstatus")
    ended = F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_custkey % 1000)")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.lit("orders").alias("pipeline_name"),
        F.col("o_orderpriority").alias("source"),
        F.to_date("o_orderdate").alias("run_date"),
        F.col("o_orderdate").alias("started_at"),
        F.when(status != "P", ended).alias("ended_at"),
        F.when(status == "F", "SUCCESS").when(status == "O", "PARTIAL").otherwise("RUNNING").alias("status"),
        F.floor("o_totalprice").alias("records_ingested"),
        (F.col("o_custkey") % 7).alias("records_rejected"),
    )


RUNS = """
runs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id, 'orders' AS pipeline_name,
         o_orderpriority AS source, CAST(o_orderdate AS DATE) AS run_date,
         o_orderdate AS started_at,
         CASE WHEN o_orderstatus <> 'P'
              THEN o_orderdate + to_seconds(o_custkey % 1000) END AS ended_at,
         CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'PARTIAL'
              ELSE 'RUNNING' END AS status,
         CAST(floor(o_totalprice) AS BIGINT) AS records_ingested,
         o_custkey % 7 AS records_rejected
  FROM orders)"""


def stages(spark: SparkSession, sf: str) -> DataFrame:
    """One stage per run and line number: seven stage names, whatever the table's size."""
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.min("l_shipdate").alias("started_at"),
            F.max("l_discount").alias("duration_seconds"),
            F.count(F.lit(1)).alias("input_rows"),
            F.count_if(F.col("l_returnflag") != "R").alias("output_rows"),
        )
        .select(
            F.col("l_linenumber").cast("bigint").alias("id"),
            F.col("l_orderkey").cast("string").alias("run_id"),
            F.concat(F.lit("stage_"), "l_linenumber").alias("stage_name"),
            "started_at",
            "duration_seconds",
            "input_rows",
            "output_rows",
        )
    )


STAGES = """
stages AS (
  SELECT CAST(l_linenumber AS BIGINT) AS id, CAST(l_orderkey AS VARCHAR) AS run_id,
         'stage_' || l_linenumber AS stage_name, min(l_shipdate) AS started_at,
         max(l_discount) AS duration_seconds, count(*) AS input_rows,
         count(*) FILTER (WHERE l_returnflag <> 'R') AS output_rows
  FROM lineitem GROUP BY l_orderkey, l_linenumber)"""


def results(spark: SparkSession, sf: str) -> DataFrame:
    """One check result per run and return flag: three check names."""
    failed = F.count_if(F.col("l_discount") > 0.05)
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_returnflag")
        .agg(failed.alias("failed_count"))
        .select(
            F.ascii("l_returnflag").cast("bigint").alias("id"),
            F.col("l_orderkey").cast("string").alias("run_id"),
            F.concat(F.lit("check_"), "l_returnflag").alias("check_name"),
            (F.col("failed_count") == 0).alias("passed"),
            "failed_count",
            F.lit(0.05).alias("threshold"),
        )
    )


RESULTS = """
results AS (
  SELECT CAST(ascii(l_returnflag) AS BIGINT) AS id, CAST(l_orderkey AS VARCHAR) AS run_id,
         'check_' || l_returnflag AS check_name,
         count(*) FILTER (WHERE l_discount > 0.05) = 0 AS passed,
         count(*) FILTER (WHERE l_discount > 0.05) AS failed_count,
         CAST(0.05 AS DOUBLE) AS threshold
  FROM lineitem GROUP BY l_orderkey, l_returnflag)"""


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """A line item is a version its run wrote of its supplier's dataset."""
    key = partition_key(F.col("l_shipdate"))
    dataset = F.concat(F.lit("dataset_"), "l_suppkey")
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("id"),
        F.col("l_orderkey").cast("string").alias("run_id"),
        dataset.alias("dataset_name"),
        key.alias("partition_key"),
        F.col("l_quantity").cast("bigint").alias("row_count"),
        F.sha2(F.col("l_partkey").cast("string"), 256).alias("schema_hash"),
        F.concat(F.lit("s3a://lake/gold/"), dataset, F.lit("/"), key, F.lit("/")).alias("s3_path"),
        F.col("l_shipdate").alias("created_at"),
    )


VERSIONS = """
versions AS (
  SELECT l_partkey AS id, CAST(l_orderkey AS VARCHAR) AS run_id,
         'dataset_' || l_suppkey AS dataset_name,
         strftime(l_shipdate, 'year=%Y/month=%m') AS partition_key,
         CAST(l_quantity AS BIGINT) AS row_count, sha256(CAST(l_partkey AS VARCHAR)) AS schema_hash,
         's3a://lake/gold/dataset_' || l_suppkey || '/' || strftime(l_shipdate, 'year=%Y/month=%m')
           || '/' AS s3_path,
         l_shipdate AS created_at
  FROM lineitem)"""


# ---------------------------------------------------------------- SQL rendering


def iso(column: str) -> str:
    """ISO text of a date column, under its own name."""
    return f"strftime({column}, '%Y-%m-%d') AS {column}"


def iso_ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S') AS {column}"
