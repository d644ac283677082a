"""Bronze to silver, and the monthly trend."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.contracts import load_contract
from stratalake.operators.change import classify_change
from stratalake.operators.columns import recode, recode_from
from stratalake.operators.filters import in_set
from stratalake.operators.latest import top_per_key
from stratalake.operators.monthly import monthly_trend, monthly_trend_outer
from stratalake.operators.quality import CheckConfig, apply_checks, quality_stats
from stratalake.plans.gold import conform, map_to_gold
from stratalake.plans.silver import fx_silver, policy_silver, psa_silver
from stratalake.session import staged
from workload import query
from workload.tables import (
    FX_SILVER,
    POLICY_BRONZE,
    PSA_SILVER,
    SHIP_SILVER,
    fx_bronze,
    iso,
    policy_bronze,
    psa_bronze,
    ship_bronze,
    table,
)

AS_OF = date(2000, 12, 31)


@query(
    "psa_silver",
    f"WITH {PSA_SILVER} SELECT {iso('period_date')}, period_year, period_month, series_code, "
    "value, unit, source FROM psa_silver",
)
def _psa_silver(spark: SparkSession, sf: str) -> DataFrame:
    return psa_silver(psa_bronze(spark, sf))


@query(
    "fx_silver",
    f"WITH {FX_SILVER} SELECT {iso('period_date')}, currency_pair, rate, source FROM fx_silver",
)
def _fx_silver(spark: SparkSession, sf: str) -> DataFrame:
    return fx_silver(fx_bronze(spark, sf))


_POLICY = """
kept AS (
  SELECT * FROM policy_bronze
  WHERE overnight_rp BETWEEN 0.5 AND 20.0 AND direction IN ('hike', 'cut', 'hold')
    AND decision_date <= DATE '2000-12-31'
  QUALIFY row_number() OVER (PARTITION BY {keys}
            ORDER BY fetched_at DESC, batch_id DESC, overnight_rp DESC) = 1),
lagged AS (
  SELECT *, lag(overnight_rp) OVER ({series} ORDER BY decision_date) AS previous FROM kept)
SELECT {columns} strftime(decision_date, '%Y-%m-%d') AS decision_date, overnight_rp,
       CASE WHEN overnight_rp > previous THEN 'hike' WHEN overnight_rp < previous THEN 'cut'
            ELSE 'hold' END AS direction, 'orders' AS source
FROM lagged"""


@query(
    "policy_silver",
    f"WITH {POLICY_BRONZE}, "
    + _POLICY.format(
        keys="o_custkey, decision_date", series="PARTITION BY o_custkey", columns="o_custkey,"
    ),
)
def _policy_silver(spark: SparkSession, sf: str) -> DataFrame:
    return policy_silver(policy_bronze(spark, sf), AS_OF, ["o_custkey"]).drop("overnight_srp")


@query(
    "policy_single_series",
    f"WITH {POLICY_BRONZE}, " + _POLICY.format(keys="decision_date", series="", columns=""),
)
def _policy_single_series(spark: SparkSession, sf: str) -> DataFrame:
    return policy_silver(policy_bronze(spark, sf), AS_OF).drop("overnight_srp")


@query(
    "policy_direction",
    """
    WITH lagged AS (
      SELECT o_orderkey, o_orderpriority, o_totalprice,
             lag(o_totalprice) OVER (PARTITION BY o_orderpriority
                                     ORDER BY o_orderdate, o_orderkey) AS previous
      FROM orders)
    SELECT o_orderkey, o_orderpriority,
           CASE WHEN o_totalprice > previous THEN 'hike' WHEN o_totalprice < previous THEN 'cut'
                ELSE 'hold' END AS direction
    FROM lagged""",
)
def _policy_direction(spark: SparkSession, sf: str) -> DataFrame:
    """Five series over all orders: far too large to sort one in a task, so each is split.

    A bucket is a range of a million order keys of a day of a year. Keys are unique, so a bucket is
    bounded, and so is what is carried: ranges of a day, days of a year, years.
    """
    key_range = F.floor(F.col("o_orderkey") / 1_000_000)
    return classify_change(
        table(spark, sf, "orders"),
        ["o_orderpriority"],
        ["o_orderdate", "o_orderkey"],
        "o_totalprice",
        buckets=[F.year("o_orderdate"), F.to_date("o_orderdate"), key_range],
    ).select("o_orderkey", "o_orderpriority", "direction")


@query(
    "enum_filter",
    "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')",
)
def _enum_filter(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type")
    return in_set(events, "event_type", ["click", "purchase"])


_MACRO_GOLD = """
macro_gold AS (
  SELECT period_date AS period,
         CASE series_code WHEN 'CPI_ALL_ITEMS' THEN 'CPI_ALL'
              WHEN 'CPI_YOY_CHANGE' THEN 'CPI_YOY' ELSE series_code END AS indicator_code,
         value, source
  FROM psa_silver)"""


@query(
    "gold_map",
    f"WITH {PSA_SILVER}, {_MACRO_GOLD} SELECT {iso('period')}, indicator_code, value, source "
    "FROM macro_gold",
)
def _gold_map(spark: SparkSession, sf: str) -> DataFrame:
    return map_to_gold(psa_silver(psa_bronze(spark, sf)), "gold_macro_indicators")


@query(
    "recode_lookup",
    "SELECT c_custkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS nation "
    "FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey",
)
def _recode_lookup(spark: SparkSession, sf: str) -> DataFrame:
    coded = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("nation")
    )
    names = table(spark, sf, "nation").withColumn("n_nationkey", F.col("n_nationkey").cast("string"))
    return recode_from(coded, "nation", names, "n_nationkey", "n_name")


def _checked_gold(silver: DataFrame, dataset: str) -> DataFrame:
    """Clean rows of a dataset under its contract."""
    contract = load_contract(dataset)
    gold = conform(map_to_gold(silver, dataset), contract)
    return apply_checks(gold, contract.quality_checks)[0]


def _macro_and_fx(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Silver is stored, as in any run: checks read it twice, bronze is read once."""
    macro = staged(psa_silver(psa_bronze(spark, sf)), "trend-macro")
    fx = staged(fx_silver(ship_bronze(spark, sf)), "trend-fx")
    return (
        _checked_gold(macro, "gold_macro_indicators"),
        _checked_gold(fx, "gold_exchange_rates"),
    )


_TREND = f"""
WITH {PSA_SILVER}, {_MACRO_GOLD}, {SHIP_SILVER},
macro AS (
  SELECT strftime(period, '%Y-%m') AS period,
         max(value) FILTER (WHERE indicator_code = 'CPI_ALL') AS "CPI_ALL",
         max(value) FILTER (WHERE indicator_code = 'CPI_YOY') AS "CPI_YOY"
  FROM macro_gold
  WHERE value BETWEEN -1000000 AND 1000000 AND (SELECT count(*) FROM macro_gold) >= 100
  GROUP BY 1),
fx AS (
  SELECT strftime(period_date, '%Y-%m') AS period, arg_max(rate, period_date) AS "USD/PHP"
  FROM ship_silver
  WHERE rate BETWEEN 0.0001 AND 1000000 AND (SELECT count(*) FROM ship_silver) >= 20
  GROUP BY 1)
SELECT coalesce(macro.period, fx.period) AS period, "CPI_ALL", "CPI_YOY", "USD/PHP"
FROM macro FULL JOIN fx ON macro.period = fx.period"""


@query("monthly_trend", _TREND)
def monthly_trend_query(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze to chart through every layer."""
    return monthly_trend(*_macro_and_fx(spark, sf))


@query("monthly_trend_outer", _TREND)
def _monthly_trend_outer(spark: SparkSession, sf: str) -> DataFrame:
    return monthly_trend_outer(*_macro_and_fx(spark, sf))


# ---------------------------------------------------------------- rows that must not vanish

_SPOILED = "CASE WHEN o_orderkey % 5 = 0 THEN 'unreadable ' || o_orderkey % 50"


@query(
    "psa_bad_periods",
    f"""
    WITH raw AS (
      SELECT 'CPI_ALL_ITEMS' AS series_code, o_totalprice AS value, o_orderdate AS day,
             {_SPOILED} END AS bad FROM orders),
    best AS (SELECT CASE WHEN bad IS NULL THEN strftime(day, '%Y-%m-01') END AS period_date,
                    bad, max(value) AS value FROM raw GROUP BY 1, 2)
    SELECT period_date, value FROM best""",
)
def _psa_bad_periods(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a readable period: one per raw text reaches the checks."""
    bad = F.when(
        F.col("o_orderkey") % 5 == 0,
        F.concat(F.lit("unreadable "), (F.col("o_orderkey") % 50).cast("string")),
    )
    bronze = table(spark, sf, "orders").select(
        F.lit("CPI_ALL_ITEMS").alias("series_code"),
        F.coalesce(bad, F.date_format("o_orderdate", "yyyy'M'MM")).alias("period"),
        F.col("o_totalprice").alias("value"),
        F.lit("u").alias("unit"),
        F.lit("s").alias("source"),
        F.lit("2024-01-01").cast("timestamp").alias("fetched_at"),
        F.lit("b").alias("batch_id"),
    )
    return psa_silver(bronze).select("period_date", "value")


@query(
    "fx_bad_dates",
    f"""
    WITH raw AS (
      SELECT o_totalprice AS rate, o_orderdate AS day, {_SPOILED} END AS bad FROM orders),
    best AS (SELECT CASE WHEN bad IS NULL THEN CAST(day AS DATE) END AS period, bad, max(rate) AS rate
             FROM raw GROUP BY 1, 2)
    SELECT count(*) AS total, count(period) AS clean, count(*) - count(period) AS rejected,
           (count(*) - count(period)) / count(*) AS failure_rate FROM best""",
)
def _fx_bad_dates(spark: SparkSession, sf: str) -> DataFrame:
    """The failure rate counts every row whose date cannot be read."""
    bad = F.when(
        F.col("o_orderkey") % 5 == 0,
        F.concat(F.lit("unreadable "), (F.col("o_orderkey") % 50).cast("string")),
    )
    bronze = table(spark, sf, "orders").select(
        F.coalesce(bad, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("rate_date"),
        F.lit("USD/PHP").alias("currency_pair"),
        F.col("o_totalprice").alias("rate"),
        F.lit("s").alias("source"),
        F.lit("2024-01-01").cast("timestamp").alias("fetched_at"),
        F.lit("b").alias("batch_id"),
    )
    stats = quality_stats(fx_silver(bronze), [CheckConfig("no_nulls", columns=["period_date"])])
    return stats.select("total", "clean", "rejected", "failure_rate")


@query(
    "recode_many",
    "SELECT o_orderkey, 'customer ' || o_custkey AS customer FROM orders",
)
def _recode_many(spark: SparkSession, sf: str) -> DataFrame:
    """A recode of as many codes as there are customers up to 3,000; others come from a join."""
    codes = {str(n): f"customer {n}" for n in range(3000)}
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    recoded = recode(orders, "customer", codes)
    names = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("old"),
        F.concat(F.lit("customer "), F.col("c_custkey").cast("string")).alias("new"),
    )
    return recode_from(recoded, "customer", names, "old", "new")


@query(
    "top_1500_per_key",
    """
    SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey,
                               l_linenumber, l_partkey, l_suppkey, l_quantity) <= 1500""",
)
def _top_1500_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """More rows per key than the planner ranks before the shuffle."""
    order = [F.col("l_extendedprice").desc()] + [
        F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    ]
    top = top_per_key(table(spark, sf, "lineitem"), ["l_returnflag"], order, 1500)
    return top.select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
