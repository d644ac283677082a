"""Checks, splits, statistics and constraint audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.audit import (
    column_violations,
    duplicate_keys,
    key_rule,
    orphans,
    reference_rule,
)
from stratalake.operators.quality import (
    CheckConfig,
    apply_checks,
    check_results,
    pass_rate,
    quality_stats,
    register_check,
    run_check,
)
from workload import query
from workload.tables import FX_BRONZE, fx_bronze, table


@query(
    "dq_no_nulls",
    f"WITH {FX_BRONZE} SELECT batch_id, currency_pair, rate, "
    "rate IS NOT NULL AND currency_pair IS NOT NULL AS no_nulls_passed FROM fx_bronze",
)
def _dq_no_nulls(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx_bronze(spark, sf).select("batch_id", "currency_pair", "rate")
    return run_check(rows, CheckConfig("no_nulls", columns=["rate", "currency_pair"]))


@query(
    "dq_row_count_min",
    "SELECT o_orderkey, (SELECT count(*) FROM orders) >= 1000 AS row_count_min_passed FROM orders",
)
def _dq_row_count_min(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_orderkey")
    return run_check(rows, CheckConfig("row_count_min", value=1000))


@query(
    "dq_value_range",
    "SELECT c_custkey, c_acctbal, c_acctbal BETWEEN 0 AND 9000 AS value_range_passed FROM customer",
)
def _dq_value_range(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return run_check(rows, CheckConfig("value_range", column="c_acctbal", min=0, max=9000))


@query(
    "dq_schema",
    "SELECT s_suppkey, true AS complete, false AS with_region FROM supplier",
)
def _dq_schema(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "supplier")
    has = run_check(rows, CheckConfig("schema", columns=["s_suppkey", "s_name"]))
    named = has.withColumnRenamed("schema_passed", "complete")
    lacks = run_check(named, CheckConfig("schema", columns=["s_suppkey", "s_region"]))
    return lacks.select("s_suppkey", "complete", F.col("schema_passed").alias("with_region"))


@query(
    "dq_registered_checks",
    """
    SELECT o_orderkey, o_custkey, coalesce(o_custkey % 7 < 3, false) AS low_remainder_passed,
           (SELECT count(DISTINCT o_custkey) FROM orders) >= 50 AS distinct_min_passed
    FROM orders""",
)
def _dq_registered_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Two checks that the library does not have: one per row, one over the table."""
    register_check(
        "low_remainder", lambda df, cfg: F.coalesce(F.col(cfg.column) % cfg.max < cfg.value, F.lit(False))
    )
    register_check(
        "distinct_min",
        lambda df, cfg: F.count_distinct(cfg.column) >= cfg.value,
        table_level=True,
    )
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    low = run_check(rows, CheckConfig("low_remainder", column="o_custkey", max=7, value=3))
    return run_check(low, CheckConfig("distinct_min", column="o_custkey", value=50))


CHECKS = [
    CheckConfig("no_nulls", columns=["rate_date", "currency_pair", "rate"]),
    CheckConfig("row_count_min", value=20),
    CheckConfig("value_range", column="rate", min=1.0, max=150.0),
]
THRESHOLD = 0.05

_FLAGS = f"""
{FX_BRONZE},
flagged AS (
  SELECT batch_id, rate_date, currency_pair, rate,
         rate_date IS NOT NULL AND currency_pair IS NOT NULL AND rate IS NOT NULL
           AS no_nulls_passed,
         (SELECT count(*) FROM fx_bronze) >= 20 AS row_count_min_passed,
         coalesce(rate BETWEEN 1.0 AND 150.0, false) AS value_range_passed
  FROM fx_bronze),
judged AS (
  SELECT *, no_nulls_passed AND row_count_min_passed AND value_range_passed AS is_valid
  FROM flagged)"""


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    return fx_bronze(spark, sf).select("batch_id", "rate_date", "currency_pair", "rate")


@query(
    "dq_split_clean",
    f"WITH {_FLAGS} SELECT batch_id, rate_date, currency_pair, rate FROM judged WHERE is_valid",
)
def _dq_split_clean(spark: SparkSession, sf: str) -> DataFrame:
    return apply_checks(_checked(spark, sf), CHECKS)[0]


@query("dq_split_rejected", f"WITH {_FLAGS} SELECT * FROM judged WHERE NOT coalesce(is_valid, false)")
def _dq_split_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return apply_checks(_checked(spark, sf), CHECKS)[1]


_RESULTS = """
SELECT {by} total, clean, total - clean AS rejected,
       (total - clean) / total AS failure_rate,
       (total - clean) / total > 0.05 AS gate_failed,
       round(100.0 * clean / total, 2) AS pass_rate,
       check_name, failed_count = 0 AS passed, failed_count, CAST(0.05 AS DOUBLE) AS threshold
FROM (
  SELECT {by} CAST(count(*) AS BIGINT) AS total,
         count(*) FILTER (WHERE is_valid) AS clean,
         count(*) FILTER (WHERE NOT no_nulls_passed) AS no_nulls,
         CAST(0 AS BIGINT) AS row_count_min,
         count(*) FILTER (WHERE NOT value_range_passed) AS value_range
  FROM judged {group})
UNPIVOT (failed_count FOR check_name IN (no_nulls, row_count_min, value_range))"""


def _with_rates(results: DataFrame) -> DataFrame:
    return results.withColumns(
        {
            "gate_failed": F.col("failure_rate") > F.col("threshold"),
            "pass_rate": pass_rate(F.col("clean"), F.col("total")),
        }
    )


@query("dq_results", f"WITH {_FLAGS} " + _RESULTS.format(by="", group=""))
def _dq_results(spark: SparkSession, sf: str) -> DataFrame:
    return _with_rates(check_results(_checked(spark, sf), CHECKS, THRESHOLD))


@query(
    "dq_results_per_group",
    f"WITH {_FLAGS} " + _RESULTS.format(by="currency_pair, ", group="GROUP BY currency_pair"),
)
def _dq_results_per_group(spark: SparkSession, sf: str) -> DataFrame:
    """Every pair judged as a batch of its own, in the same single aggregation."""
    return _with_rates(check_results(_checked(spark, sf), CHECKS, THRESHOLD, ["currency_pair"]))


@query(
    "dq_counts",
    f"WITH {_FLAGS} SELECT rate_date, count(*) AS total, count(*) FILTER (WHERE is_valid) AS clean, "
    "count(*) FILTER (WHERE NOT is_valid) AS rejected FROM "
    "(SELECT * REPLACE (no_nulls_passed AND value_range_passed AS is_valid) FROM judged) "
    "GROUP BY rate_date",
)
def _dq_counts(spark: SparkSession, sf: str) -> DataFrame:
    row_checks = [c for c in CHECKS if c.check != "row_count_min"]
    stats = quality_stats(_checked(spark, sf), row_checks, ["rate_date"])
    return stats.select("rate_date", "total", "clean", "rejected")


# ---------------------------------------------------------------- constraints

_AUDIT = """
SELECT 'not_null:o_orderkey' AS rule, count(*) FILTER (WHERE o_orderkey IS NULL) AS violations
FROM orders
UNION ALL
SELECT 'enum:o_orderstatus', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM orders
UNION ALL
SELECT 'unique:l_orderkey,l_linenumber',
       (SELECT count(*) FROM lineitem)
         - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
UNION ALL
SELECT 'unique:o_orderkey', count(*) - count(DISTINCT o_orderkey) FROM orders
UNION ALL
SELECT 'foreign_key:l_orderkey', count(*) FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')
UNION ALL
SELECT 'foreign_key:doc_id', count(*) FROM labels
WHERE NOT EXISTS (SELECT 1 FROM documents WHERE documents.doc_id = labels.doc_id)"""


@query("dq_constraints", _AUDIT)
def _dq_constraints(spark: SparkSession, sf: str) -> DataFrame:
    orders, lineitem = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    closed = orders.filter(F.col("o_orderstatus") == "F")
    return (
        column_violations(orders, ["o_orderkey"], {"o_orderstatus": ["F", "O"]})
        .unionByName(key_rule(lineitem, ["l_orderkey", "l_linenumber"]))
        .unionByName(key_rule(orders, ["o_orderkey"]))
        .unionByName(reference_rule(lineitem, closed, "l_orderkey", "o_orderkey"))
        .unionByName(
            reference_rule(table(spark, sf, "labels"), table(spark, sf, "documents"), "doc_id", "doc_id")
        )
    )


@query(
    "dq_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def _dq_duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_orphans",
    "SELECT o_custkey, count(*) AS rows FROM orders WHERE NOT EXISTS "
    "(SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0) GROUP BY o_custkey",
)
def _dq_orphans(spark: SparkSession, sf: str) -> DataFrame:
    solvent = table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    return orphans(table(spark, sf, "orders"), solvent, "o_custkey", "c_custkey")
