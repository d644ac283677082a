"""What the plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from stratalake.operators.latest import dedup
from stratalake.operators.quality import CheckConfig, annotate, check_results
from workload import load_all
from workload.tables import table

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Queries that write first are looked at in the plans that they read back with, which say little.
READS = [n for n in load_all() if n not in {
    "bronze_landing", "silver_partitions", "gold_publish", "quality_record", "snapshot_latest",
    "backfill_overwrite", "backfill_chain", "backfill_empty_month", "snapshot_text_partition",
    "stage_metrics", "schema_drift", "snapshot_evolved", "snapshot_evolved_nested", "upsert_partitions",
    "insert_absent_indexed", "direction_late", "trend_incremental", "fingerprint_merge", "landing_commit",
    "silver_disjoint_files", "stream_landing", "metadata_folded",
}]

#: What may go to a single task: what every task has reduced before, and the last values of years.
_REDUCED = re.compile(r"Aggregate|LocalLimit|TopK|WindowGroupLimit|_edge")


@pytest.mark.parametrize("name", READS)
def test_no_cross_join_no_python_no_single_window(spark, name):
    plan = plan_of(__spark_entry__.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"PythonUDF|ArrowEval|BatchEvalPython|MapInPandas", plan)
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert _REDUCED.search(" ".join(lines[i + 1 : i + 3])), lines[i : i + 4]


def test_dedup_prunes_before_the_shuffle(spark):
    plan = plan_of(dedup(table(spark, SF, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    below = plan[plan.index("Exchange hashpartitioning(o_custkey"):]
    assert "WindowGroupLimit" in below


def test_lag_shuffles_all_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, key in (("policy_direction", "_level2"), ("policy_silver", "_level0")):
            df = __spark_entry__.queries()[name](spark, SF)
            df.collect()
            plan = plan_of(df).split("== Initial Plan ==")[0]
            assert "SinglePartition" not in plan
            # All rows, and the edges that they are joined with.
            moves = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and key in x]
            assert len([x for x in moves if "ReusedExchange" not in x]) <= 2, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_yearly_values_of_a_single_series_meet(spark):
    plan = plan_of(__spark_entry__.queries()["policy_single_series"](spark, SF))
    at = [i for i, line in enumerate(plan.splitlines()) if "SinglePartition" in line]
    assert len(at) == 1 and "_edge" in plan.splitlines()[at[0] + 1]


def test_filters_and_columns_reach_the_scan(spark):
    df = __spark_entry__.queries()["policy_silver"](spark, SF)
    plan = plan_of(df)
    schema = re.search(r"ReadSchema: struct<([^>]*)", plan).group(1)
    assert "o_orderpriority" not in schema
    runs = plan_of(__spark_entry__.queries()["runs_list_by_source"](spark, SF))
    assert "EqualTo(o_orderpriority,1-URGENT)" in runs
    assert "TakeOrderedAndProject" in runs


def test_statistics_take_one_scan_and_one_shuffle(spark):
    events = table(spark, SF, "events")
    checks = [
        CheckConfig("no_nulls", columns=["value"]),
        CheckConfig("row_count_min", value=10),
        CheckConfig("value_range", column="value", min=0, max=5),
    ]
    plan = plan_of(check_results(events, checks, 0.05))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "ReadSchema: struct<value:double>" in plan


def test_table_check_is_a_scalar_subquery(spark):
    events = table(spark, SF, "events")
    plan = plan_of(annotate(events, [CheckConfig("row_count_min", value=10)]))
    assert "Subquery" in plan and "Join" not in plan


def test_child_counts_shrink_before_the_anti_join(spark):
    plan = plan_of(__spark_entry__.queries()["dq_orphans"](spark, SF))
    assert "LeftAnti" in plan and "partial_count" in plan


def test_trend_is_one_aggregation(spark):
    plan = plan_of(__spark_entry__.queries()["monthly_trend"](spark, SF))
    assert plan.count("partial_max_by") >= 1 and "SortAggregate" not in plan and "Join" not in plan


def test_entry(spark):
    rows = __spark_entry__.entry(spark)
    assert rows.columns == ["period", "CPI_ALL", "CPI_YOY", "USD/PHP"]
    assert rows.filter(F.col("CPI_ALL").isNotNull()).count() > 0
