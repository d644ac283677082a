"""Checks, split, statistics, gate."""

import math

import pytest
from pyspark.sql import functions as F

from stratalake.contracts import load_contract, parse_contract
from stratalake.operators import quality
from stratalake.operators.quality import (
    CheckConfig,
    HardQualityFailure,
    annotate,
    apply_checks,
    check_results,
    enforce,
    quality_stats,
    register_check,
    run_check,
)


def _flags(df, cfg):
    return [r[f"{cfg.check}_passed"] for r in run_check(df, cfg).orderBy("id").collect()]


def test_no_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "id int, name string")
    assert _flags(df, CheckConfig("no_nulls", columns=["name"])) == [False, True]
    with pytest.raises(ValueError):
        run_check(df, CheckConfig("no_nulls"))


@pytest.mark.parametrize(("rows", "least", "expected"), [(10, 5, True), (3, 10, False), (10, 10, True)])
def test_row_count_min(spark, rows, least, expected):
    assert set(_flags(spark.range(rows), CheckConfig("row_count_min", value=least))) == {expected}


def test_value_range(spark):
    df = spark.createDataFrame(
        [(1, 5.0), (2, -1.0), (3, 200.0), (4, 0.0), (5, 100.0), (6, None), (7, math.nan)], "id int, v double"
    )
    both = CheckConfig("value_range", column="v", min=0, max=100)
    assert _flags(df, both) == [True, False, False, True, True, False, False]
    assert _flags(df, CheckConfig("value_range", column="v", min=0))[2] is True
    assert _flags(df, CheckConfig("value_range", column="v", max=100))[1] is True
    for cfg in (CheckConfig("value_range"), CheckConfig("row_count_min")):
        with pytest.raises(ValueError):
            run_check(df, cfg)


def test_schema_check(spark):
    df = spark.range(2)
    assert _flags(df, CheckConfig("schema", columns=["id"])) == [True, True]
    assert _flags(df, CheckConfig("schema", columns=["id", "rate"])) == [False, False]


def test_split(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 150.0)], "id int, v double")
    checks = [CheckConfig("no_nulls", columns=["v"]), CheckConfig("value_range", column="v", min=0, max=100)]
    clean, rejected = apply_checks(df, checks)
    assert clean.columns == ["id", "v"] and [r.id for r in clean.collect()] == [1]
    assert rejected.columns == ["id", "v", "no_nulls_passed", "value_range_passed", "is_valid"]
    assert sorted(r.id for r in rejected.collect()) == [2, 3]


def test_clean_and_rejected_make_up_the_input(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, None, math.nan, 7.0, -3.0])], "id int, v double")
    clean, rejected = apply_checks(df, [CheckConfig("value_range", column="v", min=0, max=5)])
    assert sorted([r.id for r in clean.collect()] + [r.id for r in rejected.collect()]) == list(range(5))


def test_repeated_checks_get_flags_of_their_own(spark):
    df = spark.createDataFrame([(1, 5.0, 500.0)], "id int, a double, b double")
    checks = [CheckConfig("value_range", column=c, min=0, max=100) for c in ("a", "b")]
    row = annotate(df, checks).first()
    assert (row.value_range_a_passed, row.value_range_b_passed, row.is_valid) == (True, False, False)


def test_no_checks_means_valid(spark):
    clean, rejected = apply_checks(spark.range(3), [])
    assert clean.count() == 3 and rejected.count() == 0
    assert quality_stats(spark.range(3), []).first().clean == 3


def test_statistics_are_per_check_and_single_pass(spark):
    df = spark.createDataFrame([(1.0,), (None,), (math.nan,), (99.0,), (2.0,)], "v double")
    checks = [
        CheckConfig("no_nulls", columns=["v"]),
        CheckConfig("row_count_min", value=5),
        CheckConfig("value_range", column="v", min=0, max=10),
    ]
    rows = {r.check_name: r for r in check_results(df, checks, 0.05).collect()}
    assert (rows["no_nulls"].failed_count, rows["value_range"].failed_count) == (1, 3)
    assert rows["row_count_min"].passed and rows["row_count_min"].failed_count == 0
    assert (rows["no_nulls"].total, rows["no_nulls"].clean, rows["no_nulls"].rejected) == (5, 2, 3)
    assert rows["no_nulls"].failure_rate == 0.6


def test_failed_table_check_rejects_every_row(spark):
    checks = [CheckConfig("row_count_min", value=4)]
    stats = quality_stats(spark.range(3), checks).first()
    assert (stats.clean, stats.rejected, stats.row_count_min_passed_failed) == (0, 3, 3)
    clean, rejected = apply_checks(spark.range(3), checks)
    assert clean.count() == 0 and rejected.count() == 3


def test_statistics_per_group(spark):
    df = spark.range(10).withColumn("g", F.when(F.col("id") < 7, "a").otherwise("b"))
    stats = {r.g: r for r in quality_stats(df, [CheckConfig("row_count_min", value=5)], ["g"]).collect()}
    assert stats["a"].clean == 7 and stats["b"].clean == 0 and stats["b"].failure_rate == 1.0


def test_empty_input_has_rate_zero(spark):
    stats = quality_stats(spark.range(0), [CheckConfig("no_nulls", columns=["id"])]).first()
    assert (stats.total, stats.failure_rate) == (0, 0.0)


def test_gate_is_strict():
    enforce("r", 0.05, 0.05)
    with pytest.raises(HardQualityFailure) as failure:
        enforce("r", 0.0501, 0.05)
    assert failure.value.run_id == "r" and failure.value.failure_rate == 0.0501


def test_custom_checks(spark):
    register_check("even", lambda df, cfg: F.col(cfg.column) % 2 == 0)
    register_check("max_rows", lambda df, cfg: F.count(F.lit(1)) <= cfg.value, table_level=True)
    try:
        assert _flags(spark.range(3), CheckConfig("even", column="id")) == [True, False, True]
        assert set(_flags(spark.range(3), CheckConfig("max_rows", value=2))) == {False}
    finally:
        quality._ROW_CHECKS.pop("even")
        quality._TABLE_CHECKS.pop("max_rows")
    with pytest.raises(KeyError):
        run_check(spark.range(1), CheckConfig("even", column="id"))


@pytest.mark.parametrize(
    ("name", "least", "column"),
    [("gold_macro_indicators", 100, "value"), ("gold_exchange_rates", 20, "rate")],
)
def test_contracts(spark, name, least, column):
    contract = load_contract(name)
    checks = {c.check: c for c in contract.quality_checks}
    assert checks["row_count_min"].value == least
    assert checks["value_range"].column == column
    assert (contract.hard_failure_threshold, contract.quarantine_on_failure) == (0.05, True)
    assert contract.partition_key == ["period"]
    assert contract.struct_type.fieldNames() == list(contract.schema)


def test_contract_defaults_and_unknown_name():
    contract = parse_contract({"dataset": "d", "version": 1, "partition_key": [], "schema": {"a": "int"}})
    assert contract.quarantine_on_failure and contract.hard_failure_threshold == 0.05
    with pytest.raises(FileNotFoundError):
        load_contract("no_such_dataset")
