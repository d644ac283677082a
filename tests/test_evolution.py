"""Least common types, and folders whose files were written under different schemas."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.evolution import least_common_type, reconciled, schema_changes, united
from stratalake.sinks import read_snapshots, write_snapshots
from stratalake.sources.evolved import read_evolved, schema_groups


def schema(text):
    return T._parse_datatype_string(text) if hasattr(T, "_parse_datatype_string") else T.StructType.fromDDL(text)


@pytest.mark.parametrize(
    "a, b, common",
    [
        ("tinyint", "int", "int"),
        ("int", "bigint", "bigint"),
        ("float", "int", "double"),
        ("float", "double", "double"),
        ("decimal(10,2)", "int", "decimal(12,2)"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
        ("decimal(38,0)", "decimal(38,10)", "double"),
        ("bigint", "decimal(5,1)", "decimal(21,1)"),
        ("date", "timestamp", "timestamp"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("boolean", "int", "string"),
        ("date", "int", "string"),
        ("string", "double", "string"),
        ("void", "int", "int"),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("map<string,int>", "map<string,double>", "map<string,double>"),
        ("struct<a:int>", "struct<b:string,a:bigint>", "struct<a:bigint,b:string>"),
    ],
)
def test_least_common_type(spark, a, b, common):
    left, right, want = (schema(f"x {kind}").fields[0].dataType for kind in (a, b, common))
    assert least_common_type(left, right).simpleString() == want.simpleString()
    if "struct" not in a:
        assert least_common_type(right, left).simpleString() == want.simpleString()


def test_plain_and_nested_name_the_column(spark):
    with pytest.raises(ValueError, match="outer.inner"):
        reconciled([schema("outer struct<inner:int>"), schema("outer struct<inner:array<int>>")])


def test_changes(spark):
    found = schema_changes(schema("a int, b string, c bigint, D date"), schema("A bigint, c int, d date, e double"))
    assert found == [
        ("A", "widened", "int", "bigint"),
        ("b", "removed", "string", None),
        ("c", "changed", "bigint", "int"),
        ("e", "added", None, "double"),
    ]


def test_united_matches_names_without_case_and_keeps_null_structs(spark):
    a = spark.createDataFrame([(1, (1, "x")), (2, None)], "Id int, d struct<n:int,t:string>")
    b = spark.createDataFrame([(3, [1], (5.5,))], "iD bigint, more array<int>, d struct<N:double>")
    rows = united([a, b])
    assert rows.schema.simpleString() == "struct<Id:bigint,d:struct<n:double,t:string>,more:array<int>>"
    assert [tuple(r) for r in rows.orderBy("Id").collect()] == [
        (1, (1.0, "x"), None),
        (2, None, None),
        (3, (5.5, None), [1]),
    ]


def _month(spark, folder, month, select):
    rows = spark.range(3).selectExpr("'2024' AS year", f"'{month:02d}' AS month", *select)
    write_snapshots(rows, folder, [date(2024, month, 1)], [])


def test_a_column_of_a_later_month_is_kept(spark, tmp_path):
    folder = str(tmp_path)
    _month(spark, folder, 1, ["id"])
    _month(spark, folder, 2, ["id", "id * 2 AS c"])
    rows = read_snapshots(spark, folder, [date(2024, m, 1) for m in (1, 2, 3)])
    assert {(r.month, r.id): r.c for r in rows.collect()} == {
        **{(1, i): None for i in range(3)},
        **{(2, i): 2 * i for i in range(3)},
    }
    assert len(schema_groups(spark, folder, [folder])) == 1


def test_as_many_scans_as_incompatible_schemas(spark, tmp_path):
    folder = str(tmp_path)
    for month in range(1, 11):
        kind = "string" if month in (4, 9) else "int" if month < 7 else "bigint"
        _month(spark, folder, month, [f"CAST(id AS {kind}) AS n", f"{month} AS only{month % 2}"])
    days = [date(2024, m, 1) for m in range(1, 11)]
    rows = read_snapshots(spark, folder, days)
    assert rows.schema["n"].dataType == T.StringType()
    assert rows.count() == 30 and rows.filter("only1 IS NULL").count() == 15
    assert sorted(r.n for r in rows.filter("month = 4").collect()) == ["0", "1", "2"]
    groups = schema_groups(spark, folder, [f"{folder}/year=2024/month={m:02d}" for m in range(1, 11)])
    assert len(groups) == 3
    plan = rows.select("n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3
    scans = [line for line in plan.splitlines() if "ReadSchema" in line or "FileScan" in line]
    assert all("only" not in line.split("ReadSchema:")[-1] for line in scans)


def test_files_of_one_folder_disagree(spark, tmp_path):
    folder = str(tmp_path / "part")
    spark.range(2).selectExpr("CAST(id AS int) AS x", "'a' AS old").write.parquet(folder)
    spark.range(2).selectExpr("CAST(id + 10 AS double) AS x").write.mode("append").parquet(folder)
    spark.range(2).selectExpr("id + 20 AS x", "true AS new").write.mode("append").parquet(folder)
    rows = read_evolved(spark, folder, [folder])
    assert dict(rows.dtypes) == {"x": "double", "old": "string", "new": "boolean"}
    assert sorted(r.x for r in rows.collect()) == [0, 1, 10, 11, 20, 21]


def test_folder_names_keep_one_type(spark, tmp_path):
    folder = str(tmp_path)
    for name, kind in (("01", "int"), ("02", "string"), ("x", "bigint")):
        spark.range(1).selectExpr(f"CAST(id AS {kind}) AS v").write.parquet(f"{folder}/k={name}")
    rows = read_evolved(spark, folder, [f"{folder}/k={name}" for name in ("01", "02", "x")])
    assert sorted((r.k, r.v) for r in rows.collect()) == [("01", "0"), ("02", "0"), ("x", "0")]


def test_no_file_at_all(spark, tmp_path):
    assert read_snapshots(spark, str(tmp_path), [date(2024, 1, 1)]) is None
    (tmp_path / "empty").mkdir()
    assert read_evolved(spark, str(tmp_path), [str(tmp_path / "empty")]) is None


def test_filters_and_columns_reach_every_scan(spark, tmp_path):
    folder = str(tmp_path)
    _month(spark, folder, 1, ["CAST(id AS int) AS n", "'a' AS t"])
    _month(spark, folder, 2, ["id AS n", "'b' AS t"])
    rows = read_snapshots(spark, folder, [date(2024, 1, 1), date(2024, 2, 1)])
    plan = rows.filter(F.col("t") == "b").select("n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(t,b)") >= 2
