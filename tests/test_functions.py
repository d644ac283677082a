"""Scalar functions on the values the published tables really hold, and on broken ones."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stratalake.functions import numeric, temporal, text
from stratalake.functions.digest import fingerprint, lane_sums, row_digest


@pytest.mark.parametrize(
    ("period", "expected"),
    [
        ("2024M01", date(2024, 1, 1)),
        ("2024M1", date(2024, 1, 1)),
        ("2024M12", date(2024, 12, 1)),
        ("2024M13", None),
        ("bad", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_period(one, period, expected):
    assert one(temporal.parse_period, period, types=["string"]) == expected


@pytest.mark.parametrize(
    "written", ["June 5, 2024", "5 June 2024", "2024-06-05", "2024-6-5", "06/05/2024", "6/5/2024", "  june  5, 2024 "]
)
def test_parse_date_layouts(one, written):
    assert one(temporal.parse_date, written) == date(2024, 6, 5)


@pytest.mark.parametrize("written", ["2024", "5.6.2024", "Juno 5, 2024", "31/31/2024", "", None])
def test_parse_date_rejects(one, written):
    assert one(temporal.parse_date, written, types=["string"]) is None


@pytest.mark.parametrize(
    ("written", "expected"),
    [
        ("56.18", 56.18),
        (" 1,234.5 ", 1234.5),
        ("\u00a056.1\u00a0", 56.1),
        ("-0.5", -0.5),
        (".5", 0.5),
        ("5.", 5.0),
        ("1e3", 1000.0),
        *[(token, None) for token in ("-", "..", "n.a.", "n/a", "", "nan", "inf", "1_000", "1.5d", "x")],
        (None, None),
    ],
)
def test_parse_rate(one, written, expected):
    assert one(numeric.parse_rate, written, types=["string"]) == expected


def test_dates_and_keys(one):
    day = date(2023, 1, 15)
    for d in (1, 15, 31):
        assert one(temporal.first_of_month, day.replace(day=d)) == date(2023, 1, 1)
    assert one(temporal.month_key, day) == "2023-01"
    assert one(temporal.iso_text, day) == "2023-01-15"
    assert one(text.partition_key, date(2024, 3, 15)) == "year=2024/month=03"
    assert one(temporal.date_from_parts, 2024, 2) == date(2024, 2, 1)


def test_month_sequence_includes_both_ends(spark):
    bounds = spark.createDataFrame([(date(2023, 11, 20), date(2024, 2, 1))], "a date, b date")
    months = bounds.select(temporal.month_sequence(F.col("a"), F.col("b")).alias("m")).collect()
    assert [r.m for r in months] == [date(2023, 11, 1), date(2023, 12, 1), date(2024, 1, 1), date(2024, 2, 1)]


@pytest.mark.parametrize(
    ("end", "expected"),
    [
        (None, "in progress"),
        (datetime(2024, 1, 1, 0, 0, 42, 999000), "42s"),
        (datetime(2024, 1, 1, 0, 3, 7), "3m 7s"),
        (datetime(2024, 1, 1, 2, 0, 0), "120m 0s"),
    ],
)
def test_duration_text(one, end, expected):
    start = datetime(2024, 1, 1)
    assert one(temporal.duration_text, start, end, types=["timestamp", "timestamp"]) == expected


def test_local_time(one):
    def local(moment):
        return temporal.local_time_text(moment, "Asia/Manila", "UTC")

    assert one(local, datetime(2024, 1, 31, 22, 5)) == "Feb 1, 2024, 6:05 AM"


@pytest.mark.parametrize(
    ("value", "expected"),
    [(1.0, "1.00"), (0.125, "0.13"), (1.005, "1.00"), (-1.125, "-1.13"), (1234.5, "1234.50"), (None, "\u2014")],
)
def test_fixed2(one, value, expected):
    assert one(numeric.fixed2, value, types=["double"]) == expected


def test_display_text(one):
    assert one(text.prefix8, "0123456789") == "01234567"
    assert one(text.left_ellipsis, "x" * 48) == "x" * 48
    assert one(text.left_ellipsis, "a" * 10 + "b" * 45) == "\u2026" + "b" * 45
    assert one(numeric.grouped_integer, 1234567) == "1,234,567"
    assert one(numeric.unit_of, "CPI_ALL_ITEMS") == "index (2018=100)"
    assert one(numeric.unit_of, "CPI_YOY_CHANGE") == "percent"


def test_uris(one):
    assert one(text.uri_bucket, "s3://b/k/x") == one(text.uri_bucket, "s3a://b/k/x") == "b"
    assert one(text.uri_key, "s3a://b/k/x.parquet") == "k/x.parquet"
    assert one(text.uri_bucket, "/local/path") is None
    assert one(lambda c: text.to_s3a(c, "b"), "gold/x") == "s3a://b/gold/x"
    assert one(lambda c: text.to_s3a(c, "b"), "s3://c/x") == "s3a://c/x"
    assert one(lambda c: text.plain_dsn(c, "asyncpg"), "postgresql+asyncpg://h/d") == "postgresql://h/d"


def test_ratio_of_nothing(one):
    assert one(numeric.ratio, 0, 0) == 0.0
    assert one(numeric.ratio, 1, 4) == 0.25


def test_row_digest_keeps_columns_apart(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("a", None)], "x string, y string")
    digests = [r[0] for r in rows.select(row_digest(["x", "y"])).collect()]
    assert len(set(digests)) == 3
    assert digests == [r[0] for r in rows.select(row_digest(["y", "x"])).collect()]


def test_fingerprint_ignores_order_and_counts_repeats(spark):
    data = [(i % 7, f"v{i % 5}") for i in range(50)]
    a = spark.createDataFrame(data, "k int, v string")
    b = spark.createDataFrame(list(reversed(data)), "k int, v string").repartition(3)
    twice = a.unionByName(a)
    prints = [fingerprint(d, ["k", "v"]).first() for d in (a, b, twice, a.limit(0))]
    assert prints[0] == prints[1]
    assert prints[0].sha256_hash != prints[2].sha256_hash
    assert prints[3].row_count == 0


def test_lane_sums_are_those_of_the_digests(spark):
    df = spark.range(500).selectExpr("id % 3 AS g", "CAST(id % 40 AS string) AS k", "id * 0.5 AS v")
    digests = df.select("g", row_digest(["k", "v"]).alias("d")).collect()
    found = {r.g: r for r in lane_sums(df, ["k", "v"], ["g"]).collect()}
    for g in range(3):
        own = [r.d for r in digests if r.g == g]
        assert found[g].row_count == len(own)
        for lane in range(4):
            assert int(found[g][f"lane{lane}"]) == sum(int(d[15 * lane : 15 * lane + 15], 16) for d in own)
    nothing = lane_sums(df.limit(0), ["k"]).first()
    assert nothing.row_count == 0 and int(nothing.lane0) == 0


def test_lanes_are_added_as_longs(spark):
    """One addition of decimals per row and lane took most of the time of a fingerprint."""
    plan = lane_sums(spark.range(3).selectExpr("id AS k"), ["k"])._jdf.queryExecution().optimizedPlan().toString()
    line = next(x for x in plan.splitlines() if "Aggregate" in x)
    assert "sum((shiftright" in line and "sum(cast" not in line
