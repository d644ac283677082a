"""Operators against small brute-force models."""

import random
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.operators import columns, filters
from stratalake.operators.audit import column_violations, duplicate_keys, key_rule, orphans, reference_rule
from stratalake.operators.change import classify_change
from stratalake.operators.latest import latest_per_key, newest, newest_first
from stratalake.operators.merge import coalesce_update, fold_patches, insert_absent, upsert_latest
from stratalake.operators.monthly import monthly_trend, monthly_trend_outer, unpivot_months


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_projection_operators(spark):
    df = spark.createDataFrame([(1, "a", "x")], "id int, name string, extra string")
    assert columns.rename(df, {"name": "label", "absent": "y"}).columns == ["id", "label", "extra"]
    assert columns.keep(df, ["name", "missing", "id"]).columns == ["name", "id"]
    assert columns.drop(df, ["extra"]).columns == ["id", "name"]
    assert columns.stamp(df, {"batch": "b1"}).first().batch == "b1"
    assert columns.safe_cast(df, {"name": "double"}).first().name is None
    assert columns.missing_columns(["id", "z"], df.columns) == {"z"}
    once = columns.computed_once(df, {"upper": F.upper("name"), "n": F.col("id") + 1})
    assert tuple(once.first()) == (1, "a", "x", "A", 2)


def test_recode_passes_unknown_codes_through(spark):
    df = spark.createDataFrame([("CPI_ALL_ITEMS",), ("OTHER",), (None,)], "c string")
    recoded = columns.recode(df, "c", {"CPI_ALL_ITEMS": "CPI_ALL"})
    assert {r.c for r in recoded.collect()} == {"CPI_ALL", "OTHER", None}
    lookup = spark.createDataFrame([("CPI_ALL_ITEMS", "CPI_ALL")], "o string, n string")
    assert {r.c for r in columns.recode_from(df, "c", lookup, "o", "n").collect()} == {"CPI_ALL", "OTHER", None}
    many = {f"k{i}": f"v{i}" for i in range(5000)} | {"OTHER": "found"}
    assert {r.c for r in columns.recode(df, "c", many).collect()} == {"CPI_ALL_ITEMS", "found", None}


def test_filters(spark):
    df = spark.createDataFrame(
        [(1, 0.5, "hike", "2010"), (2, 20.1, "cut", "2009"), (3, None, "pause", "year")],
        "id int, rp double, d string, y string",
    )

    def ids(f):
        return sorted(r.id for r in f.collect())

    assert ids(filters.in_range(df, "rp", 0.5, 20.0)) == [1]
    assert ids(filters.in_set(df, "d", ["hike", "cut"])) == [1, 2]
    assert ids(filters.min_year(df, "y", 2010)) == [1]
    assert ids(filters.drop_null(df, "rp")) == [1, 2]
    assert ids(filters.by_value(df, "d", None)) == [1, 2, 3]
    assert ids(filters.by_value(df, "d", "cut")) == [2]
    dated = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2999, 1, 1))], "id int, d date")
    assert ids(filters.not_after(dated, "d", date(2024, 1, 1))) == [1]
    assert ids(filters.not_after(dated, "d")) == [1]
    with pytest.raises(LookupError):
        filters.allowed("nope", ["gold_a"])


def test_split_loses_nothing(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, ok boolean")
    yes, no = filters.split(df, "ok")
    assert [r.id for r in yes.collect()] == [1]
    assert sorted(r.id for r in no.collect()) == [2, 3]


def test_latest_per_key_is_repeatable_under_ties(spark):
    rows = [("k", 1, "a"), ("k", 1, "b"), ("k", 0, "z"), ("j", None, "n")]
    for seed in range(3):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, "k string, t int, v string").repartition(3)
        assert _rows(latest_per_key(df, ["k"], ["t"]).na.fill(-1)) == [("j", -1, "n"), ("k", 1, "b")]


def test_newest_bounds(spark):
    df = spark.range(30).withColumnRenamed("id", "started_at")
    assert [r[0] for r in newest(df, newest_first(["started_at"]), 3, 100).collect()] == [29, 28, 27]
    for limit in (0, 101):
        with pytest.raises(ValueError):
            newest(df, newest_first(["started_at"]), limit, 100)


def _directions(rows):
    """Brute force: sort each series and compare neighbours."""
    out, previous = [], {}
    for series, day, rate in sorted(rows):
        last = previous.get(series)
        word = "hold" if last is None or rate == last else "hike" if rate > last else "cut"
        out.append((series, day, word))
        previous[series] = rate
    return sorted(out)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(
        st.tuples(st.sampled_from(["hot", "b"]), st.dates(date(2019, 11, 1), date(2024, 3, 1))),
        st.sampled_from([1.0, 2.0, 2.5]),
        min_size=1,
        max_size=60,
    )
)
def test_split_change_equals_brute_force(spark, data):
    rows = [(s, d, r) for (s, d), r in data.items()]
    df = spark.createDataFrame(rows, "series string, day date, rate double")
    month = F.trunc("day", "month")
    for buckets in ([], [month], [F.year("day"), month, F.col("day")]):
        got = classify_change(df, ["series"], ["day"], "rate", buckets)
        assert _rows(got.select("series", "day", "direction")) == _directions(rows)


def test_split_change_over_one_global_series(spark):
    rows = [("x", date(2020 + i // 12, i % 12 + 1, 1), float(i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "series string, day date, rate double").drop("series")
    got = classify_change(df, [], ["day"], "rate", [F.year("day")]).select(F.lit("x"), "day", "direction")
    assert _rows(got) == _directions(rows)


def test_split_change_of_a_series_without_a_name(spark):
    rows = [(None if i % 2 else "-", date(2020 + i // 6, i % 12 + 1, 1), float(i % 5)) for i in range(48)]
    df = spark.createDataFrame(rows, "series string, day date, rate double")
    got = classify_change(df, ["series"], ["day"], "rate", [F.year("day"), F.col("day")])
    plain = classify_change(df, ["series"], ["day"], "rate")
    assert got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0 and got.columns == plain.columns


def test_upserts(spark):
    target = spark.createDataFrame([(1, 10, "old"), (2, 10, "keep")], "k int, t int, v string")
    updates = spark.createDataFrame([(1, 11, "new"), (1, 12, "newest"), (2, 9, "late"), (3, 1, "first")], "k int, t int, v string")
    assert _rows(upsert_latest(target, updates, ["k"], ["t"])) == [(1, 12, "newest"), (2, 10, "keep"), (3, 1, "first")]
    assert _rows(insert_absent(target, updates.unionByName(updates), ["k"], ["t"])) == [(3, 1, "first")]


def test_coalesce_update_and_fold_agree(spark):
    target = spark.createDataFrame([(1, "RUNNING", None), (2, "RUNNING", 5)], "k int, status string, n int")
    patch = spark.createDataFrame([(1, "SUCCESS", None), (2, None, 7)], "k int, status string, n int")
    expected = [(1, "SUCCESS", None), (2, "RUNNING", 7)]
    assert sorted(tuple(r) for r in coalesce_update(target, patch, ["k"]).collect()) == expected
    log = target.withColumn("s", F.lit(1)).unionByName(patch.withColumn("s", F.lit(2)))
    folded = fold_patches(log, ["k"], "s").select("k", "status", "n")
    assert sorted((tuple(r) for r in folded.collect()), key=lambda r: r[0]) == expected


def test_monthly_trend_keeps_unmatched_months_of_both_sides(spark):
    macro = spark.createDataFrame(
        [
            (date(2024, 1, 1), "CPI_ALL", 1.0, "s"),
            (date(2024, 1, 1), "CPI_YOY", 2.0, "s"),
            (date(2024, 1, 1), "OTHER", 9.0, "s"),
            (date(2024, 2, 1), "CPI_ALL", 3.0, "s"),
        ],
        "period date, indicator_code string, value double, source string",
    )
    fx = spark.createDataFrame(
        [(date(2024, 1, 3), 50.0), (date(2024, 1, 20), 51.0), (date(2024, 3, 1), 52.0)], "period date, rate double"
    )
    expected = [("2024-01", 1.0, 2.0, 51.0), ("2024-02", 3.0, None, None), ("2024-03", None, None, 52.0)]
    for trend in (monthly_trend, monthly_trend_outer):
        result = trend(macro, fx)
        assert result.columns == ["period", "CPI_ALL", "CPI_YOY", "USD/PHP"]
        assert [tuple(r) for r in result.collect()] == expected


def test_unpivot_months(spark):
    months = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
    wide = spark.createDataFrame(
        [(2024, *[None if i == 1 else float(i) for i in range(12)])], "year int, " + ", ".join(f"{m} double" for m in months)
    )
    rows = _rows(unpivot_months(wide, "year"))
    assert len(rows) == 11
    assert rows[0] == (date(2024, 1, 1), 0.0) and rows[-1] == (date(2024, 12, 1), 11.0)


def test_audit_rules(spark):
    runs = spark.createDataFrame([("r1", "SUCCESS"), ("r1", "BROKEN"), (None, None)], "run_id string, status string")
    found = column_violations(runs, ["run_id"], {"status": ["SUCCESS", "FAILED"]})
    assert _rows(found) == [("enum:status", 1), ("not_null:run_id", 1)]
    assert _rows(duplicate_keys(runs, ["run_id"])) == [("r1", 2)]
    assert key_rule(runs, ["run_id"]).first().violations == 1
    stages = spark.createDataFrame([("r1",), ("r9",), ("r9",), (None,)], "run_id string")
    assert _rows(orphans(stages, runs, "run_id", "run_id")) == [("r9", 2)]
    assert reference_rule(stages, runs, "run_id", "run_id").first().violations == 2
    assert key_rule(runs.limit(0), ["run_id"]).first().violations == 0


def test_timestamps_are_compared_not_text(spark):
    df = spark.createDataFrame(
        [("d", datetime(2024, 2, 1), 1), ("d", datetime(2024, 10, 1), 2)], "k string, t timestamp, v int"
    )
    assert latest_per_key(df, ["k"], ["t"]).first().v == 2
