"""Schemas, silver transforms, sinks and the monthly chain."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stratalake import schemas
from stratalake.contracts import load_contract
from stratalake.layout import Lake, batch_folder, readable
from stratalake.operators.quality import HardQualityFailure
from stratalake.plans import monthly_run, serving
from stratalake.plans.bronze import land, read_bronze
from stratalake.plans.gold import Batch, batch_columns, map_to_gold, publish
from stratalake.plans.monthly_run import months_between, run_backfill, run_month
from stratalake.plans.silver import fx_silver, policy_silver, psa_silver, transform
from stratalake.sinks import write_partitioned, write_snapshots

STAMP = "fetched_at timestamp, batch_id string"
AT = datetime(2024, 6, 1)


# ---------------------------------------------------------------- schemas and paths


def test_registry():
    assert schemas.get_bronze_schema("psa")["series_code"].nullable is False
    assert schemas.get_bronze_schema("psa")["value"].nullable is True
    assert schemas.get_silver_schema("bsp_fx")["rate"].nullable is False
    assert schemas.get_silver_schema("bsp_policy")["overnight_srp"].nullable is True
    assert schemas.get_silver_schema("psa").fieldNames() == [
        "period_date", "period_year", "period_month", "series_code", "value", "unit", "source",
    ]
    for lookup, source in ((schemas.get_bronze_schema, "bsp_policy"), (schemas.get_silver_schema, "x")):
        with pytest.raises(KeyError):
            lookup(source)


def test_schema_hash_ignores_order_and_nullability(spark):
    a = spark.createDataFrame([], "x int, y string")
    b = spark.createDataFrame([], "y string not null, x int")
    assert schemas.schema_hash(a) == schemas.schema_hash(b)
    assert schemas.schema_hash(a) != schemas.schema_hash(spark.createDataFrame([], "x bigint, y string"))


def test_layout(spark, tmp_path):
    lake = Lake("s3a://bucket/")
    assert lake.path("gold/x") == "s3a://bucket/gold/x"
    assert lake.path("s3://other/x") == "s3a://other/x"
    assert batch_folder(date(2024, 1, 5)) == "year=2024/month=01"
    assert not readable(spark, str(tmp_path / "none"))
    spark.range(1).write.parquet(str(tmp_path / "some"))
    assert readable(spark, str(tmp_path / "some"))


# ---------------------------------------------------------------- silver


def _psa(spark, *rows):
    return spark.createDataFrame(
        [(*r[:3], "u", "s", AT, r[3]) for r in rows],
        f"series_code string, period string, value double, unit string, source string, {STAMP}",
    )


def test_psa_silver(spark):
    row = psa_silver(_psa(spark, ("CPI_ALL_ITEMS", "2024M01", 105.2, "b1"))).first()
    assert (row.period_date, row.period_year, row.period_month) == (date(2024, 1, 1), 2024, 1)


def test_psa_silver_keeps_the_newest_copy(spark):
    copies = _psa(spark, ("C", "2024M01", 105.2, "b-001"), ("C", "2024M1", 105.5, "b-002"))
    assert [(r.value) for r in psa_silver(copies).collect()] == [105.5]


def test_psa_silver_keeps_unreadable_periods_for_the_checks(spark):
    rows = psa_silver(_psa(spark, ("C", "2024M13", 1.0, "b"), ("C", "bad", 2.0, "b2"), ("C", "2024M02", 3.0, "b"))).collect()
    assert sorted((str(r.period_date), r.value) for r in rows) == [
        ("2024-02-01", 3.0), ("None", 1.0), ("None", 2.0)
    ]


def test_fx_silver_casts_before_dropping(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "USD/PHP", r, "s", AT, b) for r, b in (("56.3", "a"), (None, "b"), ("broken", "c"))],
        f"rate_date string, currency_pair string, rate string, source string, {STAMP}",
    )
    assert [tuple(r) for r in fx_silver(df).collect()] == [(date(2024, 1, 1), "USD/PHP", 56.3, "s")]


def _policy(spark, *rows):
    return spark.createDataFrame(
        [(d, rp, None, direction, "s", AT, str(i)) for i, (d, rp, direction) in enumerate(rows)],
        f"decision_date string, overnight_rp double, overnight_srp double, direction string, source string, {STAMP}",
    )


def test_policy_silver_dropped_rows_do_not_influence_labels(spark):
    rows = _policy(
        spark,
        ("2024-06-01", 6.5, None),
        ("2024-01-01", 6.0, "hold"),
        ("2024-02-01", 99.0, None),  # out of range
        ("2024-03-01", 6.25, "raised"),  # unknown direction
        ("2024-04-01", 6.0, "cut"),
        ("2030-01-01", 1.0, None),  # future
        ("2024-05-01", 5.75, None),
    )
    silver = policy_silver(rows, as_of=date(2024, 12, 31)).orderBy("decision_date").collect()
    assert [(r.decision_date.month, r.direction) for r in silver] == [(1, "hold"), (4, "hold"), (5, "cut"), (6, "hike")]


def test_unknown_source(spark):
    with pytest.raises(ValueError):
        transform(spark.range(1), "other")


# ---------------------------------------------------------------- sinks


def _months(spark, *rows):
    return spark.createDataFrame(list(rows), "year string, month string, p int, v string")


def _stored(spark, path):
    return sorted((int(r.month), r.p, r.v) for r in spark.read.parquet(path).collect())


def test_dynamic_overwrite_keeps_neighbours(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(_months(spark, ("2024", "01", 1, "a")), path, ["year", "month"])
    write_partitioned(_months(spark, ("2024", "02", 1, "b")), path, ["year", "month"])
    write_partitioned(_months(spark, ("2024", "01", 1, "c")), path, ["year", "month"])
    assert _stored(spark, path) == [(1, 1, "c"), (2, 1, "b")]


def test_shrinking_snapshot_leaves_nothing_behind(spark, tmp_path):
    path = str(tmp_path / "t")
    first = _months(spark, ("2024", "01", 1, "a"), ("2024", "01", 2, "a"), ("2024", "02", 1, "a"), ("2024", "03", None, "a"))
    write_snapshots(first, path, [date(2024, m, 1) for m in (1, 2, 3)], ["p"])
    again = _months(spark, ("2024", "01", 2, "b"))
    write_snapshots(again, path, [date(2024, 1, 1), date(2024, 3, 1)], ["p"])
    assert _stored(spark, path) == [(1, 2, "b"), (2, 1, "a")]


def test_files_are_ascending_inside(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select((F.col("id") % 3).alias("p"), ((F.col("id") * 7919) % 1000).alias("d"))
    write_partitioned(df.repartition(5), path, ["p"], ["d"])
    for p in range(3):
        values = [r.d for r in spark.read.parquet(f"{path}/p={p}").coalesce(1).collect()]
        assert values == sorted(values) and len(values) > 300


# ---------------------------------------------------------------- landing


def _fx(spark, n=24, start=2023):
    rows = [(f"{start + i // 12}-{i % 12 + 1:02d}-01", "USD/PHP", 55.0 + i, "bsp_fixture") for i in range(n)]
    return spark.createDataFrame(rows, "rate_date string, currency_pair string, rate double, source string")


def test_same_content_lands_once(spark, store):
    first = land(store.lake, store, "bsp_fx", _fx(spark), date(2024, 1, 15))
    again = land(store.lake, store, "bsp_fx", _fx(spark).orderBy(F.desc("rate")), date(2024, 2, 1))
    changed = land(store.lake, store, "bsp_fx", _fx(spark, 23), date(2024, 2, 1))
    assert first == again != changed
    assert "/year=2024/month=01/batch_id=" in first
    manifest = store.table("file_manifest").collect()
    assert len(manifest) == 2 and all(row.byte_size > 0 for row in manifest)
    assert read_bronze(store, "bsp_fx", first).count() == 24
    with pytest.raises(ValueError):
        land(store.lake, store, "bsp_fx", _fx(spark).limit(0), date(2024, 1, 1))


def test_failed_landing_does_not_block_the_next(spark, store):
    row = {"source": "bsp_fx", "fetch_date": date(2024, 1, 1), "file_path": "p", "sha256_hash": "h", "batch_id": "b"}
    store.write("file_manifest", [{**row, "status": "FAILED"}])
    assert store.landed_path("bsp_fx", "h") is None
    store.write("file_manifest", [{**row, "status": "SUCCESS", "file_path": "q"}])
    store.write("file_manifest", [{**row, "status": "SUCCESS", "file_path": "later"}])
    assert store.landed_path("bsp_fx", "h") == "q"


# ---------------------------------------------------------------- gold


def _cpi(spark, years):
    rows = [
        (code, f"{y}M{m:02d}", 100.0 + y - 2000 + m / 10, "u", "psa_fixture")
        for code in ("CPI_ALL_ITEMS", "CPI_YOY_CHANGE")
        for y in years
        for m in range(1, 13)
    ]
    return spark.createDataFrame(rows, "series_code string, period string, value double, unit string, source string")


def test_map_to_gold(spark):
    silver = psa_silver(_psa(spark, ("CPI_YOY_CHANGE", "2024M01", 1.0, "b")))
    gold = map_to_gold(silver, "gold_macro_indicators")
    assert gold.columns == ["period", "indicator_code", "value", "source"]
    assert gold.first().indicator_code == "CPI_YOY"


def test_hard_failure_quarantines_and_writes_no_gold(spark, store):
    silver = batch_columns(psa_silver(_psa(spark, *[("C", f"2024M{m:02d}", 1.0, "b") for m in range(1, 10)])), date(2024, 1, 1))
    published = publish(store.lake, silver, load_contract("gold_macro_indicators"), [Batch(date(2024, 1, 1), "r1")])
    outcome = published.outcomes[0]
    assert (outcome.status, outcome.failure_rate, outcome.rejected) == ("PARTIAL", 1.0, 9)
    assert not readable(spark, store.lake.gold("gold_macro_indicators"))
    kept = spark.read.parquet(outcome.quarantine_path)
    assert kept.count() == 9 and "row_count_min_passed" in kept.columns and "is_valid" in kept.columns
    failed = {r["check_name"]: r["failed_count"] for r in published.results}
    assert failed == {"no_nulls": 0, "row_count_min": 9, "value_range": 0}
    with pytest.raises(HardQualityFailure):
        published.raise_for_gate()


def test_missing_contract_columns_reject_rows(spark, store):
    rows = batch_columns(spark.range(30).select(F.lit(date(2024, 1, 1)).alias("period_date"), F.lit(1.0).alias("rate")), date(2024, 1, 1))
    outcome = publish(store.lake, rows, load_contract("gold_exchange_rates"), [Batch(date(2024, 1, 1), "r")]).outcomes[0]
    assert outcome.rejected == 30
    assert spark.read.parquet(outcome.quarantine_path).filter("schema_passed").count() == 0


def test_rows_of_an_unplanned_month_are_refused(spark, store):
    rows = batch_columns(fx_silver(_fx(spark).withColumns({"fetched_at": F.lit(AT), "batch_id": F.lit("b")})), date(2024, 2, 1))
    with pytest.raises(ValueError):
        publish(store.lake, rows, load_contract("gold_exchange_rates"), [Batch(date(2024, 1, 1), "r")])


# ---------------------------------------------------------------- chain


def test_seed_sized_inputs_against_their_minimum(spark, store):
    """48 price rows are below the minimum of 100; 24 rates are above 20."""
    assert run_month(store, "psa", _cpi(spark, (2023, 2024)), date(2024, 1, 15)).status == "PARTIAL"
    assert run_month(store, "bsp_fx", _fx(spark), date(2024, 1, 15)).status == "SUCCESS"
    runs = {r.source: r for r in store.runs().collect()}
    assert (runs["psa"].records_ingested, runs["psa"].records_rejected) == (0, 48)
    assert "above the threshold" in runs["psa"].error_message
    assert (runs["bsp_fx"].records_ingested, runs["bsp_fx"].status) == (24, "SUCCESS")
    # A partial run is not done: it is tried again. A successful one is skipped.
    assert run_month(store, "psa", _cpi(spark, range(2015, 2025)), date(2024, 1, 20)).status == "SUCCESS"
    assert run_month(store, "bsp_fx", _fx(spark), date(2024, 1, 20)).status == "SKIPPED"
    assert run_month(store, "bsp_fx", _fx(spark), date(2024, 1, 20), backfill=True).status == "SUCCESS"

    versions = {r.dataset_name: r for r in store.datasets().collect()}
    assert versions["gold_macro_indicators"].row_count == 240
    assert versions["gold_exchange_rates"].partition_key == "year=2024/month=01"
    assert store.quality("gold_exchange_rates").filter("passed").count() == 6

    run_id = store.runs("psa", 1).first().run_id
    detail = store.run(run_id).first()
    assert [(s.stage_name, s.input_rows, s.output_rows) for s in detail.stage_metrics] == [
        ("ingest", 240, 240), ("transform", 240, 240), ("quality", 240, 240),
    ]
    assert [q.check_name for q in detail.quality_results] == ["no_nulls", "row_count_min", "value_range"]
    assert store.lineage(run_id).first().s3_path == versions["gold_macro_indicators"].s3_path
    assert store.run("unknown").count() == 0 and store.lineage("unknown").count() == 0

    table = store.table("dataset_versions")
    trend = serving.trend_of_latest(spark, store.lake, table)
    assert trend.count() == 120
    assert tuple(trend.filter("period = '2023-01'").first()) == ("2023-01", 123.1, 123.1, 55.0)
    meta = serving.latest_meta(table, "gold_exchange_rates").first()
    assert meta.row_count == 24 and "T" in meta.created_at
    with pytest.raises(LookupError):
        serving.latest_meta(table, "gold_other")


def test_policy_chain_ends_in_silver(spark, store):
    records = _policy(spark, ("2024-01-05", 6.0, None), ("2024-03-05", 6.5, None)).drop("fetched_at", "batch_id")
    assert run_month(store, "bsp_policy", records, date(2024, 3, 31), as_of=date(2024, 12, 31)).status == "SUCCESS"
    rows = spark.read.parquet(store.lake.silver("bsp_policy")).orderBy("decision_date").collect()
    assert [(r.direction, r.decision_year, r.decision_month) for r in rows] == [("hold", 2024, 1), ("hike", 2024, 3)]


def test_backfill_is_repeatable_and_shrinks(spark, store):
    assert months_between(date(2023, 11, 9), date(2024, 2, 1))[0] == date(2023, 11, 1)
    first = run_backfill(store, "bsp_fx", _fx(spark, 30), date(2024, 1, 1), date(2024, 3, 1))
    assert [r.status for r in first] == ["SUCCESS"] * 3
    gold = spark.read.parquet(store.lake.gold("gold_exchange_rates"))
    assert {(r["month"], r["count"]) for r in gold.groupBy("month").count().collect()} == {(1, 30), (2, 30), (3, 30)}
    run_backfill(store, "bsp_fx", _fx(spark, 22), date(2024, 2, 1), date(2024, 2, 1))
    gold = spark.read.parquet(store.lake.gold("gold_exchange_rates"))
    assert {(r["month"], r["count"]) for r in gold.groupBy("month").count().collect()} == {(1, 30), (2, 22), (3, 30)}


def test_silver_without_rows(spark, store):
    empty_rates = _fx(spark).withColumn("rate", F.lit(None).cast("double"))
    assert run_month(store, "bsp_fx", empty_rates, date(2024, 1, 1)).status == "FAILED"
    run = store.runs().first()
    assert run.records_ingested == 0 and "no rows" in run.error_message
    assert store.table("dataset_versions").count() == 0 and not store.batch_processed("bsp_fx", date(2024, 1, 1))
    with pytest.raises(ValueError):
        run_backfill(store, "bsp_fx", _fx(spark), date(2030, 1, 1), date(2030, 2, 1), batch_date="rate_date")


def test_failed_run_is_recorded(spark, store):
    with pytest.raises(ValueError):
        run_month(store, "bsp_fx", _fx(spark).limit(0), date(2024, 1, 1))
    run = store.runs().first()
    assert run.status == "FAILED" and "empty" in run.error_message and run.ended_at is not None


def test_nothing_to_serve_yet(spark, store):
    with pytest.raises(serving.NoSnapshot):
        serving.latest_snapshot(spark, store.lake, store.table("dataset_versions"), "gold_exchange_rates")


def test_empty_month_of_a_backfill_keeps_its_gold(spark, store):
    months = [f"2024-{m:02d}-{d:02d}" for m in (1, 2, 3) for d in range(1, 26)]
    records = spark.createDataFrame(
        [(m, "USD/PHP", 56.0, "s") for m in months], "rate_date string, currency_pair string, rate double, source string"
    )
    span = (date(2024, 1, 1), date(2024, 3, 1))
    run_backfill(store, "bsp_fx", records, *span, batch_date="rate_date")
    bad = spark.createDataFrame([("n/a", "USD/PHP", 1.0, "s")], records.schema)
    again = records.filter("rate_date NOT LIKE '2024-03%'").union(bad)
    results = run_backfill(store, "bsp_fx", again, *span, batch_date="rate_date")
    assert [r.status for r in results] == ["SUCCESS", "SUCCESS", "FAILED"]
    gold = spark.read.parquet(store.lake.gold("gold_exchange_rates"))
    assert {(r["month"], r["count"]) for r in gold.groupBy("month").count().collect()} == {(1, 25), (2, 25), (3, 25)}
    assert store.table("dataset_versions").count() == 5
    checks = store.table("quality_results").filter(f"run_id = '{results[2].run_id}'").collect()
    assert {r.check_name: r.passed for r in checks}["row_count_min"] is False
    served = serving.latest_snapshot(spark, store.lake, store.table("dataset_versions"), "gold_exchange_rates")
    assert served.count() == 25
    undated = spark.read.option("recursiveFileLookup", True).parquet(store.lake.quarantine("bsp_fx"))
    assert [r.rate_date for r in undated.collect()] == ["n/a"]


def test_backfill_lands_a_content_once(spark, store):
    span = (date(2024, 1, 1), date(2024, 3, 1))
    for _ in range(2):
        results = run_backfill(store, "bsp_fx", _fx(spark, 30), *span)
        assert [r.status for r in results] == ["SUCCESS"] * 3
    manifest = store.table("file_manifest").collect()
    assert len(manifest) == 1 and manifest[0].byte_size > 0 and manifest[0].fetch_date == date(2024, 1, 1)
    assert spark.read.parquet(store.lake.bronze("bsp_fx")).count() == 30
    gold = spark.read.parquet(store.lake.gold("gold_exchange_rates"))
    assert {(r["month"], r["count"]) for r in gold.groupBy("month").count().collect()} == {(1, 30), (2, 30), (3, 30)}


def test_large_backfill_conforms_in_parts(spark, store, monkeypatch):
    monkeypatch.setattr(monthly_run, "_TASK_ROWS", 20)
    parts, original = [], monthly_run.transform

    def counted(rows, *args, **options):
        ids = rows.groupBy(F.spark_partition_id()).count().collect()
        parts.append([r["count"] for r in ids])
        return original(rows, *args, **options)

    monkeypatch.setattr(monthly_run, "transform", counted)
    results = run_backfill(store, "bsp_fx", _fx(spark, 200), date(2024, 1, 1), date(2024, 2, 1))
    assert [r.status for r in results] == ["SUCCESS"] * 2
    assert sum(parts[0]) == 200 and len(parts[0]) >= 5 and max(parts[0]) < 100
    assert [r.records_ingested for r in store.table("pipeline_runs").collect()] == [200, 200]


def test_copies_of_a_key_are_pruned_before_they_are_sorted(spark, store, monkeypatch):
    given, original = [], monthly_run.transform

    def counted(rows, *args, **options):
        given.append(rows.count())
        return original(rows, *args, **options)

    monkeypatch.setattr(monthly_run, "transform", counted)
    rows = [
        (f"2024-0{m}-{d:02d}", "USD/PHP", None if copy == 0 else 50.0 + copy, "s")
        for m in (1, 2) for d in range(1, 26) for copy in range(20)
    ]
    records = spark.createDataFrame(rows, "rate_date string, currency_pair string, rate double, source string")
    results = run_backfill(store, "bsp_fx", records, date(2024, 1, 1), date(2024, 2, 1), batch_date="rate_date")
    assert [r.status for r in results] == ["SUCCESS"] * 2
    assert given == [50]
    gold = spark.read.parquet(store.lake.gold("gold_exchange_rates"))
    assert [r.rate for r in gold.collect()] == [69.0] * 50


def test_content_of_another_month_is_read_beside_own_ones(spark, store):
    """February's content landed under January before, March has a content of its own."""
    schema = "rate_date string, currency_pair string, rate double, source string, batch date"
    days = [(f"2023-12-{d:02d}", "USD/PHP", 56.0, "s") for d in range(1, 26)]
    other = [(f"2023-12-{d:02d}", "USD/PHP", 57.0, "s") for d in range(1, 27)]
    first = spark.createDataFrame([(*r, date(2024, 1, 1)) for r in days], schema)
    run_backfill(store, "bsp_fx", first, date(2024, 1, 1), date(2024, 1, 1), batch_date="batch")
    again = [(*r, date(2024, 2, 1)) for r in days] + [(*r, date(2024, 3, 1)) for r in other]
    span = (date(2024, 2, 1), date(2024, 3, 1))
    run_backfill(store, "bsp_fx", spark.createDataFrame(again, schema), *span, batch_date="batch")
    gold = spark.read.parquet(store.lake.gold("gold_exchange_rates"))
    found = {(r["month"], r["rate"], r["count"]) for r in gold.groupBy("month", "rate").count().collect()}
    assert found == {(1, 56.0, 25), (2, 56.0, 25), (3, 57.0, 26)}
    assert store.table("file_manifest").count() == 2


def test_date_of_a_batch_is_computed_once(spark, store, monkeypatch):
    plans, original = [], monthly_run.PendingBatch

    def planned(lake, store, source, rows, *args, **options):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return original(lake, store, source, rows, *args, **options)

    monkeypatch.setattr(monthly_run, "PendingBatch", planned)
    records = _fx(spark, 30).withColumn("rate_date", F.date_format(F.to_date("rate_date"), "yyyy-MM-dd"))
    run_backfill(store, "bsp_fx", records, date(2024, 1, 1), date(2024, 2, 1), batch_date="rate_date")
    filters = [line for line in plans[0].splitlines() if "Filter" in line]
    assert filters and not any("date_format" in line for line in filters)
