"""Metadata queries on a few runs."""

from datetime import date, datetime

import pytest

from stratalake.layout import data_files
from stratalake.plans import metadata as md


@pytest.fixture
def tables(spark):
    runs = spark.createDataFrame(
        [
            ("r1", "psa", "SUCCESS", datetime(2024, 1, 1), datetime(2024, 1, 1, 1)),
            ("r2", "psa", "PARTIAL", datetime(2024, 2, 1), datetime(2024, 2, 1, 1)),
            ("r3", "bsp_fx", "SUCCESS", datetime(2024, 3, 1), datetime(2024, 3, 1, 1)),
            ("r4", "psa", "SUCCESS", datetime(2024, 4, 1), datetime(2024, 4, 1, 1)),
        ],
        "run_id string, source string, status string, started_at timestamp, ended_at timestamp",
    )
    results = spark.createDataFrame(
        [(i, r, c, True) for i, (r, c) in enumerate((r, c) for r in ("r1", "r2", "r4") for c in ("a", "b", "c"))],
        "id bigint, run_id string, check_name string, passed boolean",
    )
    versions = spark.createDataFrame(
        [
            (1, "r1", "gold", datetime(2024, 1, 1)),
            (2, "r1", "gold", datetime(2024, 1, 2)),
            (3, "r4", "gold", datetime(2024, 1, 2)),
            (4, "r2", "gold", datetime(2023, 1, 2)),
            (5, "r3", "rates", datetime(2024, 3, 1)),
        ],
        "id bigint, run_id string, dataset_name string, created_at timestamp",
    )
    return runs, results, versions


def test_list_runs(tables):
    runs = tables[0]
    assert [r.run_id for r in md.list_runs(runs).collect()] == ["r4", "r3", "r2", "r1"]
    assert [r.run_id for r in md.list_runs(runs, "psa", 2).collect()] == ["r4", "r2"]
    for limit in (0, 101):
        with pytest.raises(ValueError):
            md.list_runs(runs, limit=limit)


def test_latest_version_breaks_ties_by_id(tables):
    rows = {r.dataset_name: r.id for r in md.latest_versions(tables[2]).collect()}
    assert rows == {"gold": 3, "rates": 5}


def test_quality_history_has_no_multiplied_rows(tables):
    runs, results, versions = tables
    history = md.quality_history(results, runs, versions, "gold").collect()
    assert [r.run_id for r in history] == ["r4"] * 3 + ["r1"] * 3
    latest = md.quality_latest(results, runs, versions, "gold").collect()
    assert {r.run_id for r in latest} == {"r4"} and len(latest) == 3


def test_detail_has_empty_lists(spark, tables):
    runs, results, _ = tables
    stages = spark.createDataFrame([], "id bigint, run_id string, stage_name string, started_at timestamp")
    detail = {r.run_id: r for r in md.run_detail(runs, stages, results).collect()}
    assert detail["r3"].stage_metrics == [] and detail["r3"].quality_results == []
    assert [q.check_name for q in detail["r1"].quality_results] == ["a", "b", "c"]


def test_pending_batches(spark):
    planned = spark.createDataFrame([("psa", date(2024, m, 15)) for m in (1, 2, 3)], "source string, batch_date date")
    done = spark.createDataFrame([("psa", date(2024, 2, 1)), ("bsp_fx", date(2024, 1, 1))], "source string, batch_date date")
    left = md.pending_batches(planned, done)
    assert sorted(r.batch_date for r in left.collect()) == [date(2024, 1, 1), date(2024, 3, 1)]
    assert md.pending_batches(planned, done, backfill=True).count() == 3


def test_store_keeps_values_a_later_patch_leaves_out(store):
    run_id = store.create_run("psa", date(2024, 1, 15))
    assert store.runs().first().status == "RUNNING"
    store.update_run(run_id, "SUCCESS", records_ingested=5)
    store.update_run(run_id, "SUCCESS", records_rejected=1)
    run = store.runs().first()
    assert (run.status, run.records_ingested, run.records_rejected, run.source) == ("SUCCESS", 5, 1, "psa")
    store.mark_processed("psa", [(date(2024, 1, 15), "a"), (date(2024, 1, 31), "b")])
    assert [tuple(r)[:3] for r in store.table("processed_batches").collect()] == [("psa", date(2024, 1, 1), "b")]
    assert store.batch_processed("psa", date(2024, 1, 9)) and not store.batch_processed("psa", date(2024, 2, 1))


def test_long_logs_fold_into_several_files(store, monkeypatch):
    monkeypatch.setattr(md, "_FOLDED_ROWS", 10)
    for status in ("RUNNING", "SUCCESS"):
        store.write("pipeline_runs", [{"run_id": f"r{i}", "status": status} for i in range(40)])
    assert store.fold("pipeline_runs") == 2
    generation = store._generations("pipeline_runs")[0]
    sizes = [store.spark.read.parquet(f).count() for f in data_files(store.spark, f"{generation}/rows")]
    assert sum(sizes) == 80 and max(sizes) <= 20
    runs = store.table("pipeline_runs").collect()
    assert sorted((r.run_id, r.status) for r in runs) == sorted((f"r{i}", "SUCCESS") for i in range(40))


def test_files_of_many_rows_are_dealt_out_before_they_are_sorted(store):
    store.write("pipeline_runs", [{"run_id": "r", "status": "RUNNING"}])
    plan = store.table("pipeline_runs")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan[plan.rindex("Sort ["):]
