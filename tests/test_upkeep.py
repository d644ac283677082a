"""Upserts, key index, labels, trend and fingerprints kept up to date, folded logs, landing."""

import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stratalake.functions.digest import fingerprint
from stratalake.layout import children, data_files, delete_folder, folder_exists
from stratalake.operators.change import classify_change
from stratalake.plans import bronze as landing
from stratalake.plans.bronze import land, read_bronze
from stratalake.plans.upkeep import LabelledSeries, StoredFingerprints, StoredTrend
from stratalake.session import staged
from stratalake.sinks import write_disjoint, write_partitioned
from stratalake.sinks import upsert as upserts
from stratalake.sinks.upsert import KeyIndex, upsert_partitions

FX = "rate_date string, currency_pair string, rate double, source string"


def _names(spark, folder):
    return {f.rsplit("/", 1)[-1] for f in data_files(spark, folder)}


# ---------------------------------------------------------------- upserts


def _stored(spark, path):
    rows = spark.createDataFrame([(k, f"p{k % 4}", k * 1.0, 1) for k in range(40)], "k int, p string, v double, at int")
    write_partitioned(rows, path, ["p"])


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    _stored(spark, path)
    before = {p: _names(spark, f"{path}/p=p{p}") for p in range(4)}
    updates = spark.createDataFrame(
        [(1, "p1", -1.0, 2), (5, "p1", -5.0, 0), (9, "p1", -9.0, 1), (99, "p1", 99.0, 0), (7, None, 7.0, 0)],
        "k int, p string, v double, at int",
    )
    touched = upsert_partitions(spark, path, updates, ["p"], ["k", "p"], ["at"], ["k"])
    assert touched == ["p=__HIVE_DEFAULT_PARTITION__", "p=p1"]
    for p in (0, 2, 3):
        assert _names(spark, f"{path}/p=p{p}") == before[p]
    assert not _names(spark, f"{path}/p=p1") & before[1]
    rows = {(r.k, r.p): r.v for r in spark.read.parquet(path).collect()}
    want = {(k, f"p{k % 4}"): k * 1.0 for k in range(40)}
    want |= {(1, "p1"): -1.0, (9, "p1"): -9.0, (99, "p1"): 99.0, (7, None): 7.0}
    assert rows == want  # an older update loses, an equally old one wins
    assert not children(spark, f"{path}/_upserts")


def test_upsert_reads_touched_folders_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    _stored(spark, path)
    seen = []
    original = upserts.read_evolved
    monkeypatch.setattr(upserts, "read_evolved", lambda *a: seen.append(original(*a)) or seen[-1])
    updates = spark.createDataFrame([(2, "p2", 0.0, 9)], "k int, p string, v double, at int")
    upsert_partitions(spark, path, updates, ["p"], ["k", "p"], ["at"])
    assert len(seen) == 1
    schema = "k int, v double, at int, p string"
    assert spark.read.schema(schema).parquet(path).filter("k = 2").first().v == 0.0
    assert all("/p=p2/" in f for f in seen[0].inputFiles())


def test_interrupted_upsert_is_finished_by_its_repetition(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    _stored(spark, path)
    updates = spark.createDataFrame([(k, f"p{k % 4}", -1.0, 5) for k in range(40)], "k int, p string, v double, at int")
    moved = []

    def stop_after_two(session, folder, to):
        if len(moved) == 2:
            raise OSError("lost")
        moved.append(to)
        original(session, folder, to)

    original = upserts.move_folder
    with monkeypatch.context() as patch:
        patch.setattr(upserts, "move_folder", stop_after_two)
        with pytest.raises(OSError):
            upsert_partitions(spark, path, updates, ["p"], ["k", "p"], ["at"], job_id="j")
    upsert_partitions(spark, path, updates.limit(0), ["p"], ["k", "p"], ["at"], job_id="j")
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 40 and all(r.v == -1.0 for r in rows)


def test_upsert_evolves_the_schema_and_refuses_moving_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    _stored(spark, path)
    updates = spark.createDataFrame([(1, "p1", 3, 7, "new")], "k bigint, p string, v int, at int, note string")
    upsert_partitions(spark, path, updates, ["p"], ["k", "p"], ["at"])
    rows = {r.k: r for r in spark.read.parquet(f"{path}/p=p1").collect()}
    assert rows[1].note == "new" and rows[1].v == 3.0 and rows[5].note is None
    with pytest.raises(ValueError, match="not part of the key"):
        upsert_partitions(spark, path, updates, ["p"], ["k"], ["at"])


def test_index_reads_hit_buckets_only(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "i"), ["k", "t"], buckets=16)
    stored = spark.range(500).selectExpr("id AS k", "CAST(id AS string) AS t")
    index.build(stored)
    few = spark.createDataFrame([(3, "3", 1), (700, None, 2), (700, None, 1), (None, "x", 1)], "k long, t string, age int")
    absent = index.absent(few, ["age"])
    assert sorted((r.k or 0, r.t or "", r.age) for r in absent.collect()) == [(0, "x", 1), (700, "", 1)]
    plan = absent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket#" in plan and "bucket" in plan.split("PartitionFilters:")[1][:60]
    hit = {r["_bucket"] for r in absent.select("_bucket").collect()} | {
        r["_bucket"] for r in index._keyed(few).select("_bucket").collect()
    }
    pruned = re.search(r"PartitionFilters: \[bucket#\d+ IN \(([\d,]+)\)\]", plan).group(1)
    assert {int(b) for b in pruned.split(",")} == hit and len(hit) < 16


def test_repeated_insert_adds_nothing(spark, tmp_path):
    target, index = str(tmp_path / "t"), KeyIndex(spark, str(tmp_path / "i"), ["k"], buckets=4)
    rows = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "c", 1), (None, "d", 1)], "k int, v string, age int")
    for job in ("one", "one", "two"):
        index.insert(rows, target, ["age"], job)
    got = spark.read.schema("k int, v string, age int").parquet(target).collect()
    assert sorted((r.k or 0, r.v) for r in got) == [(0, "d"), (1, "b"), (2, "c")]


def test_interrupted_insert_is_finished_by_its_repetition(spark, tmp_path, monkeypatch):
    target, index = str(tmp_path / "t"), KeyIndex(spark, str(tmp_path / "i"), ["k"], buckets=4)
    rows = spark.range(50).selectExpr("id AS k", "1 AS age")

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(KeyIndex, "_write", lost)
        with pytest.raises(OSError):
            index.insert(rows, target, ["age"], "j")
    index.insert(rows, target, ["age"], "j")
    index.insert(rows, target, ["age"], "k")
    assert spark.read.schema("k bigint").parquet(target).count() == 50


# ---------------------------------------------------------------- labels and trend


def test_late_rows_equal_a_full_relabelling(spark, tmp_path):
    rng = random.Random(5)
    days = [date(2010, 1, 1) + timedelta(days=rng.randrange(3000)) for _ in range(300)]
    rows = {(rng.choice(["a", "b", None]), d): float(rng.randrange(5)) for d in days}
    split = sorted(rows, key=str)
    rng.shuffle(split)
    first = [(*k, rows[k]) for k in split[:200]]
    batches = [[(*k, rows[k]) for k in split[200:203]], [(*k, rows[k]) for k in split[203:]]]
    batches.append([("a", date(2012, 5, 5), 9.0), (None, date(1990, 1, 1), 1.0), ("c", date(2013, 1, 1), 2.0)])
    schema = "series string, day date, rate double"
    stored = LabelledSeries(spark, str(tmp_path), ["series"], "day", "rate")
    stored.build(spark.createDataFrame(first, schema))
    known = {(s, d): v for s, d, v in first}
    for batch in batches:
        before = {f for f in data_files(spark, stored.rows_path)}
        years = stored.apply(spark.createDataFrame(batch, schema))
        known |= {(s, d): v for s, d, v in batch}
        for file in before - {f for f in data_files(spark, stored.rows_path)}:
            assert int(file.split("/year=")[1][:4]) in years
        whole = spark.createDataFrame([(*k, v) for k, v in known.items()], schema)
        want = classify_change(whole, ["series"], ["day"], "rate", [F.year("day")])
        got = stored.rows().select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert len(years) <= 6


def test_refresh_reads_the_months_concerned(spark, tmp_path):
    macro = spark.createDataFrame(
        [(date(2024, m, 1), "CPI_ALL", float(m)) for m in range(1, 7)], "period date, indicator_code string, value double"
    ).withColumn("month", F.date_format("period", "yyyy-MM"))
    fx = spark.createDataFrame([(date(2024, m, 9), 50.0 + m) for m in range(3, 9)], "period date, rate double")
    fx = fx.withColumn("month", F.date_format("period", "yyyy-MM"))
    trend = StoredTrend(spark, str(tmp_path / "trend"))
    trend.build(macro, fx)
    write_partitioned(macro.withColumn("value", F.col("value") * 10), str(tmp_path / "m"), ["month"])
    write_partitioned(fx.filter("month != '2024-08'"), str(tmp_path / "f"), ["month"])
    stored = [
        spark.read.schema("period date, indicator_code string, value double, month string").parquet(str(tmp_path / "m")),
        spark.read.schema("period date, rate double, month string").parquet(str(tmp_path / "f")),
    ]
    for _ in range(3):
        trend.refresh(*stored, ["2024-02", "2024-08"])
    rows = {r.period: (r["CPI_ALL"], r["USD/PHP"]) for r in trend.current().collect()}
    assert rows == {f"2024-{m:02d}": (20.0 if m == 2 else float(m) if m < 7 else None, 50.0 + m if m > 2 else None) for m in range(1, 8)}
    assert len(children(spark, str(tmp_path / "trend"))) == 2


def test_merged_fingerprints_equal_those_of_the_rows(spark, tmp_path):
    rows = spark.range(400).selectExpr("id % 3 AS a", "CAST(id % 5 AS string) AS b", "id", "IF(id % 7 = 0, NULL, 'x') AS t")
    prints = StoredFingerprints(spark, str(tmp_path / "p"), ["a_part", "b_part"], ["id", "t"])
    parts = rows.selectExpr("a AS a_part", "b AS b_part", "id", "t")
    prints.update(parts)
    changed = parts.filter("b_part = '2'").withColumn("id", -F.col("id"))
    prints.update(changed)
    now = parts.filter("b_part != '2'").unionByName(changed)
    assert prints.fingerprint().collect() == fingerprint(now, ["id", "t"]).collect()
    want = fingerprint(now.withColumn("a_part", F.col("a_part").cast("string")), ["id", "t"], ["a_part"])
    assert sorted(prints.fingerprint(["a_part"]).collect()) == sorted(want.collect())


# ---------------------------------------------------------------- files


def test_files_do_not_overlap(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = spark.range(6000).selectExpr(
        "IF(id < 4000, 'hot', 'cold') AS p",
        "CASE WHEN id < 1500 THEN 7 WHEN id % 50 = 0 THEN NULL ELSE CAST(id % 40 AS int) END AS day",
        "id",
    )
    write_disjoint(rows, path, ["p"], "day", 300)
    stored = spark.read.parquet(path)
    assert stored.count() == 6000 and stored.select("id").distinct().count() == 6000
    files = stored.groupBy("p", F.col("_metadata.file_name").alias("f")).agg(
        F.min("day").alias("lo"), F.max("day").alias("hi"), F.count("*").alias("n")
    )
    by_part = {}
    for r in files.collect():
        by_part.setdefault(r.p, []).append((-1 if r.lo is None else r.lo, -1 if r.hi is None else r.hi, r.n))
    for spans in by_part.values():
        spans.sort()
        for (_, hi, _), (lo, hi2, _) in zip(spans, spans[1:]):
            assert hi < lo or hi == lo == 7
        assert max(n for *_, n in spans) < 1200 and len(spans) > 4
    write_disjoint(rows.limit(0), str(tmp_path / "none"), ["p"], "day", 10)


# ---------------------------------------------------------------- metadata log


def test_folded_log_reads_the_same(spark, store):
    for i in range(4):
        run = store.create_run("psa", date(2024, 1, 1 + i))
        store.update_run(run, "SUCCESS", records_ingested=i)
        store.mark_processed("psa", [(date(2024, 1 + i, 1), run)])
    tables = ("pipeline_runs", "processed_batches", "stage_metrics")
    before = {t: sorted(map(str, store.table(t).collect())) for t in tables}
    assert [store.fold(t) for t in tables] == [8, 4, 0]
    assert {t: sorted(map(str, store.table(t).collect())) for t in tables} == before
    assert len(store._files("pipeline_runs")) == 0 and store.fold("pipeline_runs") == 0
    store.update_run(run, "FAILED")
    assert store.table("pipeline_runs").filter("status = 'FAILED'").count() == 1
    assert store.table("pipeline_runs").count() == 4 and store.fold("pipeline_runs") == 0


def test_fold_interrupted_before_removal_reads_nothing_twice(spark, store, monkeypatch):
    from stratalake.plans import metadata

    for i in range(3):
        store.write("stage_metrics", [{"run_id": f"r{i}", "stage_name": "s"}])
    with monkeypatch.context() as patch:
        patch.setattr(metadata, "delete_folder", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.fold("stage_metrics")
    assert store.table("stage_metrics").count() == 3 and len(store._files("stage_metrics")) == 3
    store.write("stage_metrics", [{"run_id": "r3", "stage_name": "s"}])
    store.write("stage_metrics", [{"run_id": "r4", "stage_name": "s"}])
    assert store.table("stage_metrics").count() == 5
    store.fold("stage_metrics")
    assert store.table("stage_metrics").count() == 5 and not store._files("stage_metrics")


# ---------------------------------------------------------------- landing


def _fx(spark, n=5):
    return spark.createDataFrame([(f"2024-01-{i + 1:02d}", "USD/PHP", 56.0 + i, "s") for i in range(n)], FX)


def test_landing_evaluates_its_source_once(spark, store):
    random_source = _fx(spark).withColumn("source", F.java_method(F.lit("java.util.UUID"), F.lit("randomUUID")))
    path = land(store.lake, store, "bsp_fx", random_source, date(2024, 1, 1))
    stored = read_bronze(store, "bsp_fx", path)
    manifest = store.table("file_manifest").first()
    columns = ["rate_date", "currency_pair", "rate", "source"]
    assert manifest.sha256_hash == fingerprint(stored, columns).first().sha256_hash
    assert manifest.status == "SUCCESS" and manifest.byte_size > 0
    assert not children(spark, f"{store.lake.bronze('bsp_fx')}/_pending")


def test_interrupted_commit_is_adopted(spark, store, monkeypatch):
    records = _fx(spark)
    with monkeypatch.context() as patch:
        patch.setattr(landing, "folder_size", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            land(store.lake, store, "bsp_fx", records, date(2024, 1, 1), batch_id="one")
    path = land(store.lake, store, "bsp_fx", records, date(2024, 2, 1), batch_id="two")
    assert path.endswith("batch_id=one") and read_bronze(store, "bsp_fx").count() == 5


def test_commit_interrupted_before_the_rename_lands_again(spark, store, monkeypatch):
    records = _fx(spark)
    with monkeypatch.context() as patch:
        patch.setattr(landing, "move_folder", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            land(store.lake, store, "bsp_fx", records, date(2024, 1, 1), batch_id="one")
    assert not folder_exists(spark, f"{store.lake.bronze('bsp_fx')}/year=2024")
    path = land(store.lake, store, "bsp_fx", records, date(2024, 1, 1), batch_id="two")
    assert path.endswith("batch_id=two") and read_bronze(store, "bsp_fx").count() == 5


def test_failed_write_is_recorded(spark, store):
    broken = _fx(spark).withColumn("source", F.raise_error(F.lit("no source")))
    with pytest.raises(Exception, match="no source"):
        land(store.lake, store, "bsp_fx", broken, date(2024, 1, 1))
    assert [r.status for r in store.table("file_manifest").collect()] == ["FAILED"]
    assert staged(_fx(spark), "x").count() == 5 and delete_folder(spark, store.lake.bronze("none")) is None
