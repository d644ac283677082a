"""Incremental landing."""

from datetime import date

from stratalake.plans.bronze import read_bronze
from stratalake.streaming import land_arriving_files

HEADER = "rate_date,currency_pair,rate,source\n"


def _run(store, folder, checkpoint):
    query = land_arriving_files(store, "bsp_fx", str(folder), str(checkpoint), date(2024, 1, 15))
    query.awaitTermination(120)
    assert query.exception() is None


def test_each_file_and_each_content_lands_once(store, tmp_path):
    folder, checkpoint = tmp_path / "in", tmp_path / "checkpoint"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + "2023-01-01,USD/PHP,56.18,s\n2023-02-01,USD/PHP,,s\n")
    _run(store, folder, checkpoint)
    _run(store, folder, checkpoint)  # nothing new
    (folder / "b.csv").write_text(HEADER + "2023-02-01,USD/PHP,,s\n2023-01-01,USD/PHP,56.18,s\n")
    _run(store, folder, checkpoint)  # a new file with known content
    (folder / "c.csv").write_text(HEADER + "2023-03-01,USD/PHP,54.9,s\n")
    _run(store, folder, checkpoint)
    rows = read_bronze(store, "bsp_fx").collect()
    assert sorted(r.rate_date for r in rows) == ["2023-01-01", "2023-02-01", "2023-03-01"]
    assert store.table("file_manifest").filter("status = 'SUCCESS'").count() == 2


def test_columns_of_arriving_files_are_bound_by_name(store, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("rate,currency_pair,rate_date\n56.18,USD/PHP,2023-01-01\nbad,USD/PHP,2023-02-01\n")
    _run(store, folder, tmp_path / "checkpoint")
    rows = read_bronze(store, "bsp_fx").collect()
    assert [(r.rate_date, r.currency_pair, r.rate, r.source) for r in rows] == [
        ("2023-01-01", "USD/PHP", 56.18, "bsp_fixture")
    ]
