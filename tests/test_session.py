"""The shared working folder."""

from types import SimpleNamespace

import pytest

from stratalake.session import shared_folder, staged


def _session(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder),
        sparkContext=SimpleNamespace(master=master),
    )


def test_folder_of_the_cluster_is_used():
    session = _session("s3a://shared/work/", "yarn")
    first, second = (shared_folder(session, "x") for _ in range(2))
    assert first.startswith("s3a://shared/work/x-") and first != second


def test_only_local_mode_falls_back_to_a_temporary_folder():
    assert "/x-" in shared_folder(_session(None, "local[4]"), "x")
    with pytest.raises(RuntimeError):
        shared_folder(_session(None, "yarn"), "x")


def test_staged_rows_and_types_are_the_same(spark):
    df = spark.range(5).selectExpr("id", "CAST(id AS STRING) AS s", "make_date(2024, 1, 1) AS d")
    back = staged(df, "staged")
    assert back.dtypes == df.dtypes and sorted(back.collect()) == sorted(df.collect())
