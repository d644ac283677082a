"""Every registered query against its SQL."""

import pytest

import __spark_entry__
from oracle import connect, differences
from workload import load_all

SF = "/root/testdata/sf0.001"
QUERIES, SQL = __spark_entry__.queries(), __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(load_all()))
def test_same_rows_as_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert differences(df, db, SQL[name]) == []
    else:
        assert df.count() > 0


def test_schema_drift_is_seen(spark):
    rows = QUERIES["schema_drift"](spark, SF).collect()
    assert len({r.schema_hash for r in rows}) == 2 and len({r.row_count for r in rows}) == 1
