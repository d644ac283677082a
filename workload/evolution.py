"""Datasets whose schema changes over time."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.plans.serving import read_snapshot
from stratalake.layout import Lake
from stratalake.session import shared_folder
from stratalake.sinks import read_snapshots, write_snapshots
from workload import query
from workload.tables import table

_MONTHS = [date(year, month, 1) for year in range(1995, 2002) for month in range(1, 13)]


def _dated(orders: DataFrame) -> DataFrame:
    return orders.withColumns(
        {"year": F.date_format("o_orderdate", "yyyy"), "month": F.date_format("o_orderdate", "MM")}
    )


@query(
    "snapshot_evolved",
    """
    SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, o_orderkey,
           CASE WHEN year(o_orderdate) < 1999 THEN CAST(o_custkey AS VARCHAR)
                ELSE 'C' || o_custkey END AS customer,
           o_totalprice AS price,
           CASE WHEN year(o_orderdate) < 1997 THEN o_orderpriority END AS priority,
           CASE WHEN year(o_orderdate) >= 1997 THEN o_orderstatus END AS status
    FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 2001""",
)
def _snapshot_evolved(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly snapshots under three schemas, read as one table.

    From 1997 on keys and prices are wider, ``status`` is new and ``priority`` gone; from 1999 on
    the customer is a text.
    """
    folder = shared_folder(spark, "snapshot-evolved")
    orders = _dated(table(spark, sf, "orders"))
    snapshot = ["year", "month"]
    number = F.col("o_custkey").cast("int").alias("customer")
    price = F.col("o_totalprice").alias("price")
    early = [
        F.col("o_orderkey").cast("int").alias("o_orderkey"),
        number,
        price.cast("decimal(12,2)").alias("price"),
        F.col("o_orderpriority").alias("priority"),
    ]
    status = F.col("o_orderstatus").alias("status")
    middle = ["o_orderkey", number, price, status]
    late = [status, price, F.concat(F.lit("C"), "o_custkey").alias("customer"), "o_orderkey"]
    for first, after, columns in ((1995, 1997, early), (1997, 1999, middle), (1999, 2002, late)):
        years = orders.filter((F.col("year") >= f"{first}") & (F.col("year") < f"{after}"))
        write_snapshots(years.select(*snapshot, *columns), folder, [], [])
    rows = read_snapshots(spark, folder, _MONTHS)
    return rows.select(
        F.col("year").cast("string").alias("year"),
        F.lpad(F.col("month").cast("string"), 2, "0").alias("month"),
        "o_orderkey",
        "customer",
        "price",
        "priority",
        "status",
    )


@query(
    "snapshot_evolved_nested",
    """
    SELECT event_id, event_type AS kind, value AS amount,
           CASE WHEN event_id % 3 = 0 THEN user_id END AS user_number,
           CASE WHEN event_id % 3 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k
    FROM events""",
)
def _snapshot_evolved_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Part files of one snapshot, each with its own fields inside a struct, served as one."""
    lake = Lake(shared_folder(spark, "snapshot-nested"))
    events = table(spark, sf, "events").withColumn("k", F.from_json("props", "k bigint")["k"])
    third = F.col("event_id") % 3
    kind = F.col("event_type").alias("kind")
    users = F.struct(kind, F.col("user_id").alias("user_number"), F.col("value").alias("amount"))
    small = F.struct(kind, F.col("k").cast("int").alias("k"), F.col("value").alias("amount"))
    wide = F.struct(F.col("value").alias("amount"), F.col("k").alias("k"), kind)
    folder = lake.gold("events")
    for number, detail in enumerate((users, small, wide)):
        part = events.filter(third == number).select("event_id", detail.alias("detail"))
        part.write.mode("append").parquet(folder)
    return read_snapshot(spark, lake, folder).select("event_id", "detail.*")
