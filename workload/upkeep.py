"""Stored tables kept up to date: each query writes, changes and reads back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.constants import GOLD_DATASETS
from stratalake.functions.digest import fingerprint
from stratalake.layout import children, data_files, delete_folder
from stratalake.plans.bronze import land, read_bronze
from stratalake.plans.serving import latest_meta
from stratalake.plans.upkeep import LabelledSeries, StoredFingerprints, StoredTrend
from stratalake.schemas import metadata_schema, record_schema
from stratalake.session import shared_folder, staged
from stratalake.sinks import append, write_disjoint, write_partitioned
from stratalake.sinks.upsert import KeyIndex, upsert_partitions
from stratalake.streaming import land_arriving_files
from workload import query
from workload.tables import fx_bronze, table
from workload.writes import metadata_store


def _file_names(spark: SparkSession, folder: str) -> DataFrame:
    """Partition folder and name of each file."""
    names = [("/".join(f.rsplit("/", 3)[1:]),) for f in data_files(spark, folder)]
    return spark.createDataFrame(names, "file string")


# ---------------------------------------------------------------- upserts


@query(
    "upsert_partitions",
    """
    WITH stored AS (
      SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month,
             o_totalprice AS price, o_orderkey % 7 AS version
      FROM orders WHERE o_orderkey % 5 <> 0),
    updates AS (
      SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month,
             o_totalprice + 1000 AS price, 3 AS version, o_orderpriority AS priority
      FROM orders WHERE year(o_orderdate) = 1995 AND month(o_orderdate) % 3 = 0 AND o_orderkey % 2 = 0
      UNION ALL
      SELECT o_orderkey, 2030, 1, o_totalprice, 0, NULL FROM orders WHERE o_orderkey % 5 = 0),
    latest AS (
      SELECT * FROM (SELECT *, NULL AS priority, 0 AS incoming FROM stored
                     UNION ALL SELECT *, 1 FROM updates)
      QUALIFY row_number() OVER (PARTITION BY o_orderkey, year, month
                                 ORDER BY version DESC, incoming DESC) = 1)
    SELECT CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, o_orderkey, price, priority,
           (year, month) NOT IN (SELECT (year, month) FROM updates) AS file_kept
    FROM latest""",
)
def _upsert_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Stored orders by month; updates with one more column for some months of 1995 and a new one."""
    folder = shared_folder(spark, "upsert-partitions")
    months = {"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}
    orders = table(spark, sf, "orders").withColumns(months)
    key = ["o_orderkey", "year", "month"]
    stored = orders.filter("o_orderkey % 5 <> 0").select(
        *key, F.col("o_totalprice").alias("price"), (F.col("o_orderkey") % 7).alias("version")
    )
    write_partitioned(stored, folder, ["year", "month"])
    before = _file_names(spark, folder)
    changed = orders.filter("year = 1995 AND month % 3 = 0 AND o_orderkey % 2 = 0").selectExpr(
        *key, "o_totalprice + 1000 AS price", "3L AS version", "o_orderpriority AS priority"
    )
    added = orders.filter("o_orderkey % 5 = 0").selectExpr(
        "o_orderkey", "2030 AS year", "1 AS month", "o_totalprice AS price", "0L AS version",
        "CAST(NULL AS STRING) AS priority",
    )
    updates = changed.unionByName(added)
    upsert_partitions(spark, folder, updates, ["year", "month"], key, ["version"])
    rows = spark.read.schema(f"{_ddl(updates)}").parquet(folder)
    named = rows.withColumn("file", F.substring_index("_metadata.file_path", "/", -3))
    kept = before.withColumn("file_kept", F.lit(True))
    joined = named.join(kept, "file", "left")
    return joined.select(
        "year", "month", "o_orderkey", "price", "priority", F.coalesce("file_kept", F.lit(False)).alias("file_kept")
    )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)


@query(
    "insert_absent_indexed",
    """
    WITH arriving AS (
      SELECT c_custkey, c_name || '/' || copy AS name, copy AS age
      FROM customer, (SELECT unnest([1, 2]) AS copy)
      WHERE c_custkey % 4 = 0 OR c_custkey % 3 = 0)
    SELECT c_custkey, c_name AS name, 'stored' AS origin FROM customer WHERE c_custkey % 3 <> 0
    UNION ALL
    SELECT c_custkey, arg_min(name, age), 'inserted' FROM arriving
    WHERE c_custkey % 3 = 0 GROUP BY c_custkey""",
)
def _insert_absent_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """Customers, of whom two thirds are stored, arrive twice each, and the whole once more."""
    target, index = (shared_folder(spark, f"insert-{name}") for name in ("target", "index"))
    customers = table(spark, sf, "customer")
    stored = customers.filter("c_custkey % 3 <> 0").select("c_custkey", F.col("c_name").alias("name"))
    stored = stored.withColumn("origin", F.lit("stored"))
    stored.write.parquet(f"{target}/insert_id=first")
    keys = KeyIndex(spark, index, ["c_custkey"], buckets=64)
    keys.build(stored)
    arriving = (
        customers.filter("c_custkey % 4 = 0 OR c_custkey % 3 = 0")
        .withColumn("age", F.explode(F.array(F.lit(2), F.lit(1))))
        .select("c_custkey", F.concat_ws("/", "c_name", "age").alias("name"), F.lit("inserted").alias("origin"), "age")
    )
    for job in ("a", "b"):  # the second time there is nothing left to insert
        keys.insert(arriving, target, ["age"], job)
    keys.insert(arriving, target, ["age"], "a")  # the same job again
    return spark.read.schema("c_custkey bigint, name string, origin string").parquet(target).select(
        "c_custkey", "name", "origin"
    )


# ---------------------------------------------------------------- labels, trend, fingerprints


@query(
    "direction_late",
    """
    WITH stored AS (
      SELECT o_orderpriority AS series, o_orderdate::DATE AS day, max(o_totalprice) AS rate
      FROM orders WHERE o_orderkey % 10 <> 0 GROUP BY ALL),
    late AS (
      SELECT o_orderpriority AS series, o_orderdate::DATE AS day, max(o_totalprice) AS rate
      FROM orders WHERE o_orderkey % 10 = 0 AND year(o_orderdate) IN (1996, 1999, 2001) GROUP BY ALL
      UNION ALL SELECT DISTINCT o_orderpriority, DATE '2004-02-29', 1.5 FROM orders),
    merged AS (
      SELECT series, day, coalesce(l.rate, s.rate) AS rate
      FROM stored s FULL JOIN late l USING (series, day))
    SELECT series, strftime(day, '%Y-%m-%d') AS day, rate,
           CASE WHEN rate > previous THEN 'hike' WHEN rate < previous THEN 'cut' ELSE 'hold' END
             AS direction
    FROM (SELECT *, lag(rate) OVER (PARTITION BY series ORDER BY day) AS previous FROM merged)""",
)
def _direction_late(spark: SparkSession, sf: str) -> DataFrame:
    """Late and corrected values of three years, and a first one long after, into labelled series."""
    days = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("series"),
        F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").alias("rate"),
        (F.col("o_orderkey") % 10 == 0).alias("late"),
    )
    by_day = days.groupBy("series", "day", "late").agg(F.max("rate").alias("rate"))
    stored = LabelledSeries(spark, shared_folder(spark, "direction-late"), ["series"], "day", "rate")
    stored.build(by_day.filter("NOT late").select("series", "day", "rate"))
    late = by_day.filter("late AND year(day) IN (1996, 1999, 2001)").select("series", "day", "rate")
    after = days.select("series").distinct().selectExpr("series", "DATE '2004-02-29' AS day", "1.5D AS rate")
    stored.apply(late.unionByName(after))
    return stored.rows().select("series", "day", "rate", "direction")


_CHANGED = "month(day) = 5 AND year(day) IN (1996, 1998)"


@query(
    "trend_incremental",
    f"""
    WITH prices AS (
      SELECT o_orderkey, o_orderdate::DATE AS day, o_totalprice AS value,
             CASE o_orderpriority WHEN '1-URGENT' THEN 'CPI_ALL' ELSE 'CPI_YOY' END AS code
      FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
    macro AS (
      SELECT code, day, value + CASE WHEN {_CHANGED} THEN 7 ELSE 0 END AS value
      FROM (SELECT code, day, max(value) AS value FROM prices GROUP BY ALL)
      WHERE NOT (year(day) = 1997 AND month(day) = 2)),
    fx AS (
      SELECT l_shipdate::DATE AS day, max(l_extendedprice) AS rate FROM lineitem
      WHERE NOT (year(l_shipdate) = 1997 AND month(l_shipdate) = 2) GROUP BY 1),
    points AS (
      SELECT strftime(day, '%Y-%m') AS period, code, arg_max(value, day) AS value FROM macro GROUP BY ALL
      UNION ALL SELECT strftime(day, '%Y-%m'), 'USD/PHP', arg_max(rate, day) FROM fx GROUP BY 1)
    SELECT period, max(value) FILTER (WHERE code = 'CPI_ALL') AS "CPI_ALL",
           max(value) FILTER (WHERE code = 'CPI_YOY') AS "CPI_YOY",
           max(value) FILTER (WHERE code = 'USD/PHP') AS "USD/PHP"
    FROM points GROUP BY period""",
)
def _trend_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """A stored trend after late rows, corrections and a removed month."""
    folder = shared_folder(spark, "trend-incremental")
    code = F.when(F.col("o_orderpriority") == "1-URGENT", "CPI_ALL").otherwise("CPI_YOY")
    macro = (
        table(spark, sf, "orders")
        .filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
        .groupBy(code.alias("indicator_code"), F.to_date("o_orderdate").alias("period"))
        .agg(F.max("o_totalprice").alias("value"))
    )
    fx = table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("period"))
    fx = fx.agg(F.max("l_extendedprice").alias("rate"))
    month = F.date_format("period", "yyyy-MM")
    sides = {"macro": macro.withColumn("month", month), "fx": fx.withColumn("month", month)}
    sides = {name: staged(rows, f"trend-{name}") for name, rows in sides.items()}
    # At first the months to change lack their last days, and hold other values.
    changed, removed = ["1996-05", "1998-05"], "1997-02"
    for name, rows in sides.items():
        early = rows.filter(~F.col("month").isin(changed) | (F.dayofmonth("period") < 20))
        write_partitioned(early, f"{folder}/{name}", ["month"])

    def stored(name: str) -> DataFrame:
        return spark.read.schema(_ddl(sides[name])).parquet(f"{folder}/{name}")

    trend = StoredTrend(spark, f"{folder}/trend")
    trend.build(stored("macro"), stored("fx"))
    whole = {name: rows.filter(F.col("month").isin(changed)) for name, rows in sides.items()}
    whole["macro"] = whole["macro"].withColumn("value", F.col("value") + 7)
    for name, rows in whole.items():
        write_partitioned(rows, f"{folder}/{name}", ["month"])
        delete_folder(spark, f"{folder}/{name}/month={removed}")
    trend.refresh(stored("macro"), stored("fx"), [*changed, removed])
    return trend.current()


@query(
    "fingerprint_merge",
    """
    WITH changed AS (
      SELECT source, lang, CASE lang WHEN 'de' THEN text || '!' ELSE text END AS text FROM documents),
    hashed AS (
      SELECT source, sha256(length(lang) || ':' || lang || length(text) || ':' || text) AS h FROM changed),
    lanes AS (
      SELECT source, count(*) AS row_count,
             sum(CAST('0x' || h[1:15] AS BIGINT)) AS l0, sum(CAST('0x' || h[16:30] AS BIGINT)) AS l1,
             sum(CAST('0x' || h[31:45] AS BIGINT)) AS l2, sum(CAST('0x' || h[46:60] AS BIGINT)) AS l3
      FROM hashed GROUP BY GROUPING SETS ((source), ()))
    SELECT coalesce(source, 'all') AS source, row_count,
           sha256(row_count || ':' || CAST(l0 AS VARCHAR) || ':' || CAST(l1 AS VARCHAR) || ':'
                  || CAST(l2 AS VARCHAR) || ':' || CAST(l3 AS VARCHAR)) AS sha256_hash
    FROM lanes""",
)
def _fingerprint_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Sums per source and language; one language changes; fingerprints per source and of all."""
    docs = table(spark, sf, "documents")
    prints = StoredFingerprints(
        spark, shared_folder(spark, "fingerprints"), ["source", "lang_part"], ["lang", "text"]
    )
    parts = docs.withColumn("lang_part", F.col("lang"))
    prints.update(parts)
    prints.update(parts.filter("lang = 'de'").withColumn("text", F.concat("text", F.lit("!"))))
    whole = prints.fingerprint().withColumn("source", F.lit("all"))
    return prints.fingerprint(["source"]).unionByName(whole)


# ---------------------------------------------------------------- landing


@query(
    "landing_commit",
    """
    WITH records AS (
      SELECT strftime(ts, '%Y-%m-%d') AS rate_date, event_type AS currency_pair,
             CASE WHEN value <= 200 THEN value END AS rate FROM events)
    SELECT 'changing' AS batch_id, rate_date, currency_pair, rate, 'true' AS described FROM records
    UNION ALL SELECT 'fixed', rate_date, currency_pair, rate, 'true' FROM records""",
)
def _landing_commit(spark: SparkSession, sf: str) -> DataFrame:
    """A source that gives other rows on every evaluation, and one that comes twice, the second time
    dealt out otherwise.

    ``described``: the manifest's fingerprint is that of the rows that are stored.
    """
    store = metadata_store(spark, "landing-commit")
    records = fx_bronze(spark, sf).drop("fetched_at", "batch_id")
    random = F.java_method(F.lit("java.util.UUID"), F.lit("randomUUID"))
    changing = records.withColumn("source", random)
    land(store.lake, store, "bsp_fx", changing, date(2024, 1, 15), batch_id="changing")
    land(store.lake, store, "bsp_fx", records, date(2024, 2, 15), batch_id="fixed")
    land(store.lake, store, "bsp_fx", records.repartition("rate_date", "rate"), date(2024, 3, 15), batch_id="again")
    stored = read_bronze(store, "bsp_fx")
    fields = record_schema("bsp_fx").fieldNames()
    prints = fingerprint(stored, fields, ["batch_id"], "stored_hash").select("batch_id", "stored_hash")
    manifest = store.table("file_manifest").filter("status = 'SUCCESS'").select("batch_id", "sha256_hash")
    described = prints.join(manifest, "batch_id").select(
        "batch_id", (F.col("stored_hash") == F.col("sha256_hash")).cast("string").alias("described")
    )
    return stored.join(described, "batch_id").select(
        "batch_id", "rate_date", "currency_pair", "rate", "described"
    )


# ---------------------------------------------------------------- files


@query(
    "silver_disjoint_files",
    """
    WITH rows AS (
      SELECT l_linestatus AS status, l_shipdate::DATE AS day, l_orderkey, l_linenumber FROM lineitem
      UNION ALL SELECT 'P', DATE '1999-12-31', l_orderkey, l_linenumber FROM lineitem)
    SELECT status, strftime(day, '%Y-%m-%d') AS day, l_orderkey, l_linenumber, 0 AS overlaps FROM rows""",
)
def _silver_disjoint_files(spark: SparkSession, sf: str) -> DataFrame:
    """Two large partitions by date, and one that is a single day.

    ``overlaps``: files of the partition, other than a single day's, whose dates reach into this one.
    """
    folder = shared_folder(spark, "silver-disjoint")
    lines = table(spark, sf, "lineitem").select("l_linestatus", "l_shipdate", "l_orderkey", "l_linenumber")
    rows = lines.select(
        F.col("l_linestatus").alias("status"), F.to_date("l_shipdate").alias("day"), "l_orderkey", "l_linenumber"
    )
    one_day = rows.withColumns({"status": F.lit("P"), "day": F.lit(date(1999, 12, 31))})
    both = rows.unionByName(one_day)
    write_disjoint(both, folder, ["status"], "day", rows_per_file=2000)
    stored = spark.read.schema("day date, l_orderkey bigint, l_linenumber int, status string").parquet(folder)
    named = stored.withColumn("file", F.col("_metadata.file_name"))
    files = named.groupBy("status", "file").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    # In the order of their first days a file overlaps an earlier one only if it overlaps the last.
    before = Window.partitionBy("status").orderBy("first", "last")
    reach = F.lag("last").over(before)
    overlap = F.when(F.col("first") == F.col("last"), 0).otherwise((reach >= F.col("first")).cast("int"))
    judged = files.withColumn("overlaps", F.coalesce(overlap, F.lit(0))).select("status", "file", "overlaps")
    return named.join(judged, ["status", "file"]).drop("file")


# ---------------------------------------------------------------- arriving files


@query(
    "stream_landing",
    """
    SELECT o_orderkey % 3 AS arrival, strftime(o_orderdate, '%Y-%m-%d') AS rate_date, o_totalprice AS rate,
           3 AS landings
    FROM orders""",
)
def _stream_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Three arrivals of files, each landed by a run of its own; the second run's batch is replayed."""
    folder = shared_folder(spark, "stream-landing")
    store = metadata_store(spark, "stream-lake")
    orders = table(spark, sf, "orders")

    def run() -> None:
        landing = land_arriving_files(store, "bsp_fx", f"{folder}/in", f"{folder}/checkpoint", date(2024, 1, 15))
        landing.awaitTermination()

    for arrival in range(3):
        rows = orders.filter(F.col("o_orderkey") % 3 == arrival).select(
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("rate_date"),
            F.lit(f"pair {arrival}").alias("currency_pair"),
            F.col("o_totalprice").alias("rate"),
            F.lit("orders").alias("source"),
        )
        rows.write.mode("append").option("header", True).csv(f"{folder}/in")
        run()
        if arrival == 1:
            # As after a failure before the batch was committed: it is run again with its files.
            delete_folder(spark, f"{folder}/checkpoint/commits/{arrival}")
            run()
    landings = store.table("file_manifest").filter("status = 'SUCCESS'").count()
    return read_bronze(store, "bsp_fx").select(
        F.substring("currency_pair", 6, 1).cast("bigint").alias("arrival"),
        "rate_date",
        "rate",
        F.lit(landings).alias("landings"),
    )


# ---------------------------------------------------------------- metadata


@query(
    "metadata_folded",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS source,
           CASE WHEN o_orderkey % 3 = 0 THEN 'SUCCESS' WHEN o_orderkey % 3 = 1 THEN 'PARTIAL'
                ELSE 'RUNNING' END AS status,
           CASE WHEN o_orderkey % 3 < 2 THEN o_custkey END AS records_ingested,
           2 AS generations, 1 AS files
    FROM orders""",
)
def _metadata_folded(spark: SparkSession, sf: str) -> DataFrame:
    """Runs opened and finished in several appends, folded twice, one append after that."""
    store = metadata_store(spark, "metadata-folded")
    orders = table(spark, sf, "orders").withColumn("run_id", F.col("o_orderkey").cast("string"))
    kinds = F.col("o_orderkey") % 3

    def log(number: int, rows: DataFrame, **values) -> None:
        given = {"run_id": F.col("run_id"), **values, "_seq": F.col("o_orderkey") + (number << 40)}
        schema = metadata_schema("pipeline_runs").add("_seq", "long")
        columns = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
        append(rows.select(*columns).coalesce(1), store.lake.metadata("pipeline_runs"))

    opened = {"source": F.col("o_orderpriority"), "status": F.lit("RUNNING")}
    log(0, orders.filter(kinds == 0), **opened)
    log(1, orders.filter(kinds > 0), **opened)
    log(2, orders.filter(kinds == 0), status=F.lit("FAILED"), records_ingested=F.lit(0))
    store.fold("pipeline_runs")
    log(3, orders.filter(kinds == 0), status=F.lit("SUCCESS"))
    log(4, orders.filter(kinds == 0), records_ingested=F.col("o_custkey"))
    store.fold("pipeline_runs")
    log(5, orders.filter(kinds == 1), status=F.lit("PARTIAL"), records_ingested=F.col("o_custkey"))
    listed = children(spark, store.lake.metadata("pipeline_runs"))
    counts = {
        "generations": len(children(spark, f"{store.lake.metadata('pipeline_runs')}/_folded")),
        "files": len([f for f in listed if f.endswith(".parquet")]),
    }
    runs = store.table("pipeline_runs").select("run_id", "source", "status", "records_ingested")
    return runs.withColumns({name: F.lit(n) for name, n in counts.items()})


@query(
    "latest_meta",
    """
    WITH versions AS (
      SELECT event_id AS id, CAST(user_id AS VARCHAR) AS run_id,
             CASE WHEN event_id % 2 = 0 THEN 'gold_macro_indicators' ELSE 'gold_exchange_rates' END
               AS dataset_name,
             event_id AS row_count, ts AS created_at FROM events)
    SELECT id, run_id, dataset_name, row_count,
           CASE WHEN created_at = date_trunc('second', created_at)
                THEN strftime(created_at, '%Y-%m-%dT%H:%M:%S')
                ELSE strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') END AS created_at
    FROM versions QUALIFY row_number() OVER (PARTITION BY dataset_name ORDER BY created_at DESC, id DESC) = 1""",
)
def _latest_meta(spark: SparkSession, sf: str) -> DataFrame:
    """The newest version of both datasets, times with their fraction of a second."""
    dataset = F.when(F.col("event_id") % 2 == 0, GOLD_DATASETS[0]).otherwise(GOLD_DATASETS[1])
    versions = table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("run_id"),
        dataset.alias("dataset_name"),
        F.col("event_id").alias("row_count"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )
    first, second = (latest_meta(versions, name) for name in GOLD_DATASETS)
    return first.unionByName(second)
