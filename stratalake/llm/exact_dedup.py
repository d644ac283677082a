"""Exact deduplication by a stateful stream.

The stream's state is keyed by the digest of the normalised text and lives on disk (RocksDB, no
watermark, so nothing expires). Per digest it retains the stable identifier of the row that stays,
the locator of that row's content (file and row position) and the number of rows. New files
continue from the stored state. A digest hit is only a candidate: the full bytes of every row that
hit are compared with the content behind the locator, and rows that differ form groups of their
own by their text.

Defined cases: a NULL text counts as empty, and empty texts are equal. A NULL id is smaller than
any other. Rows with the same id and text are copies like any others; exactly one row of a group
stays. An empty table gives an empty result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import FILE, ROW, ascii_lower, settings, without_rows
from stratalake.session import shared_folder, staged

_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Each partition's store would reserve 4 MB of disk for its logs, however small it is.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def with_locator(docs: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` of ``docs`` (rows of Parquet files) with each row's file and position in it."""
    meta = docs.metadataColumn("_metadata")
    return docs.select(
        *columns,
        meta.getField("file_path").alias("file"),
        meta.getField("row_index").alias("row"),
    )


class DedupState:
    """Keyed state of a deduplication stream, in a folder all executors share."""

    def __init__(self, folder: str):
        self.folder = folder

    def ingest(self, digests: DataFrame) -> None:
        """Run the stream over what is new in ``digests`` (digest, doc_id, file, row)."""
        spark = digests.sparkSession
        latest = digests.groupBy("digest").agg(
            F.max(F.struct("doc_id", "file", "row")).alias("keep"),
            F.count(F.lit(1)).alias("group_size"),
        )
        changes = f"{self.folder}/changes"

        def record(batch: DataFrame, epoch: int) -> None:
            batch.write.mode("overwrite").parquet(f"{changes}/epoch={epoch}")

        with settings(spark, _STATE):
            query = (
                latest.writeStream.outputMode("update")
                .option("checkpointLocation", f"{self.folder}/checkpoint")
                .trigger(availableNow=True)
                .foreachBatch(record)
                .start()
            )
            query.awaitTermination()

    def current(self, spark) -> DataFrame:
        """The state as a table: of the changes of a digest, the last batch's is in force."""
        schema = (
            "digest string, keep struct<doc_id: bigint, file: string, row: bigint>, "
            "group_size bigint, epoch bigint"
        )
        changes = spark.read.schema(schema).parquet(f"{self.folder}/changes/epoch=*")
        newest = changes.groupBy("digest").agg(
            F.max_by(F.struct("keep", "group_size"), F.struct("group_size", "keep")).alias("now")
        )
        return newest.select("digest", "now.keep", "now.group_size")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest=lambda text: F.sha2(text, 256),
) -> DataFrame:
    """One row per row of ``docs`` (read from Parquet files): file, row, doc_id, keep_id,
    group_size, kept, text_sha256. Of equal texts the row with the largest id stays.

    ``digest`` may be any function of the normalised text: wrong hits are found and put right.
    """
    spark = docs.sparkSession
    text = normalised(docs[text_col])
    found = staged(
        with_locator(
            docs,
            docs[id_col].cast("bigint").alias("doc_id"),
            digest(text).alias("digest"),
            F.sha2(text, 256).alias("text_sha256"),
        ),
        "dedup-digests",
    )
    state = DedupState(shared_folder(spark, "dedup-state"))
    files = found.select("digest", "doc_id", "file", "row")
    if found.isEmpty():
        return _decided(found, F.col("doc_id"), F.lit(1).cast("bigint"), F.lit(True))
    state.ingest(spark.readStream.schema(found.schema).parquet(found.inputFiles()[0].rpartition("/")[0]).select(*files.columns))
    marked = staged(
        found.join(state.current(spark), "digest").withColumn("hit", F.col("group_size") > 1),
        "dedup-marked",
    )
    # Full bytes of the rows that hit, against the content behind the state's locator.
    hits = staged(
        with_locator(docs, normalised(docs[text_col]).alias("content")).join(
            marked.where("hit").select("file", "row", "digest", "keep"), ["file", "row"]
        ),
        "dedup-hits",
    )
    originals = hits.where(
        (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
    ).select("digest", F.col("content").alias("original"))
    wrong = staged(
        hits.join(originals, "digest")
        .where("content != original")
        .select("file", "row", "digest", "content"),
        "dedup-wrong-hits",
    )
    return _with_wrong_hits(marked, wrong)


def _with_wrong_hits(marked: DataFrame, wrong: DataFrame) -> DataFrame:
    """Take rows whose bytes differ out of their group and group them by their own text."""
    keep_row = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
    lost = wrong.groupBy("digest").agg(F.count(F.lit(1)).alias("lost"))
    right = (
        marked.join(wrong.select("file", "row"), ["file", "row"], "left_anti")
        .join(lost, "digest", "left")
        .withColumn("group_size", F.col("group_size") - F.coalesce("lost", F.lit(0)))
    )
    apart = wrong.join(marked.select("file", "row", "doc_id", "text_sha256"), ["file", "row"])
    groups = apart.groupBy("content").agg(
        F.max(F.struct("doc_id", "file", "row")).alias("keep"),
        F.count(F.lit(1)).alias("group_size"),
    )
    again = apart.join(groups, "content")
    return _decided(right, F.col("keep.doc_id"), F.col("group_size"), keep_row).unionByName(
        _decided(again, F.col("keep.doc_id"), F.col("group_size"), keep_row)
    )


def _decided(rows: DataFrame, keep_id: Column, group_size: Column, kept: Column) -> DataFrame:
    return rows.select(
        "file",
        "row",
        "doc_id",
        keep_id.alias("keep_id"),
        group_size.alias("group_size"),
        kept.alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    dropped = exact_dedup(docs, id_col, text_col).where(~F.col("kept"))
    return without_rows(
        docs, dropped.select(F.col("file").alias(FILE), F.col("row").alias(ROW)), "copies"
    )


SQL = """
WITH t AS (
  SELECT doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM t
"""
