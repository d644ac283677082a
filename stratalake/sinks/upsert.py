"""Upserts that rewrite the touched partitions only, and inserts that read the hit buckets only.

Both stage what they are going to publish under the id of the job, so a job that is repeated with its
id finishes the work of the one that was interrupted, whatever point that had reached.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalake.layout import data_files, delete_folder, folder_exists, move_folder
from stratalake.operators.evolution import united
from stratalake.operators.latest import latest_per_key
from stratalake.operators.merge import first_per_key
from stratalake.sinks import arranged, write_partitioned
from stratalake.sources.evolved import read_evolved


def _folders(spark: SparkSession, root: str) -> list[str]:
    """Partition folders with files, relative to ``root``, as the writer named them."""
    if not folder_exists(spark, root):
        return []
    # A file's path may carry another scheme than ``root``: cut at the root's own last part.
    mark = "/" + root.rstrip("/").rsplit("/", 1)[-1] + "/"
    return sorted({f.rsplit(mark, 1)[-1].rsplit("/", 1)[0] for f in data_files(spark, root)})


def upsert_partitions(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    partition_cols: Sequence[str],
    keys: Sequence[str],
    newest_by: Sequence[str],
    sort_cols: Sequence[str] = (),
    job_id: str | None = None,
) -> list[str]:
    """Insert or replace rows by key, and return the partition folders that were rewritten.

    ``updates`` is written once, below the target; its folders are the touched partitions, and only
    those are read and replaced. Files of other partitions are neither read nor renamed. Per key the
    greatest ``newest_by`` wins, an update before a stored row. The partition has to be part of the
    key: a key that could change its partition would have to be looked for in all of them. Columns
    that one side lacks are NULL, types are widened.
    """
    if not set(partition_cols) <= set(keys):
        raise ValueError(f"partition columns {list(partition_cols)} are not part of the key {list(keys)}")
    root = f"{path}/_upserts/{job_id or uuid.uuid4().hex}"
    incoming, merged = f"{root}/incoming", f"{root}/merged"
    if not folder_exists(spark, f"{merged}/_SUCCESS"):
        delete_folder(spark, merged)
        write_partitioned(updates, incoming, partition_cols)
        folders = StructType([updates.schema[c] for c in partition_cols])
        touched = _folders(spark, incoming)
        stored = [f"{path}/{folder}" for folder in touched if folder_exists(spark, f"{path}/{folder}")]
        # Stored files first, so that their column order and spelling stay.
        sides = [
            rows.withColumn("_incoming", F.lit(number))
            for number, rows in enumerate(
                (
                    read_evolved(spark, path, stored, folders) if stored else None,
                    spark.read.schema(updates.schema).parquet(incoming),
                )
            )
            if rows is not None
        ]
        latest = latest_per_key(united(sides), keys, [*newest_by, "_incoming"]).drop("_incoming")
        rows = arranged(latest, partition_cols, sort_cols)
        # Static: the marker that all of it is there is written last.
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(*partition_cols).parquet(merged)
    published = _folders(spark, merged)
    for folder in published:
        move_folder(spark, f"{merged}/{folder}", f"{path}/{folder}")
    delete_folder(spark, root)
    return published


class KeyIndex:
    """Digests of the keys of a dataset, in a fixed number of buckets.

    A dataset that takes inserts for years has far more keys than an insert brings. The index lies in
    folders by bucket of the digest, so an insert reads the buckets its keys fall into, two
    columns wide, and never the dataset. The bucket count is part of the folder's name: an index
    is only ever read with the count that it was built with.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 256) -> None:
        self.spark, self.keys, self.buckets = spark, list(keys), buckets
        self.root, self.folder = path, f"{path}/of{buckets}"

    def _digest(self) -> Column:
        """Differs for keys that differ: values are framed by their lengths, NULL is a mark."""
        framed = [
            F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-"))
            for text in (F.col(k).cast("string") for k in self.keys)
        ]
        return F.unhex(F.sha2(F.concat(*framed), 256))

    def _keyed(self, rows: DataFrame) -> DataFrame:
        keyed = rows.withColumn("_digest", self._digest())
        return keyed.withColumn("_bucket", F.pmod(F.xxhash64("_digest"), F.lit(self.buckets)).cast("int"))

    def _write(self, keyed: DataFrame, job_id: str) -> None:
        """A job's entries have folders of their own, so writing them again replaces them."""
        rows = keyed.select(F.col("_digest").alias("digest"), F.col("_bucket").alias("bucket"))
        write_partitioned(rows.withColumn("job", F.lit(job_id)), self.folder, ["bucket", "job"])

    def build(self, target: DataFrame) -> None:
        """Index a dataset that is there already."""
        self._write(self._keyed(target.select(*self.keys).distinct()), "build")

    def entries(self, buckets: Sequence[int]) -> DataFrame:
        """Index entries of the given buckets."""
        schema = "digest binary, bucket int, job string"
        if not folder_exists(self.spark, self.folder):
            return self.spark.createDataFrame([], schema)
        index = self.spark.read.schema(schema).parquet(self.folder)
        return index.filter(F.col("bucket").isin(list(buckets)))

    def absent(self, rows: DataFrame, oldest_by: Sequence[str]) -> DataFrame:
        """The first row of each key that the index does not hold, with its digest and bucket."""
        firsts = self._keyed(first_per_key(rows, self.keys, oldest_by))
        # At most as many as there are buckets.
        hit = [r["_bucket"] for r in firsts.select("_bucket").distinct().collect()]
        known = self.entries(hit).select(F.col("digest").alias("_digest"))
        return firsts.join(known, "_digest", "left_anti")

    def insert(
        self, rows: DataFrame, target: str, oldest_by: Sequence[str], job_id: str | None = None
    ) -> str:
        """Add the absent rows to the dataset at ``target`` and to the index; the folder written.

        Rows to insert are staged once; dataset and index are written from there, each into a folder
        of the job, so neither holds them twice after a repetition. The staged rows go last: without
        them a job whose folder is there is done.
        """
        job_id = job_id or uuid.uuid4().hex
        pending = f"{self.root}/_jobs/{job_id}"
        folder = f"{target}/insert_id={job_id}"
        if folder_exists(self.spark, f"{folder}/_SUCCESS") and not folder_exists(self.spark, pending):
            return folder
        if not folder_exists(self.spark, f"{pending}/_SUCCESS"):
            self.absent(rows, oldest_by).write.mode("overwrite").parquet(pending)
        staged = self.spark.read.parquet(pending)
        staged.drop("_digest", "_bucket").write.mode("overwrite").parquet(folder)
        self._write(staged, job_id)
        delete_folder(self.spark, pending)
        return folder
