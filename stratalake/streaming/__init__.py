"""Incremental landing: seed files that arrive in a folder, each landed once.

The batch chain's guards (content fingerprint, processed batches) apply unchanged. Structured
Streaming adds the bookkeeping of which files have been seen, and the batch reader reads them; its checkpoint lives in the shared
folder. ``availableNow`` makes it a scheduled batch job rather than a running service.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratalake.plans.bronze import land
from stratalake.plans.metadata import MetadataStore
from stratalake.sources.seed_csv import READERS


def land_arriving_files(
    store: MetadataStore, source: str, folder: str, checkpoint: str, run_date: date
) -> StreamingQuery:
    """Land all CSV files that are new since the last call, then stop.

    The batch id is derived from the micro-batch, so a micro-batch that is repeated after a failure
    replaces its own bronze folder, or is skipped if its manifest entry was already written.
    """
    arriving = store.spark.readStream.text(folder).select(F.col("_metadata.file_path").alias("file"))

    def land_batch(lines: DataFrame, number: int) -> None:
        files = [row.file for row in lines.distinct().collect()]  # names of this batch's files
        records = READERS[source](store.spark, files) if files else None
        if records is not None and not records.isEmpty():
            batch_id = f"stream-{run_date:%Y%m%d}-{number}"
            land(store.lake, store, source, records, run_date, batch_id=batch_id)

    return (
        arriving.writeStream.foreachBatch(land_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
