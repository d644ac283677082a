"""A corpus pipeline: every stage works on the rows its predecessor kept.

Stages take (spark, docs, sf_dir), ``docs`` read from Parquet files, and return a DataFrame. Toxic
documents, copies, all but one of each near-duplicate group and contaminated documents go; what is
left is packed into training sequences. All stages but the last return the columns of ``documents``.

Rows are told apart by their place in their file, not by their id, so rows with a NULL id or with
the same id are judged one by one. An empty table goes through all stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import decontamination, exact_dedup, jaccard_join, packing, toxicity
from stratalake.llm.common import on_workers, row_keys, table, without_rows
from stratalake.session import shared_folder

#: Two stages keep one row of a group by its largest or smallest id; see each operator.
ORACLE_SQL = None


@on_workers
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Score with a field trained on ``labels``; rows that it calls toxic go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    keyed, keys = row_keys(docs)
    scored = toxicity.score_documents(keyed, model, keys)
    return without_rows(docs, scored.where("predicted = 1"), "toxic-rows")


@on_workers
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.without_copies(docs)


@on_workers
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their shingles the one with the smallest id stays."""
    keyed, keys = row_keys(docs)
    found = jaccard_join.jaccard_components(keyed, keys=keys)
    order = _smallest_id_first(keys)
    first = found.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("stays"))
    others = found.join(first, "component").where(order != F.col("stays"))
    return without_rows(docs, others, "near-copies")


def _smallest_id_first(keys: tuple[str, ...]) -> Column:
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *keys)


@on_workers
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    keyed, keys = row_keys(docs)
    items = table(spark, sf_dir, "benchmark")
    return without_rows(
        docs, decontamination.contained_items(keyed, items, keys=keys), "contaminated-rows"
    )


@on_workers
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece, with its sequence and place."""
    import public_tokenizers

    return packing.pack_documents(
        docs,
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        added=packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json")),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
