"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from stratalake.llm import (
    bottom_k,
    co_training,
    decontamination,
    divergence,
    exact_dedup,
    interpolated_lm,
    jaccard_join,
    packing,
    sharding,
    site_style,
    term_scan,
    toxicity,
    warc,
)
from stratalake.llm.common import fold_of, on_workers, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontamination.contained_items(docs, items)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = site_style.main_text(table(spark, sf_dir, "pages"), caution=site_style.EAGER)
    return texts.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    scored = toxicity.score_documents(docs, toxicity.fit(docs, labels))
    held_out = fold_of(F.col("doc_id"), toxicity.FOLDS) == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "spans")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return decided.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return co_training.score_quality(docs, labels)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.stratified_shards(table(spark, sf_dir, "documents"), shards=16)
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm.score_corpus(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        added=packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json")),
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return term_scan.ranked_documents(docs, items)


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bottom_k.near_duplicates(table(spark, sf_dir, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


_QUERIES = (
    op1_decontamination,
    op2_html_extraction,
    op3_toxicity,
    op4_exact_dedup,
    op5_jaccard_join,
    op6_warc,
    op7_quality,
    op8_sharding,
    op9_lm_scoring,
    op10_packing,
    op11_ranked_search,
    op12_minhash_dedup,
    op13_source_divergence,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {run.__name__: on_workers(run) for run in _QUERIES}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_dedup": exact_dedup.SQL,
        "op6_warc": warc.SQL,
        "op11_ranked_search": term_scan.SQL,
        "op13_source_divergence": divergence.SQL,
    }
