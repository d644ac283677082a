"""Sharding by proportional stratified interleaving.

Rows of a source are put in a seeded random order and numbered; the number over the source's size
is the row's fractional rank. Sorted by fractional rank all sources interleave in proportion, so
contiguous cuts of that order give shards with equal row counts (at most one apart) and the
mixture of the whole table: rounding moves a cut by at most half a row per source, so in a shard a
source is off its share by at most one row plus (number of sources x its share of the rows).

Both rankings are done without ever gathering a source or the table in one task: rows are ranked
inside narrow buckets of the sort key, and bucket offsets come from the buckets' counts. The number
of buckets is fixed, so the windows over offsets are bounded.

Defined cases: a NULL source is a source of its own; a NULL text has no bytes; a NULL id is
shuffled like the empty text; rows that are equal in every column may swap places. Rows of an id that
more than ``_MANY`` rows have, or rows without an id if they are that many, are shuffled one by one, by
the place at which they were read. An empty table gives an empty result. Other columns, whatever their
names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.session import staged

#: Buckets of the seeded order in a source: the first hexadecimal digits of the shuffle key.
_KEY_DIGITS = 3
#: Rows of one id (or without one) beyond which each is shuffled by itself.
_MANY = 10_000
#: Buckets of the fractional rank over all sources.
_RANK_BUCKETS = 1 << 16


def _ranked(
    rows: DataFrame, strata: list[str], bucket: str, order: list[Column | str], out: str
) -> DataFrame:
    """Number rows from 0 by (bucket, order) within ``strata``; ``<out>_total``: rows in all."""
    counts = rows.groupBy(*strata, bucket).agg(F.count(F.lit(1)).alias("_in_bucket"))
    # One row per bucket here: a fixed number of rows in each of these windows.
    before = Window.partitionBy(*strata).orderBy(bucket)
    offsets = counts.select(
        *strata,
        bucket,
        F.coalesce(
            F.sum("_in_bucket").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
        F.sum("_in_bucket").over(Window.partitionBy(*strata)).alias(f"{out}_total"),
    )
    inside = Window.partitionBy(*strata, bucket).orderBy(*order)
    return (
        rows.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(offsets, [*strata, bucket])
        .withColumn(out, F.col("_before") + F.col("_inside"))
        .drop("_before", "_inside")
    )


def _spread(rows: DataFrame) -> DataFrame:
    """Give rows of an id that very many rows have keys of their own, by the place at which they
    were read; the others keep the key of their id."""
    many = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > _MANY).select("key", "n")
    own = F.md5(F.concat_ws(":", "key", "place_read").cast("binary"))
    keyed = rows.join(many, "key", "left").withColumn("key", F.when(F.col("n").isNotNull(), own).otherwise(F.col("key")))
    return keyed.drop("n", "place_read")


def stratified_shards(
    docs: DataFrame,
    shards: int = 16,
    seed: int = 2718,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, text_crc32, shard, slot."""
    text = F.coalesce(docs[text_col], F.lit(""))
    doc_id, source = docs[id_col], docs[source_col].cast("string")
    key = F.md5(
        F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")
    )
    rows = staged(
        docs.select(
            doc_id.alias("doc_id"),
            source.alias("source"),
            F.when(source.isNull(), "-").otherwise(F.concat(F.lit("="), source)).alias("stratum"),
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            key.alias("key"),
            F.monotonically_increasing_id().alias("place_read"),
        ),
        "shard-rows",
    )
    rows = _spread(rows).withColumn("key_bucket", F.substring("key", 1, _KEY_DIGITS))
    ties = ["key", "doc_id", "size", "text_crc32"]
    ranked = staged(_ranked(rows, ["stratum"], "key_bucket", ties, "rank"), "shard-ranks")
    placed = ranked.withColumn(
        "fraction", (2 * F.col("rank") + 1).cast("double") / (2 * F.col("rank_total"))
    ).withColumn("rank_bucket", F.floor(F.col("fraction") * _RANK_BUCKETS))
    # The whole table is one stratum for the second ranking; only bucket counts meet in it.
    placed = placed.withColumn("all_rows", F.lit(0))
    order = ["fraction", "stratum", *ties]
    cut = _ranked(placed, ["all_rows"], "rank_bucket", order, "place")
    return (
        cut.withColumn("shard", F.expr(f"place * {shards} div place_total").cast("int"))
        .withColumn("slot", F.expr(f"place - (shard * place_total + {shards - 1}) div {shards}"))
        .select("doc_id", "source", "size", "text_crc32", "shard", "slot")
    )
